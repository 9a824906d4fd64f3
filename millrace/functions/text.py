"""Cleaning functions as column expressions.

Every rule is written in the regex subset that Java and RE2 read alike (no
look-around, no back-references), applied by built-in functions, so cleaning is
a map-only projection inside the JVM whatever the table size.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.plan import let

# Unicode white space as Python's str.strip() sees it.
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE_CHARS = "".join(
    chr(c)
    for low, high in re.findall(r"\\x\{([0-9A-F]+)\}(?:-\\x\{([0-9A-F]+)\})?", SPACE)
    for c in range(int(low, 16), int(high or low, 16) + 1)
)

# Inline flags: "m" line anchors, "s" dot matches newline, "i" ignore case.
# Java gets "d" as well so that only \n ends a line, as in RE2.
MARKDOWN_RULES = [
    # images, links and autolinks keep their text
    ("", r"!\[([^\]\n]*)\]\([^)\n]*\)", "$1"),
    ("", r"\[([^\]\n]+)\]\([^)\n]*\)", "$1"),
    ("", r"<(https?://[^> \t\n]*)>", "$1"),
    # rules, underlines of headings, separator rows of tables
    (
        "m",
        r"^ {0,3}(?:\*[ \t]*\*[ \t]*\*[* \t]*|-[ \t]*-[ \t]*-[- \t]*|_[ \t]*_[ \t]*_[_ \t]*|={2,}[ \t]*)$",
        "",
    ),
    ("m", r"^[ \t]*\|[ \t:|-]*-[ \t:|-]*\|[ \t]*$", ""),
    # marks at the start of a line
    ("m", r"^ {0,3}>[> ]*", ""),
    ("m", r"^ {0,3}#{1,6}[ \t]+", ""),
    ("m", r"^[ \t]*(?:[-*+]|[0-9]{1,9}[.)])[ \t]+(?:\[[ xX]\][ \t]+)?", ""),
    # table cells
    ("m", r"^[ \t]*\|[ \t]*([^\n]*[^| \t\n])[ \t]*\|[ \t]*$", "$1"),
    ("", r"[ \t]+\|[ \t]+", " "),
    # emphasis, widest mark first, then once more for nested marks
    ("", r"\*\*\*([^*\n]+)\*\*\*", "$1"),
    ("", r"\*\*([^*\n]+)\*\*", "$1"),
    ("", r"\*([^* \t\n](?:[^*\n]*[^* \t\n])?)\*", "$1"),
    ("", r"\*\*([^*\n]+)\*\*", "$1"),
    ("", r"__([^_\n]+)__", "$1"),
    ("m", r"^_([^_\n]+)_($|[^A-Za-z0-9_])", "$1$2"),
    ("m", r"([^A-Za-z0-9_])_([^_\n]+)_($|[^A-Za-z0-9_])", "$1$2$3"),
    ("", r"~~([^~\n]+)~~", "$1"),
]

# An opening fence goes with its whole line; a bare fence on the last line goes only
# where an opening one was there.  Both in one rule, so the text is read once.
FENCE_RULE = ("ms", r"\A```[^\n]*(?:\n|\z)(.*?)(?:^[ \t]*```)?\z", "$1")

HTML_RULES = [
    ("is", r"<script[^>]*>.*?</script[^>]*>", ""),
    ("is", r"<style[^>]*>.*?</style[^>]*>", ""),
    ("s", r"<!--.*?-->", ""),
    ("", r"<[!?][^>]*>", ""),
    (
        "i",
        r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|thead|tbody|section|article|aside|header|footer"
        r"|nav|main|title|head|body|html|form|blockquote|pre)(?:[ \t\n/][^>]*)?>",
        "\n",
    ),
    ("", r"</?[A-Za-z][^>]*>", ""),
    ("", r"&(?:nbsp|#160);", " "),
    ("", r"&lt;", "<"),
    ("", r"&gt;", ">"),
    ("", r"&(?:quot|#34);", '"'),
    ("", r"&(?:apos|#39);", "'"),
    ("", r"&amp;", "&"),
    ("", r"[ \t]*\n[ \t\n]*", "\n"),
]

# The code points beyond ASCII that Unicode lists with the property Emoji.
EMOJI_BASE = (
    r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}-\x{21AA}\x{231A}-\x{231B}"
    r"\x{2328}\x{23CF}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{24C2}\x{25AA}-\x{25AB}\x{25B6}\x{25C0}"
    r"\x{25FB}-\x{25FE}\x{2600}-\x{2604}\x{260E}\x{2611}\x{2614}-\x{2615}\x{2618}\x{261D}\x{2620}"
    r"\x{2622}-\x{2623}\x{2626}\x{262A}\x{262E}-\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}"
    r"\x{265F}-\x{2660}\x{2663}\x{2665}-\x{2666}\x{2668}\x{267B}\x{267E}-\x{267F}\x{2692}-\x{2697}\x{2699}"
    r"\x{269B}-\x{269C}\x{26A0}-\x{26A1}\x{26A7}\x{26AA}-\x{26AB}\x{26B0}-\x{26B1}\x{26BD}-\x{26BE}"
    r"\x{26C4}-\x{26C5}\x{26C8}\x{26CE}-\x{26CF}\x{26D1}\x{26D3}-\x{26D4}\x{26E9}-\x{26EA}"
    r"\x{26F0}-\x{26F5}\x{26F7}-\x{26FA}\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}"
    r"\x{2716}\x{271D}\x{2721}\x{2728}\x{2733}-\x{2734}\x{2744}\x{2747}\x{274C}\x{274E}\x{2753}-\x{2755}"
    r"\x{2757}\x{2763}-\x{2764}\x{2795}-\x{2797}\x{27A1}\x{27B0}\x{27BF}\x{2934}-\x{2935}\x{2B05}-\x{2B07}"
    r"\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F004}\x{1F0CF}"
    r"\x{1F170}-\x{1F171}\x{1F17E}-\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}"
    r"\x{1F201}-\x{1F202}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F23A}\x{1F250}-\x{1F251}\x{1F300}-\x{1F321}"
    r"\x{1F324}-\x{1F393}\x{1F396}-\x{1F397}\x{1F399}-\x{1F39B}\x{1F39E}-\x{1F3F0}\x{1F3F3}-\x{1F3F5}"
    r"\x{1F3F7}-\x{1F4FD}\x{1F4FF}-\x{1F53D}\x{1F549}-\x{1F54E}\x{1F550}-\x{1F567}\x{1F56F}-\x{1F570}"
    r"\x{1F573}-\x{1F57A}\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F595}-\x{1F596}\x{1F5A4}-\x{1F5A5}"
    r"\x{1F5A8}\x{1F5B1}-\x{1F5B2}\x{1F5BC}\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}"
    r"\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}-\x{1F64F}\x{1F680}-\x{1F6C5}"
    r"\x{1F6CB}-\x{1F6D2}\x{1F6D5}-\x{1F6D9}\x{1F6DC}-\x{1F6E5}\x{1F6E9}\x{1F6EB}-\x{1F6EC}\x{1F6F0}"
    r"\x{1F6F3}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}"
    r"\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}\x{1FA80}-\x{1FAC6}\x{1FAC8}\x{1FACC}-\x{1FADD}"
    r"\x{1FADF}-\x{1FAEB}\x{1FAEF}-\x{1FAFA}"
)
# Variation selector, skin tones and tag characters belong to the emoji before them.
EMOJI_TAIL = r"\x{FE0F}\x{1F3FB}-\x{1F3FF}\x{E0020}-\x{E007F}"
# Keycaps first (their digit must go too), then a base with its tail and joined parts.
KEYCAP_RULE = ("", r"[0-9#*]\x{FE0F}?\x{20E3}", "")
EMOJI_RULE = ("", rf"[{EMOJI_BASE}][{EMOJI_TAIL}]*(?:\x{{200D}}[{EMOJI_BASE}][{EMOJI_TAIL}]*)*", "")
# The same rule with the base class cut by "above U+00A8" first: Java tests a class
# part by part, and this settles nearly every character at the first part.
FAST_EMOJI_RULE = ("", rf"[[^\x{{00}}-\x{{A8}}]&&[{EMOJI_BASE}]]" + EMOJI_RULE[1][len(f"[{EMOJI_BASE}]") :], "")

# Neighbouring rules, by number, and what a text must hold, one of them, for any of these
# rules to change it.  The search is a scan of bytes; most texts then skip most rules.
# Rule 7 (numbers and marks of lists) has no such sign.
MARKDOWN_GROUPS = [
    (range(0, 3), ("](", "<http")),
    (range(3, 7), ("*", "--", "- ", "-\t", "_", "==", "|", ">", "#")),
    (range(7, 8), None),
    (range(8, 10), ("|",)),
    (range(10, 14), ("*",)),
    (range(14, 18), ("_", "~~")),
]
HTML_GROUPS = [
    (range(0, 6), ("<",)),
    (range(6, 12), ("&",)),
    (range(12, 13), ("\n\n", " \n", "\t\n", "\n ", "\n\t")),
]

# JSON short escapes.
SHORT_ESCAPES = [
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
]


def apply_rule(text: Column, rule: tuple[str, str, str]) -> Column:
    flags, pattern, replacement = rule
    return F.regexp_replace(text, f"(?d{flags}){pattern}", replacement)


def apply_rules(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    return reduce(apply_rule, rules, text)


def apply_groups(text: Column, rules: list[tuple[str, str, str]], groups: list[tuple[range, tuple[str, ...] | None]]) -> Column:
    """The rules in order, a group only on texts that hold one of its signs, a class in Java's own short form."""
    for numbers, signs in groups:
        own = [(flags, pattern.replace("[^A-Za-z0-9_]", r"\W"), new) for flags, pattern, new in (rules[n] for n in numbers)]
        text = apply_rules(text, own) if signs is None else let(text, _guarded(own, signs))
    return text


def _guarded(rules: list[tuple[str, str, str]], signs: tuple[str, ...]) -> Callable[[Column], Column]:
    holds = lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(sign)) for sign in signs])
    return lambda t: F.when(holds(t), apply_rules(t, rules)).otherwise(t)


def strip(text: Column) -> Column:
    """Trim every Unicode white-space character; ``trim`` would only take spaces."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def is_blank(text: Column) -> Column:
    """True for null and for text of nothing but white space."""
    return ~F.coalesce(text.rlike(rf"[^{SPACE}]"), F.lit(False))


def unwrap_fence(text: Column) -> Column:
    fenced = lambda t: F.startswith(t, F.lit("```"))
    return let(strip(text), lambda t: F.when(fenced(t), strip(apply_rule(t, FENCE_RULE))).otherwise(t))


def strip_backticks(text: Column) -> Column:
    return F.replace(text, F.lit("`"), F.lit(""))


def clean_markdown(text: Column) -> Column:
    """Marks out, text kept; then the outer code fence; then leftover backticks."""
    return strip_backticks(unwrap_fence(apply_groups(text, MARKDOWN_RULES, MARKDOWN_GROUPS)))


def clean_html(text: Column) -> Column:
    return strip(apply_groups(text, HTML_RULES, HTML_GROUPS))


def strip_emoji(text: Column) -> Column:
    beyond_ascii = lambda t: F.octet_length(t) > F.char_length(t)
    return let(text, lambda t: F.when(beyond_ascii(t), apply_rules(t, [KEYCAP_RULE, FAST_EMOJI_RULE])).otherwise(t))


def json_escape(text: Column) -> Column:
    """Body of a JSON string literal in ASCII, without the outer quotes.

    Short escapes are plain replacements.  What is then left outside 0x20-0x7E is
    cut out in runs, and each run's UTF-16 code units are printed as hex, which
    gives surrogate pairs for astral characters without a step per character.
    """
    short = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), SHORT_ESCAPES, text)

    def escape_run(run: Column) -> Column:
        units = F.lower(F.hex(F.encode(run, "UTF-16BE")))
        printed = (run >= F.lit(" ")) & (run < F.lit("\x7f"))
        return F.when(printed, run).otherwise(F.regexp_replace(units, "(....)", r"\\u$1"))

    def escaped(t: Column) -> Column:
        runs = F.regexp_extract_all(t, F.lit(r"([ -~]+|[^ -~]+)"), F.lit(1))
        return F.when(t.rlike("[^ -~]"), F.array_join(F.transform(runs, escape_run), "")).otherwise(t)

    return let(short, escaped)


def json_unescape(body: Column) -> Column:
    """The text that a JSON string literal without its quotes stands for; null if it is none."""
    return F.from_json(F.concat(F.lit('{"v":"'), body, F.lit('"}')), "v string")["v"]


def clean_text(text: Column) -> Column:
    """Markdown, then HTML, then emoji: readable text, newlines still real."""
    return strip_emoji(clean_html(clean_markdown(F.coalesce(text, F.lit("")))))


def clean_document(text: Column) -> Column:
    """The full deterministic cleaning path, ending in JSON-safe text."""
    return json_escape(clean_text(text))
