"""Chunk rules as column expressions over one record's text.

A record's text is one cell, so splitting, categorising and merging it need no
shuffle: all of it stays inside the row.  ``SEP`` is a Unicode noncharacter used
only between the parts of an intermediate string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.plan import let
from millrace.functions.text import is_blank, strip

SEP = "\ufdd0"
SEP_PATTERN = r"\x{FDD0}"

# Heading forms, by shape alone: a line's length never matters.
HEADING_MARK = r"\A {0,3}#{1,6}[ \t]"
LABEL_END = r":[ \t]*\z"
SENTENCE_INSIDE = r"[.!?][ \t]"
BARE_END = r"[\p{L}\p{N}][ \t]*\z"
TITLE = r"\A[ \t]*[\p{Lu}\p{Lo}](?:[^\p{N}.,;:!?]*\p{L})?[ \t]*\z"
SECTION_NAMES = "ingredients directions method preparation instructions history variations notes tips"
SECTION = rf"(?i)\A[ \t]*(?:{'|'.join(SECTION_NAMES.split())})[ \t]*\z"

SENTENCE = r"[^.!?\n]+[.!?]*"

# Cue stems per category, widest first claim on a tie: the order is the tie-break.
# A serving vessel speaks for directions, and a named reference beats history.
CUES = {
    "directions": "shake stir strain pour muddle chill garnish rim coupe rocks highball cocktail serve add mix blend",
    "ingredients": "gin vodka rum tequila whisk lime lemon syrup bitters juice vermouth egg oz ml dash cup",
    "flavor_profile": "bright dry sweet sour bitter smok crisp finish aroma palate rich balance taste",
    "occasions": "summer winter spring autumn holiday party evening brunch birthday when day at the",
    "suggestions": "pair recommend try best enjoy tip with",
    "famous_references": "film novel song singer bond hemingway hotel bar club by",
    "historical_and_geographical": "origin century invent history london paris first von from was",
    "variations": "variation swap substitut instead alternativ replace or",
}
FALLBACK = "other"


def cue_pattern(category: str) -> str:
    stems = "|".join(CUES[category].split())
    return rf"(?i)(?:\A|[^\p{{L}}])(?:{stems})"


def cue_score(text: Column, category: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(cue_pattern(category)), F.lit(0)))


def _branches(words: list[str]) -> str:
    """Pattern of the longest of some words that starts here, cut by their letters."""
    heads: dict[str, list[str]] = {}
    for word in words:
        if word:
            heads.setdefault(word[0], []).append(word[1:])
    parts = [head + _branches(tails) for head, tails in sorted(heads.items())]
    return f"(?:{'|'.join(parts)})" + "?" * ("" in words) if parts else ""


#: The longest cue stem, of any category, at the start of a word.
ANY_CUE = rf"(?i)(?:\A|[^\p{{L}}])({_branches(sorted({stem for stems in CUES.values() for stem in stems.split()}))})"


def categorize(text: Column) -> Column:
    """Category with most cue hits; ties go to the earlier entry of ``CUES``.

    The text is read once, for the longest stem of each word.  A shorter stem that the word
    starts with is a start of that one, so the categories score the stems instead of the text.
    """
    return let(F.array_join(F.regexp_extract_all(text, F.lit(ANY_CUE), F.lit(1)), " "), _best_category)


def _best_category(text: Column) -> Column:
    ranked = [
        F.struct(cue_score(text, name).alias("score"), F.lit(-rank).alias("rank"), F.lit(name).alias("category"))
        for rank, name in enumerate(CUES)
    ]
    ranked.append(F.struct(F.lit(0).alias("score"), F.lit(1).alias("rank"), F.lit(FALLBACK).alias("category")))
    return F.array_max(F.array(*ranked))["category"]


def is_heading(line: Column, before: Column) -> Column:
    """Whether a line introduces the next one; ``before`` is the line above it or null.

    Marks, labels and section names always do.  A line without an end mark does so only below
    a finished sentence or at the start: below another such line it is an entry of a list.
    """
    opens_run = before.isNull() | ~(before.rlike(BARE_END) | before.rlike(LABEL_END))
    return (
        (F.contains(line, F.lit("#")) & line.rlike(HEADING_MARK))
        | (F.contains(line, F.lit(":")) & line.rlike(LABEL_END) & ~line.rlike(SENTENCE_INSIDE))
        | line.rlike(SECTION)
        | (line.rlike(TITLE) & opens_run)
    )


def split_spans(text: Column) -> Column:
    """Non-blank lines, untouched."""
    return F.filter(F.split(text, "\n", -1), lambda line: ~is_blank(line))


def split_blocks(spans: Column) -> Column:
    """Glue headings to the line they introduce; trailing ones join the block before."""
    glued = F.array_join(
        F.transform(
            spans,
            lambda s, i: F.concat(s, F.when(is_heading(s, F.get(spans, i - 1)), F.lit("\n")).otherwise(F.lit(SEP))),
        ),
        "",
    )
    join_last = lambda t: F.regexp_replace(t, rf"{SEP_PATTERN}([^{SEP_PATTERN}]*)\n\z", "\n$1")
    closed = let(glued, lambda t: F.when(F.endswith(t, F.lit("\n")), join_last(t)).otherwise(t))
    marked = lambda t: F.endswith(t, F.lit("\n")) | F.endswith(t, F.lit(SEP))
    unmarked = let(closed, lambda t: F.when(marked(t), F.substring(t, F.lit(1), F.char_length(t) - 1)).otherwise(t))
    parts = F.split(unmarked, SEP, -1)
    return F.filter(parts, lambda part: part != "")


def label_blocks(blocks: Column) -> Column:
    return F.transform(blocks, lambda b: F.struct(categorize(b).alias("category"), b.alias("text")))


def merge_blocks(labelled: Column, joiner: str = "\n") -> Column:
    """One chunk per category, categories and their blocks in source order."""
    names = F.array_distinct(F.transform(labelled, lambda b: b["category"]))

    def merged(name: Column) -> Column:
        own = F.filter(labelled, lambda b: b["category"] == name)
        return F.struct(
            name.alias("category"), F.array_join(F.transform(own, lambda b: b["text"]), joiner).alias("content")
        )

    return F.transform(names, merged)


def piece_pattern(limit: int) -> str:
    """Longest run of whole blocks within ``limit`` characters, else one oversize block."""
    return rf"(?s:.{{1,{limit}}})(?:{SEP_PATTERN}|\z)|[^{SEP_PATTERN}]+(?:{SEP_PATTERN}|\z)"


def split_oversize(chunks: Column, limit: int) -> Column:
    """Cut chunks joined by ``SEP`` at block ends only, packing up to ``limit`` characters."""

    def pieces(chunk: Column) -> Column:
        cut = F.regexp_extract_all(chunk["content"], F.lit(piece_pattern(limit)), F.lit(0))
        return F.transform(
            cut,
            lambda p: F.struct(
                chunk["category"].alias("category"),
                F.translate(F.regexp_replace(p, rf"{SEP_PATTERN}\z", ""), SEP, "\n").alias("content"),
            ),
        )

    return F.flatten(F.transform(chunks, pieces))


def keep_filled(chunks: Column) -> Column:
    """Drop chunks whose content is only white space."""
    return F.filter(chunks, lambda c: ~is_blank(c["content"]))


def sentences(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    trimmed = F.transform(found, strip)
    return F.filter(trimmed, lambda s: s != "")
