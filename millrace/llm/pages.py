"""Main text of web pages by nearest-URL page differencing.

Pages of a host are sorted by URL path and each page is paired with the neighbour whose
path shares the longer beginning.  The text lines of the two are aligned by a longest
common subsequence and shared lines are deleted: what a page shares with its neighbour is
the template of the site.

A line is text between block tags, outside of markup, scripts and styles.  What makes two
lines equal depends on where they stand.  Menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are slots of the template: they are equal when the slot
is, because their wording may change from page to page.  Other lines are equal when their
text is.  A slot is named by a tag, a role, or a class name or id: a whole one, or the last
part of a compound one (site-header, main_nav) that does not begin with "no".  html, body,
main and article are never slots, headings not by their class, nor is anything around the
article (the first main, else the longest article) except nav, aside and footer.

A slot is deleted when the neighbour has it too, another line when the alignment shares it.
A page without a neighbour is held against a general template, which has every slot and no
other line.  Lines inside an article are never deleted for their wording, and a page without
a word of its own is a copy of its neighbour and keeps what they share: the contract asks
for the article, also where two pages carry the same.

Null html is empty.  Pages without a host have no neighbour.  Repeated rows repeat, extra
columns are ignored, empty tables are fine.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import arrow_pass, bounded, durable, string_array
from millrace.llm.urls import host_of, path_of

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|[^<]+|<", re.S
)
ATTRIBUTE = re.compile(r"""([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
RAW = frozenset("script style textarea title noscript template iframe svg object head".split())
CLOSED_BY = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody"
    " tfoot thead tr ul".split()
)
SLOT_TAGS = frozenset("nav aside footer form menu dialog button select".split())
SLOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form".split())
SLOT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer"
    " masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup social share"
    " sharing comment comments respond disqus promo promotion sponsor sponsored related widget pagination pager toolbar"
    " copyright".split()
)
COMPOUND_NAMES = SLOT_NAMES | {"header"}
DENIED = frozenset("no not without hide hidden".split())
PARTS = re.compile("[-_]+")
NO_SLOTS = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FIRM_TAGS = frozenset("nav aside footer".split())  # slots even around an article

Line = tuple[str, str, bool]  # slot or "", text, inside an article


@dataclass(slots=True, eq=False)
class Open:
    """A tag that is not closed yet."""

    tag: str
    slot: str
    article: bool


Around = tuple[Open, ...]  # the slots and articles around a line, outermost first


def names_slot(word: str) -> bool:
    """Whether a class name or id is that of a slot."""
    if word in SLOT_NAMES:
        return True
    first, *_, last = PARTS.split(word) if "-" in word or "_" in word else ("", "")
    return last in COMPOUND_NAMES and first not in DENIED


def slot_of(tag: str, attributes: str, inside: bool) -> str:
    """Name of the template slot that a tag opens, or nothing."""
    if tag in NO_SLOTS or not attributes and tag not in SLOT_TAGS and tag != "header":
        return ""
    names = {}
    if attributes:
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    words = f"{names.get('class', '')} {names.get('id', '')}".lower().split()
    found = next((w for w in words if names_slot(w)), "") if tag not in HEADINGS else ""
    if found or tag in SLOT_TAGS or names.get("role", "").lower() in SLOT_ROLES or tag == "header" and not inside:
        return f"{tag}.{found}"
    return ""


def page_lines(source: str) -> list[Line]:
    """The text lines of a page in order."""
    lines: list[tuple[Around, str]] = []
    words: list[str] = []
    open_tags: list[Open] = []
    at, size = 0, len(source)

    now: Around = ()

    def end_line() -> None:
        text = " ".join(html.unescape("".join(words)).split())
        words.clear()
        if text:
            lines.append((now, text))

    while at < size:
        m = PIECE.match(source, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if source[m.start()] != "<" or at == m.start() + 1:
                words.append(m[0])
            continue
        tag = tag.lower()
        if tag in RAW and not m[1] and not m[3].endswith("/"):
            close = CLOSED_BY[tag].search(source, at)
            body = re.compile(r"<body\b", re.I).search(source, at) if tag == "head" else None
            if body and (not close or body.start() < close.start()):
                at = body.start()
            else:
                at = close.end() if close else size if tag != "head" else at
            continue
        if tag in BLOCKS:
            end_line()
        elif tag == "br" or tag in ("td", "th"):
            words.append(" ")
        if m[1]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i].tag == tag:
                    closed = open_tags[i:]
                    del open_tags[i:]
                    if now and any(o.slot or o.article for o in closed):
                        now = tuple(o for o in open_tags if o.slot or o.article)
                    break
            continue
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in BLOCKS and open_tags and open_tags[-1].tag == tag and tag in ("p", "li", "dd", "dt", "option"):
            open_tags.pop()
            now = tuple(o for o in open_tags if o.slot or o.article)
        slot = slot_of(tag, m[3], any(o.article for o in now))
        article = tag in ("article", "main")
        if slot or article or tag not in ("p", "li", "b", "i", "a", "em", "strong", "span", "td", "th", "tr", "tbody"):
            open_tags.append(Open(tag, slot, article))
            if slot or article:
                now = (*now, open_tags[-1])
    end_line()
    free_article(lines)
    return [(next((o.slot for o in around if o.slot), ""), text, any(o.article for o in around)) for around, text in lines]


def free_article(lines: list[tuple[Around, str]]) -> None:
    """Take the slots away that lie around the article: the first main, else the article with most words."""
    sizes: dict[int, int] = defaultdict(int)
    chains: dict[int, Around] = {}
    for around, text in lines:
        top = next((i for i, o in enumerate(around) if o.article), None)
        if top is not None:
            key = id(around[top])
            chains.setdefault(key, around[: top + 1])
            sizes[key] += len(text.split())
    if sizes:
        mains = [k for k in sizes if chains[k][-1].tag == "main"]
        chosen = mains[0] if mains else max(sizes, key=sizes.get)
        for o in chains[chosen]:
            if o.tag not in FIRM_TAGS:
                o.slot = ""


def line_keys(lines: list[Line]) -> tuple[list[int], list[list[int]]]:
    """Keys to align, and the lines behind each: runs of one slot are one key."""
    keys, members = [], []
    for i, (slot, text, _) in enumerate(lines):
        name = "slot " + slot if slot else "text " + text
        key = xxhash.xxh3_64_intdigest(name) - 2**63
        if slot and keys and keys[-1] == key and lines[i - 1][0]:
            members[-1].append(i)
        else:
            keys.append(key)
            members.append([i])
    return keys, members


def shared(a: list[int], b: list[int]) -> set[int]:
    """Places of ``a`` on a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out = set(range(start)) | set(range(len(a) - end, len(a)))
    places = defaultdict(list)
    for j in range(len(b) - end - 1, start - 1, -1):
        places[b[j]].append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i in range(start, len(a) - end):
        for j in places.get(a[i], ()):  # from the last to the first
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(source: str, partner: list[int] | None) -> str:
    """What is left of a page when the template is deleted."""
    lines = page_lines(source)
    keys, members = line_keys(lines)
    same = shared(keys, partner) if partner else set()
    texts = [i for i, (slot, _, _) in enumerate(lines) if not slot]
    common = [members[k][0] for k in same if not lines[members[k][0]][0]]
    copy = len(common) == len(texts)
    gone = set() if copy else {i for i in common if not lines[i][2]}
    theirs = set(partner) if partner else None
    for key, places in zip(keys, members):
        if lines[places[0]][0] and (theirs is None or key in theirs):
            gone.update(places)
    return "\n".join(text for i, (_, text, _) in enumerate(lines) if i not in gone)


def page_key():
    return F.xxhash64("page_id", "url", "html")


def partners(pages: DataFrame) -> DataFrame:
    """page_key and the keys of the nearest page of the same host, for pages that have one."""
    url = F.col("url")
    light = pages.select(page_key().alias("page_key"), host_of(url).alias("host"), path_of(url).alias("path"), "page_id", "html")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            keys = [line_keys(page_lines(t.as_py() or ""))[0] for t in batch.column("html")]
            out = {c: batch.column(c) for c in ("page_key", "host", "path", "page_id")}
            return out | {"keys": pa.array(keys, pa.list_(pa.int64()))}

        return run

    kind = "page_key long, host string, path string, page_id long, keys array<long>"
    order = ["host", "path", "page_id", "page_key"]
    own = arrow_pass(light.where(F.col("host") != ""), kind, make)
    own = own.groupBy("page_key").agg(*[F.first(c).alias(c) for c in ("host", "path", "page_id", "keys")])
    ordered = durable(own.repartitionByRange(*order).sortWithinPartitions(*order).select("page_key", "host", "path", "keys"))
    numbered = ordered.withColumn("part", F.spark_partition_id())

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1)
        if first:
            yield first
            yield last

    # Two pages for each partition: the neighbours across its edges.
    kind = "page_key long, host string, path string, keys array<long>, part int"
    rows = defaultdict(list)
    for r in numbered.mapInArrow(ends, kind).collect():
        rows[r.part].append((r.page_key, r.host, r.path, np.array(r["keys"], np.int64)))
    parts = sorted(rows)
    before = {p: rows[q][1] for q, p in zip(parts, parts[1:])}
    behind = {p: rows[q][0] for p, q in zip(parts, parts[1:])}

    def alike(a: str, b: str) -> int:
        n = min(len(a), len(b))
        return next((i for i in range(n) if a[i] != b[i]), n)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            started, part = False, 0
            for batch in batches:
                columns = [batch.column(c) for c in ("page_key", "host", "path", "keys")]
                for i in range(batch.num_rows):
                    if not started:
                        started, part = True, batch.column("part")[0].as_py()
                        yield before.get(part)
                    own = [c[i] for c in columns]
                    yield (own[0].as_py(), own[1].as_py(), own[2].as_py(), own[3].values.to_numpy(zero_copy_only=False))
            if started:
                yield behind.get(part)

        def out(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))],
                names=["page_key", "partner"],
            )

        found, left, own = [], None, None
        for n, right in enumerate(rows()):
            if n >= 2 and own is not None:
                near = [r for r in (left, right) if r is not None and r[1] == own[1]]
                if near:
                    best = max(near, key=lambda r: alike(r[2], own[2]))
                    found.append((own[0], best[3]))
            left, own = own, right
            if len(found) >= 1000:
                yield out(found)
                found = []
        if found:
            yield out(found)

    return numbered.mapInArrow(pair, "page_key long, partner array<long>")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text for each page."""
    bounded(pages.sparkSession)
    keyed = pages.select("page_id", "url", "html", page_key().alias("page_key"))
    joined = keyed.join(partners(pages), "page_key", "left").select("page_id", "url", "html", "partner")

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            text = [main_text(h.as_py() or "", p.as_py()) for h, p in zip(batch.column("html"), batch.column("partner"))]
            return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": string_array(text)}

        return run

    return arrow_pass(joined, "page_id long, url string, text string", make)
