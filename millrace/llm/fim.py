"""Fill-in-middle transformation over a learned rank index of token boundaries.

A document's boundaries (the start of the text and the end of every token) are a sorted
list: rank -> offset.  ``RankIndex`` fits straight segments to it whose error is at most
``MAX_ERROR``, so what a segment predicts differs from the truth by one signed byte: the
stored residual, which corrects the prediction exactly.  All documents of a batch are
fitted at once.  Both cuts of a document are looked up in the index; nothing else is split.

Tokens are words with the white space before them; white space at the end is a token of
its own.  The cuts, and whether and how a document is rearranged, come from a hash of
``seed`` and the document's id, so reruns agree.

Null texts count as empty, a null id hashes like an empty one.  Empty texts and texts that
hold a marker stay plain.  Rows are independent: repeated rows repeat, extra columns are
ignored whatever their names, an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_pass, bounded

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
MAX_ERROR = 127  # a residual is one signed byte

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class RankIndex:
    """Piecewise-linear map from ranks to offsets, exact through residuals.

    ``offsets`` holds the sorted offsets of many documents one after the other and
    ``firsts`` where each document begins.  A document starts as one segment through its
    first and last offset; a segment that errs by more than ``max_error`` is halved.  Two
    points lie on their line, so at most log2 n rounds are needed.
    """

    def __init__(self, offsets: np.ndarray, firsts: np.ndarray, max_error: int = MAX_ERROR):
        if not 0 <= max_error <= MAX_ERROR:
            raise ValueError(f"an error must be between 0 and {MAX_ERROR}")
        low = firsts.astype(np.int64)
        high = np.append(low[1:], len(offsets)) - 1
        self.residuals = np.zeros(len(offsets), np.int8)
        done = []
        while len(low):
            lengths = high - low + 1
            begins = np.cumsum(lengths) - lengths
            step = np.arange(lengths.sum()) - np.repeat(begins, lengths)
            at = step + np.repeat(low, lengths)
            rise, run = offsets[high] - offsets[low], np.maximum(high - low, 1)
            line = np.repeat(offsets[low], lengths) + step * np.repeat(rise, lengths) // np.repeat(run, lengths)
            error = offsets[at] - line
            fits = np.maximum.reduceat(np.abs(error), begins) <= max_error
            inside = np.repeat(fits, lengths)
            self.residuals[at[inside]] = error[inside]
            done.append(np.stack([low[fits], offsets[low[fits]], rise[fits], run[fits]]))
            low, high = low[~fits], high[~fits]
            half = (low + high) // 2
            low, high = np.concatenate([low, half + 1]), np.concatenate([half, high])
        found = np.concatenate(done, axis=1) if done else np.zeros((4, 0), np.int64)
        self.starts, self.bases, self.rises, self.runs = found[:, np.argsort(found[0])]

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets by the segments alone, at most ``max_error`` away."""
        own = np.searchsorted(self.starts, ranks, "right") - 1
        return self.bases[own] + (ranks - self.starts[own]) * self.rises[own] // self.runs[own]

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets."""
        return self.predict(ranks) + self.residuals[ranks]


def boundaries(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries in each text, and where each text's list begins.

    ``edges`` are the ends of the texts in ``data``, with the start of the first one.
    """
    solid = ~SPACE[data]
    last = np.zeros(len(data) + 1, bool)  # the first byte behind a token
    last[1:] = solid
    last[1:-1] &= ~solid[1:]
    last[edges[1:][edges[1:] > edges[:-1]]] = True  # white space at the end, and words that the next text would lengthen
    ends = np.flatnonzero(last)
    counts = np.searchsorted(ends, edges[1:], "right") - np.searchsorted(ends, edges[:-1], "right")
    firsts = np.cumsum(counts + 1) - (counts + 1)
    owner = np.repeat(np.arange(len(counts)), counts + 1)
    offsets = np.zeros(len(owner), np.int64)
    later = np.ones(len(owner), bool)
    later[firsts] = False
    first_end = np.searchsorted(ends, edges[0], "right")
    offsets[later] = ends[first_end : first_end + counts.sum()]
    offsets[later] -= edges[:-1][owner[later]]
    return offsets, firsts


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 from the hash of a seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(
    docs: DataFrame,
    seed: int = 42,
    fim_percent: int = 50,
    spm_percent: int = 80,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Columns ``keep``, n_units, form, prefix_chars, middle_chars and output.

    ``fim_percent`` of the documents are rearranged, ``spm_percent`` of these with the
    suffix first.  The lengths are null where the form is plain.
    """
    bounded(docs.sparkSession)
    text = F.coalesce(docs["text"], F.lit(""))
    first, second, chance, kind = draws(seed, docs["doc_id"])
    marked = F.lit(False)
    for marker in MARKERS:
        marked = marked | F.contains(text, F.lit(marker))
    plain = (text == "") | marked | (chance % 100 >= fim_percent)
    form = F.when(plain, PLAIN).when(kind % 100 < spm_percent, SPM).otherwise(PSM)
    source = docs.select(*keep, form.alias("__form"), first.alias("__first"), second.alias("__second"), text.alias("__text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)

    def make():
        return lambda batch: {name: batch.column(i) for i, name in enumerate(keep)} | _rearranged(*batch.columns[len(keep) :])

    schema = f"{kinds}n_units long, form string, prefix_chars long, middle_chars long, output string"
    return arrow_pass(source, schema, make)


def _rearranged(form: pa.Array, first: pa.Array, second: pa.Array, text: pa.Array) -> dict:
    _, ends, buffer = text.buffers()
    edges = np.frombuffer(ends, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
    data, edges = data[edges[0] : edges[-1]], edges - edges[0]
    offsets, firsts = boundaries(data, edges)
    n = np.append(firsts[1:], len(offsets)) - firsts - 1
    draw = np.sort(np.stack([first.to_numpy() % (n + 1), second.to_numpy() % (n + 1)]), axis=0)
    index = RankIndex(offsets, firsts)
    a, b = index.offset(firsts + draw[0]) + edges[:-1], index.offset(firsts + draw[1]) + edges[:-1]
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    forms = form.to_pylist()
    whole, output = data.tobytes(), []
    p, s, m = (marker.encode() for marker in MARKERS)
    for kind, start, left, right, end in zip(forms, edges[:-1].tolist(), a.tolist(), b.tolist(), edges[1:].tolist()):
        if kind == PLAIN:
            output.append(whole[start:end])
        elif kind == PSM:
            output.append(b"".join((p, whole[start:left], s, whole[right:end], m, whole[left:right])))
        else:
            output.append(b"".join((s, whole[right:end], p, whole[start:left], m, whole[left:right])))
    hidden = np.array([kind == PLAIN for kind in forms], bool)
    return {
        "n_units": pa.array(n, pa.int64()),
        "form": form,
        "prefix_chars": pa.array(chars[a] - chars[edges[:-1]], pa.int64(), mask=hidden),
        "middle_chars": pa.array(chars[b] - chars[a], pa.int64(), mask=hidden),
        "output": pa.array(output, pa.binary()).cast(pa.string()),
    }


def restored(output: Column, form: Column) -> Column:
    """The text that a document had before it was rearranged."""
    parts = F.split(output, "|".join(map(re.escape, MARKERS)), -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(form == PSM, F.concat(part(1), part(3), part(2)))
        .when(form == SPM, F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
