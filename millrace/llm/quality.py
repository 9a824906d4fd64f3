"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over quantile bins, and a few pairs of features have a
table over coarser bins.  The tables are learned by cyclic boosting: in every round each
feature in turn gets one shallow tree, fitted to what the whole model still misses; then
the same for the pairs, which are chosen by what a four-cell split of the rest would gain.
A score is the logistic value of the summed table entries, looked up bin by bin with numpy.

Features come from the whole text only.  The model is fitted on a bounded sample of labelled
documents (SAMPLE_LABELS, smallest id hashes; a parameter); everything is scored.
Null text counts as empty; empty texts get a score too.  Labels with a null id or null
quality are ignored; repeated labels count as often as they occur.  Repeated rows repeat,
extra columns are ignored, and without any label every score is 0.5.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import arrow_pass, bounded

ACCEPT = 0.3  # scores from here on are accepted
SAMPLE_LABELS = 12_000
BINS, COARSE, PAIRS = 32, 8, 8
NAMES = (
    "words", "word_length", "longest", "distinct", "distinct_threes", "same_as_next", "upper", "digits", "symbols",
    "exclaims", "stops", "commas", "pipes", "lines", "distinct_lines", "other_bytes", "capital_words", "breaks",
)


def features(text: str) -> list[float]:
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(len(raw) - int(counts[[9, 10, 11, 12, 13, 32]].sum()), 1)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    lengths = list(map(len, words)) or [0]
    per = max(n, 1)
    return [
        float(np.log1p(n)),
        sum(lengths) / per,
        float(np.log1p(max(lengths))),
        len(set(words)) / per,
        len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1),
        sum(map(bytes.__eq__, words, words[1:])) / per,
        upper / max(upper + lower, 1),
        int(counts[48:58].sum()) / size,
        int(counts[[35, 36, 37, 38, 42, 60, 62, 64, 94, 126]].sum()) / size,
        int(counts[33]) / per,
        int(counts[46]) / per,
        int(counts[44]) / per,
        int(counts[124]) / per,
        float(np.log1p(len(lines))),
        len(set(lines)) / max(len(lines), 1),
        int(counts[128:].sum()) / size,
        sum(w[:1].isupper() for w in words) / per,
        len(lines) / per,
    ]


class AdditiveModel:
    """Intercept, one table per feature and one per chosen pair, all in log-odds."""

    def __init__(self):
        self.start, self.edges, self.tables = 0.0, [], []
        self.coarse, self.pairs = [], []  # pairs: (i, j, table)

    @staticmethod
    def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
        return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1) -> AdditiveModel:
        if not len(y):
            return self
        rest = (len(y) - y.sum() + 1) / (y.sum() + 1)
        self.start = -float(np.log(rest))
        self.edges, self.coarse = self._edges(x, BINS), self._edges(x, COARSE)
        fine, coarse = self._bins(x, self.edges), self._bins(x, self.coarse)
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        total = np.full(len(y), self.start)
        for _ in range(rounds):
            for j, own in enumerate(fine):
                g, h = self._slopes(total, y)
                step = rate * tree(np.bincount(own, g, len(self.tables[j])), np.bincount(own, h, len(self.tables[j])))
                self.tables[j] += step
                total += step[own]
        g, h = self._slopes(total, y)
        grids = {(i, j): coarse[i] * (len(self.coarse[j]) + 1) + coarse[j] for i, j in combinations(range(x.shape[1]), 2)}
        shape = lambda i, j: (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
        both = lambda i, j, g, h: [np.bincount(grids[i, j], v, np.prod(shape(i, j))).reshape(shape(i, j)) for v in (g, h)]
        gains = {p: quarter(*both(*p, g, h))[0] for p in grids}
        chosen = sorted(sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS])
        self.pairs = [(i, j, np.zeros(shape(i, j))) for i, j in chosen]
        for _ in range(rounds // 3):
            for i, j, table in self.pairs:
                g, h = self._slopes(total, y)
                step = rate * quarter(*both(i, j, g, h))[1]
                table += step
                total += step.ravel()[grids[i, j]]
        return self

    @staticmethod
    def _slopes(total, y):
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Bins of all rows by feature, then table entries are added up."""
        total = np.full(len(x), self.start)
        for own, table in zip(self._bins(x, self.edges), self.tables):
            total += table[own]
        coarse = self._bins(x, self.coarse)
        for i, j, table in self.pairs:
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


SMOOTH = 3.0


def tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree over ordered bins: the cut with the largest gain, again and again, up to ``leaves`` leaves."""
    g0, h0 = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (g0[b] - g0[a]) ** 2 / (h0[b] - h0[a] + SMOOTH)
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for part in parts:
            a, b = part
            if b - a > 1:
                cuts = np.arange(a + 1, b)
                gains = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                k = int(gains.argmax())
                if gains[k] > best[0]:
                    best = (gains[k], part, int(cuts[k]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (g0[b] - g0[a]) / (h0[b] - h0[a] + SMOOTH)
    return out


def quarter(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes into four cells: its gain, and the cell values as a table."""
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a = lambda c: c[:-1, :-1]
    top, left = lambda c: c[:-1, -1:], lambda c: c[-1:, :-1]
    cells = [
        (a(cg), a(ch)),
        (top(cg) - a(cg), top(ch) - a(ch)),
        (left(cg) - a(cg), left(ch) - a(ch)),
        (cg[-1, -1] - top(cg) - left(cg) + a(cg), ch[-1, -1] - top(ch) - left(ch) + a(ch)),
    ]
    gains = sum(x * x / (w + SMOOTH) for x, w in cells) - cg[-1, -1] ** 2 / (ch[-1, -1] + SMOOTH)
    at = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.empty(g.shape)
    i, j = at[0] + 1, at[1] + 1
    for (x, w), rows, cols in zip(cells, (slice(0, i), slice(0, i), slice(i, None), slice(i, None)), (slice(0, j), slice(j, None)) * 2):
        out[rows, cols] = x[at] / (w[at] + SMOOTH)
    return float(gains[at]), out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_LABELS) -> AdditiveModel:
    """Fit on at most ``limit`` labelled documents that are not held out."""
    bounded(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            rows = [features(t.as_py() or "") for t in batch.column(2)]
            return {"doc_id": batch.column(0), "quality": batch.column(1), "x": pa.array(rows, pa.list_(pa.float64()))}

        return run

    # At most ``limit`` pairs of numbers are broadcast, and as many feature rows come back.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    rows = arrow_pass(joined, "doc_id long, quality int, x array<double>", make).collect()
    rows = sorted((r[0], r[1], tuple(r[2])) for r in rows)
    x = np.array([r[2] for r in rows]).reshape(len(rows), len(NAMES))
    return AdditiveModel().fit(x, np.array([float(r[1] == 1) for r in rows]))


def score(docs: DataFrame, model: AdditiveModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and quality_score, for every document."""
    spark = bounded(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)  # a few thousand numbers
    source = docs.select(*keep, docs["text"].alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)

    def make():
        own = sent.value

        def run(batch: pa.RecordBatch) -> dict:
            x = np.array([features(t.as_py() or "") for t in batch.column(len(keep))])
            columns = {name: batch.column(i) for i, name in enumerate(keep)}
            return columns | {"quality_score": pa.array(own.scores(x))}

        return run

    return arrow_pass(source, f"{kinds}, quality_score double", make)
