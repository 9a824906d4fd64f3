"""Secret scans: base patterns, and a character convolution network over every candidate.

Base findings come from three patterns.  A candidate is every other run of at least 16
secret-like characters that holds a digit or changes case often.  A small convolution
network (numpy) reads every part of the candidate with its surroundings, and the part that
scores highest decides; it is trained on findings that
carry labels: all base findings and made-up keys as positives, all ordinary long words and
made-up harmless tokens as negatives.  Texts fall into eight slices by their hash.  The findings of
six train, a slice a round: every group of texts goes on from the same network, and the networks
that come out are averaged by findings.  Those of the other two are held out: the scores are calibrated by
a logistic fit on them, and the threshold is the highest one that still reaches the wanted recall there.
Groups and their order follow from ids and texts, so the network does not depend on where rows lie.

Spans are (kind, start, end) in code points, end exclusive, ordered by start, then kind.
Null and empty texts have none.  Repeated rows repeat; extra columns are ignored; with an
empty table the network learns from made-up findings alone.
"""

from __future__ import annotations

import copy
import random
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import arrow_pass, bounded, texts_of

# The base patterns of the contract (fixed values).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "network")

RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
CASE_CHANGE = re.compile(r"[a-z][A-Z]|[A-Z][a-z]{1,2}(?=[A-Z])")

BEFORE, INSIDE, AFTER = 24, 56, 12
LENGTH = BEFORE + INSIDE + AFTER
SHORT = 16  # characters of a short finding
ROWS = 64  # windows that the network reads at once, so that its tables stay in the processor's cache
SLICES, ROUNDS = 8, 6  # parts of the texts; the first ones train, one a round, the others are held out
GROUP_TEXT = 2 << 20  # bytes of text whose findings train one network of a round
BLOCK = 8192  # windows that are held at once
STEP, LEAST, MADE = 144, 8, 16  # findings of a step, positives it has at least, and made-up ones beside them
WHOLE = 1 << 20  # averaged weights are whole multiples of 1 / WHOLE, so that sums do not depend on their order
BINS, FAR = 256, 64  # bins of a held-out logit to 1, and where the last bin is
RECALL = 0.98

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that are long enough."""
    found: list[Span] = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Secret-like runs that no base finding touches."""
    runs = []
    for m in RUN.finditer(text):
        start, end = m.span()
        while end > start and text[end - 1] in ".=-":
            end -= 1
        token = text[start:end]
        if end - start >= 16 and (re.search("[0-9]", token) or len(CASE_CHANGE.findall(token)) >= 3):
            runs.append((start, end))
    return [("network", *run) for run in untouched(runs, taken)]


def untouched(runs: Iterable[tuple[int, int]], taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Those of the runs, ordered and apart, that no finding touches."""
    spans: list[tuple[int, int]] = []  # touched stretches, apart from each other
    for start, end in sorted((s, e) for _, s, e in taken):
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    at = 0
    for start, end in runs:
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if at == len(spans) or spans[at][0] >= end:
            yield start, end


def parts(start: int, end: int) -> list[tuple[int, int]]:
    """Stretches over all characters of a candidate: half overlapping, the last one at its end."""
    last = max(start, end - INSIDE)
    return [(b, min(b + INSIDE, end)) for b in (*range(start, last, INSIDE // 2), last)]


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Windows over all characters of a candidate."""
    return list(window_rows(text, parts(start, end)))


def window_rows(text: str, stretches: list[tuple[int, int]]) -> np.ndarray:
    """A row for each stretch: codes of what is before it, of up to INSIDE characters in it and of what follows; 0 pads."""
    starts, ends = np.array(stretches, np.int64).reshape(-1, 2).T
    low, high = max(0, int(starts.min()) - BEFORE), int(ends.max()) + AFTER
    codes = np.frombuffer(text[low:high].encode("utf-32-le"), np.uint32)
    codes = np.where(codes < 127, np.maximum(codes, 31) - 30, 97).astype(np.int16)
    padded = np.concatenate([np.zeros(BEFORE, np.int16), codes, np.zeros(INSIDE + AFTER, np.int16)])
    first, last = (starts - low + BEFORE)[:, None], (ends - low + BEFORE)[:, None]
    inner = first + np.arange(INSIDE)
    return np.concatenate(
        [padded[first - BEFORE + np.arange(BEFORE)], padded[inner] * (inner < last), padded[last + np.arange(AFTER)]], axis=1
    )


class Adam:
    """Steps of a network's weights along its gradients."""

    def __init__(self, net: CharNet, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.m = {k: np.zeros_like(x) for k, x in net.w.items()}
        self.v = {k: np.zeros_like(x) for k, x in net.w.items()}

    def __call__(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.step += 1
        m, v, w = self.m, self.v, self.net.w
        for k, g in self.net._gradients(codes, y, weight).items():
            g = g + 1e-4 * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            w[k] -= self.rate * (m[k] / (1 - 0.9**self.step)) / (np.sqrt(v[k] / (1 - 0.99**self.step)) + 1e-8)


class CharNet:
    """Embedding, one convolution, max over the candidate and over its surroundings, logistic output."""

    CODES, WIDE, FILTERS, DEEP = 98, 5, 24, 8

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.w = {
            "embed": rng.normal(0, 0.3, (self.CODES, self.DEEP)).astype(np.float32),
            "conv": rng.normal(0, 0.2, (self.WIDE * self.DEEP, self.FILTERS)).astype(np.float32),
            "bias": np.zeros(self.FILTERS, np.float32),
            "out": rng.normal(0, 0.2, 4 * self.FILTERS).astype(np.float32),
            "zero": np.zeros(1, np.float32),
        }
        self.scale, self.shift, self.threshold, self.recall = 1.0, 0.0, 0.5, 0.0
        self.trained = self.held_out = 0  # windows of the table's own findings

    def _by_length(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and codes of the short findings, without most of their padding, and of the others; a few rows at a time, in lots of nearly equal size.

        Where only padding is read, every step says the same, so one such step stands for all.
        """
        short = ~codes[:, BEFORE + SHORT : BEFORE + INSIDE].any(1)
        kept = np.r_[: BEFORE + SHORT + self.WIDE, BEFORE + INSIDE : LENGTH]
        for own, columns in ((np.flatnonzero(short), kept), (np.flatnonzero(~short), slice(None))):
            if len(own):
                for rows in np.array_split(own, -(-len(own) // ROWS)):
                    yield rows, codes[rows][:, columns]

    def _forward(self, codes: np.ndarray):
        # Tables go by step, then by finding, so that products and pooling run over long rows.
        # Spark leaves BLAS one core in a task.
        w, n, f = self.w, len(codes), self.FILTERS
        embed = w["embed"].copy()
        embed[0] = 0
        grams = np.lib.stride_tricks.sliding_window_view(codes.T, self.WIDE, 0)
        cols = embed.take(grams, axis=0).reshape(-1, self.WIDE * self.DEEP)
        a = (cols @ w["conv"]).reshape(-1, n * f)
        a += np.tile(w["bias"], n)
        np.maximum(a, 0, out=a)
        # Steps whose middle lies in the candidate, and the others.
        first, last = BEFORE - self.WIDE // 2, len(a) - AFTER + self.WIDE - 1 - self.WIDE // 2
        inner, outer = slice(first, last), (slice(first), slice(last, None))
        left = LENGTH - codes.shape[1]
        tops = a[inner].max(0), np.maximum(*(a[o].max(0) for o in outer))
        sums = a[inner].sum(0).reshape(n, f) + left * np.maximum(w["bias"], 0), sum(a[o].sum(0) for o in outer).reshape(n, f)
        steps = last - first + left, len(a) - last + first
        pooled = np.concatenate([tops[0].reshape(n, f), sums[0] / steps[0], tops[1].reshape(n, f), sums[1] / steps[1]], axis=1)
        return cols, a, (pooled, tops, (inner, *outer), steps), np.einsum("ij,j->i", pooled, w["out"]) + w["zero"][0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        z = np.empty(len(codes), self.w["out"].dtype)
        for own, part in self._by_length(codes):
            z[own] = self._forward(part)[3]
        return z

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return self.score_of(self.logits(codes))

    def score_of(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))

    def fit(self, codes: np.ndarray, y: np.ndarray, rounds: int = 14, size: int = 64, rate: float = 0.01) -> None:
        rng = np.random.default_rng(5)
        step = Adam(self, rate)
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
        for _ in range(rounds):
            order = rng.permutation(len(y))
            for s in range(0, len(y), size):
                own = order[s : s + size]
                step(codes[own], y[own], weight[own])

    def learn(self, blocks: Iterable[tuple[np.ndarray, np.ndarray]], made: tuple[np.ndarray, np.ndarray], rate: float) -> int:
        """Go through all findings of the blocks once, with made-up ones beside them; how many there were.

        In a step each class of the findings and of the made-up ones has the same weight.  Where a
        block has few positives, they come again.
        """
        rng = np.random.default_rng(7)
        step, seen = Adam(self, rate), 0
        pools = [np.flatnonzero(made[1] == label) for label in (0, 1)]
        for codes, y in blocks:
            seen += len(y)
            own = [rng.permutation(np.flatnonzero(y == label)) for label in (0, 1)]
            steps = -(-len(y) // STEP)
            sizes = [-(-len(own[0]) // steps), max(-(-len(own[1]) // steps), min(LEAST, len(own[1])))]
            for s in range(steps):
                real = [o.take(range(s * n, (s + 1) * n), mode="wrap") if n else o for o, n in zip(own, sizes)]
                fill = [rng.choice(p, MADE // 2) for p in pools]
                label = np.concatenate([y[r] for r in real] + [made[1][f] for f in fill])
                weight = np.concatenate([np.full(len(r), len(label) / len(r) / 4) for r in real + fill if len(r)])
                step(np.concatenate([codes[r] for r in real] + [made[0][f] for f in fill]), label, weight)
        return seen

    def _gradients(self, codes, y, weight):
        total = {k: np.zeros_like(v) for k, v in self.w.items()}
        for own, part in self._by_length(codes):
            for k, g in self._sums(part, y[own], weight[own] / len(y)).items():
                total[k] += g
        return total

    def _sums(self, codes, y, weight):
        w, n, f = self.w, len(y), self.FILTERS
        cols, a, (pooled, tops, (inner, *outer), steps), z = self._forward(codes)
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight).astype(a.dtype)
        g = {"out": np.einsum("ij,i->j", pooled, d), "zero": np.array([d.sum()], a.dtype)}
        left = LENGTH - codes.shape[1]
        top, mean, top_out, mean_out = (d[:, None] * x for x in w["out"].reshape(4, f))
        da = np.empty_like(a)
        for parts, most, up, level in (((inner,), tops[0], top, mean / steps[0]), (outer, tops[1], top_out, mean_out / steps[1])):
            # Steps that reach the maximum together share what it is given.
            at = [a[p] == most for p in parts]
            up = up.ravel() / sum(x.view(np.uint8).sum(0, dtype=np.uint8) for x in at)
            for p, x in zip(parts, at):
                np.multiply(x, up, out=da[p])
                da[p] += level.ravel()
        da *= a > 0
        g["bias"] = da.sum(0).reshape(n, f).sum(0) + left * (w["bias"] > 0) * mean.sum(0) / steps[0]
        da = da.reshape(-1, f)
        g["conv"] = cols.T @ da
        back = w["conv"] @ da.T
        each = np.zeros((self.DEEP, codes.size), a.dtype)
        for j in range(self.WIDE):
            each[:, j * n : j * n + len(da)] += back[j * self.DEEP : (j + 1) * self.DEEP]
        cells = codes.T.ravel().astype(np.intp)
        embed = np.stack([np.bincount(cells, x, self.CODES) for x in each], 1)
        embed[0] = 0
        g["embed"] = embed.astype(a.dtype)
        return g

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.w.values()])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for k, x in self.w.items():
            self.w[k] = values[at : at + x.size].reshape(x.shape).astype(x.dtype)
            at += x.size

    def calibrate(self, codes: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Logistic fit of the held-out scores; the highest threshold with that recall."""
        self.settle([(self.logits(codes).astype(np.float64), y, np.ones(len(y)))], recall)

    def settle(self, groups: list[tuple[np.ndarray, np.ndarray, np.ndarray]], recall: float) -> None:
        """The same from groups of held-out logits, labels and counts; the threshold has that recall in each group."""
        z, y, _ = (np.concatenate(c) for c in zip(*groups))
        # Each class of a group has the same weight, and all together weigh as 1,000 findings at most.
        weight = np.concatenate([n / np.where(y == 1, n[y == 1].sum(), n[y == 0].sum()) for _, y, n in groups])
        weight *= min(sum(n.sum() for *_, n in groups), 1000) / max(weight.sum(), 1)
        good, bad = weight[y == 1].sum(), weight[y == 0].sum()
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            h = weight * np.maximum(p * (1 - p), 1e-6)
            # Targets are smoothed, so that separable findings keep finite scores.
            t = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
            grad = np.array([(weight * (p - t) * z).sum() + 1e-3 * a, (weight * (p - t)).sum()])
            hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, grad), -1, 1)
        self.scale, self.shift = float(max(a, 1e-3)), float(b)
        ordered = []
        for z, y, n in groups:
            z, n = z[y == 1], n[y == 1]
            order = z.argsort()
            if len(z):
                ordered.append((self.score_of(z[order]), np.cumsum(n[order])))
        if ordered:
            # Of n positives in order, as many stay below as the recall leaves.
            at = [s[np.searchsorted(c, np.floor((1 - recall) * c[-1]), side="right")] for s, c in ordered]
            self.threshold = float(min(at)) - 1e-9
            below = [np.concatenate([[0], c])[np.searchsorted(s, self.threshold)] / c[-1] for s, c in ordered]
            self.recall = 1 - float(max(below))


HEXES, BASE64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def made_up(rng: random.Random, words: list[str]) -> list[tuple[np.ndarray, int]]:
    """Labelled findings of forms that a table may lack: keys of other vendors, and harmless tokens."""
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    word = lambda: rng.choice(words)
    positives = [
        lambda: (f"{rng.choice(['private_key', 'client_key', 'auth', 'credential', 'pwd'])}{rng.choice(['=', ': ', ' = '])}", pick(BASE64, rng.randint(20, 44))),
        lambda: ("Authorization: Bearer ", pick(BASE64 + "-_", rng.randint(24, 60))),
        lambda: (word() + " ", rng.choice(["ghp_", "sk_live_", "xoxb-", "glpat-", "AIza"]) + pick(BASE64, rng.randint(24, 36))),
        lambda: (word() + " ", pick(BASE64 + "+/", 40)),
        lambda: (word() + " ", pick(HEXES.upper(), rng.choice([32, 40, 64]))),
    ]
    day = lambda: f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    negatives = [
        lambda: ("see ", f"www.{word()}.example.com/{word()}/{rng.randint(1, 9999)}".replace(" ", "")),
        lambda: (word() + " ", f"{word()}-{word()}-{word()}-{rng.randint(1, 99)}"),
        lambda: ("on ", day() + "T10.20.30" + "." + pick("0123456789", 6)),
        lambda: ("call ", "-".join(pick("0123456789", 4) for _ in range(4))),
        lambda: (word() + " ", "=" * rng.randint(16, 40) + str(rng.randint(1, 9))),
        lambda: (word() + " ", "".join(word().strip(".,").title() for _ in range(5))),
        lambda: ("file ", f"{word()}_{word()}_v{rng.randint(1, 20)}.{rng.randint(0, 9)}.tar.gz"),
        lambda: (word() + " ", pick("0123456789", rng.randint(16, 24))),
        lambda: (word() + " ", f"{word()}/{word()}/{word()}/{rng.randint(1, 99)}.html"),
    ]
    out = []
    for label, makers in ((1, positives), (0, negatives)):
        for _ in range(600):
            left, token = rng.choice(makers)()
            left, right = f"{word()} {word()} {left}", f" {word()} {word()}"
            out += [(w, label) for w in windows(left + token + right, len(left), len(left) + len(token))]
    return out


LONG_WORD = re.compile(r"(?<!\S)\S{10,}")


def labelled(text: str) -> Iterator[tuple[int, int, int]]:
    """Stretches of all base findings with 1, of all ordinary long words with 0."""
    spans = base_spans(text)
    for _, start, end in spans:
        yield from ((*p, 1) for p in parts(start, end))
    for start, end in untouched((m.span() for m in LONG_WORD.finditer(text)), spans):
        yield from ((*p, 0) for p in parts(start, end))


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and labels of all findings in column text, in blocks of bounded size."""
    rows, labels, held = [], [], 0
    for batch in batches:
        for text in texts_of(batch.column("text")):
            found = labelled(text)
            while own := list(islice(found, BLOCK - held)):
                rows.append(window_rows(text, [x[:2] for x in own]))
                labels += [x[2] for x in own]
                held += len(own)
                if held == BLOCK:
                    yield np.concatenate(rows), np.array(labels, np.float32)
                    rows, labels, held = [], [], 0
    if held:
        yield np.concatenate(rows), np.array(labels, np.float32)


def train(docs: DataFrame, documents: int | None = None, recall: float = RECALL) -> CharNet:
    """Fit the network on the findings of all documents, or of those with the smallest id hashes if a number is given."""
    bounded(docs.sparkSession)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    if documents is not None:
        chosen = texts.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
        texts = texts.join(F.broadcast(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)), "doc_id")
    rng = random.Random(17)
    words = ["the", "of", "and", "data", "report", "value", "config", "release", "window", "market"]
    made = made_up(rng, words)
    rng.shuffle(made)
    codes, y = np.stack([c for c, _ in made]), np.array([v for _, v in made], np.float32)
    kept = len(y) // 4
    net = CharNet()
    net.fit(codes[kept:], y[kept:])
    part = F.pmod(F.xxhash64("text"), F.lit(SLICES))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // SLICES // GROUP_TEXT))
    for turn in range(ROUNDS):
        train_round(net, texts.where(part == turn), groups, (codes[kept:], y[kept:]), 0.03 / (turn + 2))
    own = held_out_logits(net, texts.where(part >= ROUNDS))
    net.held_out = int(own[2].sum())
    net.settle([own, (net.logits(codes[:kept]).astype(np.float64), y[:kept], np.ones(kept))], recall)
    return net


def train_round(net: CharNet, texts: DataFrame, groups: int, made: tuple[np.ndarray, np.ndarray], rate: float) -> None:
    """Every group of texts trains a copy of the network; it becomes their average by findings."""
    sent = texts.sparkSession.sparkContext.broadcast((net, made))  # some hundred kilobytes
    order = F.xxhash64("doc_id", "text")
    grouped = texts.repartition(groups, "doc_id", "text").sortWithinPartitions(order, "doc_id", "text").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, beside = copy.deepcopy(sent.value)
        seen = own.learn(blocks_of(batches), beside, rate)
        if seen:
            # Sums of whole numbers; the last one counts findings.
            sums = np.append(np.rint(own.flat().astype(np.float64) * WHOLE).astype(np.int64), 1) * seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["at", "total"])

    sums = grouped.mapInArrow(run, "at int, total long").groupBy("at").agg(F.sum("total")).orderBy("at").collect()
    if sums:
        count = sums[-1][1]
        net.set_flat(np.array([r[1] for r in sums[:-1]]) / count / WHOLE)
        net.trained += count


def held_out_logits(net: CharNet, texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of all findings by bin (its lower edge), with label and count."""
    sent = texts.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * FAR * BINS), np.int64)
        for codes, y in blocks_of(batches):
            z = np.concatenate([sent.value.logits(codes[i : i + 512]) for i in range(0, len(y), 512)])
            at = np.clip(np.floor((z + FAR) * BINS), 0, counts.shape[1] - 1).astype(np.int64)
            np.add.at(counts, (y.astype(np.int64), at), 1)
        label, at = counts.nonzero()
        columns = [pa.array(label.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[label, at])]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "at", "n"])

    found = texts.select("text").mapInArrow(run, "label int, at int, n long")
    rows = np.array(found.groupBy("label", "at").agg(F.sum("n")).orderBy("label", "at").collect(), np.int64).reshape(-1, 3)
    return rows[:, 1] / BINS - FAR, rows[:, 0].astype(np.float32), rows[:, 2].astype(np.float64)


def in_blocks(rows: list, size: int = 512) -> list[list]:
    """Lists of bounded length, so that a text of many candidates needs no more memory."""
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def spans_of(text: str, net: CharNet) -> list[Span]:
    """Base findings, and the candidates that the network takes for secrets."""
    base = base_spans(text)
    more = candidates(text, base)
    if more:
        rows = [windows(text, s, e) for _, s, e in more]
        firsts = np.cumsum([0, *map(len, rows)])[:-1]
        # A candidate is what its most suspicious part is.
        scores = np.concatenate([net.scores(np.stack(own)) for own in in_blocks([w for own in rows for w in own])])
        scores = np.maximum.reduceat(scores, firsts)
        base = in_order(base + [c for c, p in zip(more, scores) if p >= net.threshold])
    return base


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, net: CharNet, keep: tuple[str, ...] = ("doc_id",), redact: str | None = None) -> DataFrame:
    """Columns ``keep`` and secret_spans; with ``redact`` also clean_text, in which each span is replaced."""
    spark = bounded(docs.sparkSession)
    model = spark.sparkContext.broadcast(net)  # some ten kilobytes
    source = docs.select(*keep, docs["text"].alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)

    def make():
        own = model.value

        def run(batch: pa.RecordBatch) -> dict:
            spans, clean = [], []
            for value in batch.column(len(keep)):
                text = value.as_py()
                found = spans_of(text or "", own)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                if redact is not None:
                    clean.append(text if text is None else without(text, found, redact))
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            columns = {name: batch.column(i) for i, name in enumerate(keep)} | {"secret_spans": pa.array(spans, kind)}
            return columns | ({"clean_text": pa.array(clean, pa.string())} if redact is not None else {})

        return run

    return arrow_pass(source, f"{kinds}, secret_spans {SPANS}" + ", clean_text string" * (redact is not None), make)


def without(text: str, spans: list[Span], mark: str) -> str:
    """The text with every stretch of touching spans replaced by the mark."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans_text(spans, kinds: tuple[str, ...] = KINDS):
    """kind:start:end of the spans of some kinds, comma-joined, as a column."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
