"""Base spans against the patterns as written; the network by held-out findings."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import secrets

PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
TEXTS = [
    None, "", "password=12345678", "PassWord : 'abcdefgh'", "token=short", 'my_api_key"="ABCDEFGHIJ" apikey: x12345678',
    "AKIA" + "A" * 11, "AKIA" + "A" * 12 + " AKIAKIA" + "0" * 20, "f" * 31, "f" * 32 + "g" + "0" * 40, "token=token=token=aaaaaaaa",
    "é" * 50 + " secret = " + "a1" * 30, "ſecret=12345678 toKen=12345678", "x" * 300_000 + " password=abcdefgh1",
    "nothing here at all", "key sk_live_" + "aB3dE5gH7jK9" * 3,
]


def plain(text):
    found = []
    for n, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        flags = re.A
        found += [(m.start(), n, m.end(), kind) for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_base_spans():
    for text in TEXTS:
        assert secrets.base_spans(text or "") == plain(text)
    rng = random.Random(1)
    parts = ["password", "token", "API_KEY", "=", ": ", " ", '"', "AKIA", "ABCDEF12345678", "0123456789abcdef", "deadbeef", "é", "\n", "."]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(30))
        assert secrets.base_spans(text) == plain(text)


@pytest.fixture(scope="module")
def net(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secrets.train(docs, 1000)


def test_held_out_findings(net):
    rows = secrets.made_up(random.Random(99), ["onthe", "ering.", "wordy", "thans,", "les"])
    codes, y = np.stack([c for c, _ in rows]), np.array([v for _, v in rows])
    said = net.scores(codes) >= net.threshold
    assert said[y == 1].mean() > 0.9
    assert said[y == 0].mean() < 0.1


def test_gradients():
    rng = np.random.default_rng(0)
    codes, y = rng.integers(0, 98, (6, secrets.LENGTH)).astype(np.int16), np.array([0, 1, 0, 1, 1, 0], np.float32)
    net = secrets.CharNet()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    ones = np.ones(6)
    loss = lambda: np.mean(np.log1p(np.exp(-(2 * y - 1) * net.logits(codes))))
    g = net._gradients(codes, y, ones)
    for name in net.w:
        flat = net.w[name].reshape(-1)
        for at in rng.integers(0, len(flat), 4):
            old, e = flat[at], 1e-5
            flat[at] = old + e
            up = loss()
            flat[at] = old - e
            down = loss()
            flat[at] = old
            if name != "embed" or at >= net.DEEP:
                assert abs((up - down) / (2 * e) - g[name].reshape(-1)[at]) < 1e-4


def test_table(spark, net):
    rows = [(i, t, i, "clash") for i, t in enumerate(TEXTS)] + [(0, None, 0, "x"), (None, TEXTS[2], 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secret_spans long, clean_text string")
    got = secrets.find_secrets(docs, net, redact="<secret>").collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text in enumerate(TEXTS):
        spans = [(s.kind, s.start, s.end) for s in by_id[i].secret_spans]
        assert [s for s in spans if s[0] != "network"] == plain(text)
        assert (by_id[i].clean_text is None) == (text is None)
        if text is not None and not spans:
            assert by_id[i].clean_text == text
    assert by_id[2].clean_text == "<secret>"
    assert by_id[len(TEXTS) - 1].secret_spans[0].kind == "network"
    assert secrets.find_secrets(docs.limit(0), net).count() == 0
    assert secrets.train(docs.limit(0)).threshold >= 0.5


def test_every_character_of_a_candidate_is_read():
    text = "see " + "a" * 300 + " end"
    for length in (16, 56, 57, 100, 200):
        rows = secrets.windows(text, 4, 4 + length)
        assert all((r[secrets.BEFORE + secrets.INSIDE :] > 0).any() for r in rows)
        marked = [secrets.windows(text[: 4 + i] + "#" + text[5 + i :], 4, 4 + length) for i in range(length)]
        mark = ord("#") - 30
        inner = slice(secrets.BEFORE, secrets.BEFORE + secrets.INSIDE)
        assert all(any(mark in r[inner] for r in own) for own in marked)


def test_middle_of_a_long_candidate_decides(net):
    harmless = "the/of/and/data/report/value/" * 3
    key = "aB3dE5gH7jK9mN2pQ4rS6tU8vW0xY1zA3bC5dE7f" * 2
    assert "network" in {k for k, *_ in secrets.spans_of(f"x {harmless}{key}{harmless}1 y", net)}
    assert secrets.spans_of(f"x {harmless}{harmless}{harmless}1 y", net) == []


def test_candidates_among_many_base_spans():
    text = "password=" + "a1b2c3d4" * 3 + " " + "0" * 40 + " aB3dE5gH7jK9mN2pQ4rS " + " ".join("f" * 40 for _ in range(8)) + " zB3dE5gH7jK9mN2pQ4rS"
    base = secrets.base_spans(text)
    free = [text[s:e] for _, s, e in secrets.candidates(text, base)]
    assert free == ["aB3dE5gH7jK9mN2pQ4rS", "zB3dE5gH7jK9mN2pQ4rS"]


def test_threshold_follows_the_recall(net):
    assert net.recall >= secrets.RECALL
    rng = np.random.default_rng(1)
    codes, y = rng.integers(0, 98, (400, secrets.LENGTH)).astype(np.int16), (np.arange(400) % 2).astype(np.float32)
    poor = secrets.CharNet()
    poor.calibrate(codes, y, 0.98)  # nothing to learn: only a low threshold reaches the recall
    assert poor.threshold < 0.5 and poor.recall >= 0.98


def plain_findings(text):
    """Findings that carry a label, as windows: base ones, and long words that none of them touches."""
    base = plain(text)
    words = [m.span() for m in re.finditer(r"[^\s]{10,}", text or "")]
    free = [w for w in words if not any(s < w[1] and w[0] < e for _, s, e in base)]
    return sum(len(secrets.windows(text, s, e)) for s, e in [x[1:] for x in base] + free)


def many(last="zebra"):
    rows = []
    for i in range(60):
        words = [f"ordinary{j}word{i}" for j in range(5)] + [f"password={i:08}{j}" for j in range(5)]
        rows.append((i, " and ".join([*words, f"{last}{i:04}{last}", "", "x" * 300])))
    return [*rows, (None, "unnamedordinary word"), (3, None), (4, ""), (5, rows[5][1]), (5, rows[5][1])]


def test_every_finding_trains_or_is_held_out(spark):
    rows = many()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    net = secrets.train(docs)
    assert net.trained + net.held_out == sum(plain_findings(t) for _, t in rows)
    assert net.trained > 0 and net.held_out > 0
    # Tables that differ beyond the third finding of each document alone give different networks.
    other = secrets.train(spark.createDataFrame(many("QUAGGA"), docs.schema))
    assert any((net.w[k] != other.w[k]).any() for k in net.w)


def test_network_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.createDataFrame(many(), "doc_id long, text string")
    one, two = secrets.train(docs.repartition(5)), secrets.train(docs.orderBy("text").coalesce(1))
    assert all((one.w[k] == two.w[k]).all() for k in one.w)
    assert (one.threshold, one.scale, one.shift) == (two.threshold, two.scale, two.shift)


def test_blocks_hold_all_windows(monkeypatch):
    texts = [t for _, t in many()]
    batches = [pa.RecordBatch.from_pydict({"text": texts[i : i + 20]}) for i in range(0, len(texts), 20)]
    whole = list(secrets.blocks_of(iter(batches)))
    monkeypatch.setattr(secrets, "BLOCK", 7)
    cut = list(secrets.blocks_of(iter(batches)))
    assert max(len(y) for _, y in cut) == 7
    for i in (0, 1):
        assert (np.concatenate([b[i] for b in cut]) == np.concatenate([b[i] for b in whole])).all()
    assert sum(len(y) for _, y in whole) == sum(map(plain_findings, texts))


def test_a_round_reads_each_finding(monkeypatch):
    rng = np.random.default_rng(2)
    for positives, negatives in ((0, 300), (300, 0), (3, 500), (250, 250), (1, 1)):
        codes = np.full((positives + negatives, secrets.LENGTH), 1, np.int16)
        codes[:, :2] = 10 + np.stack(divmod(np.arange(len(codes)), 80), 1)
        y = rng.permutation(np.repeat(np.array([1, 0], np.float32), [positives, negatives]))
        made = np.full((4, secrets.LENGTH), 5, np.int16), np.array([0, 1, 0, 1], np.float32)
        seen = []
        monkeypatch.setattr(secrets.CharNet, "_gradients", lambda self, c, y, w: seen.append((c, y, w)) or {})
        assert secrets.CharNet().learn([(codes, y)], made, 0.01) == len(y)
        got = {(*c[:2], label) for cs, ys, _ in seen for c, label in zip(cs, ys)}
        assert got >= {(*c[:2], label) for c, label in zip(codes, y)}
        for _, ys, w in seen:
            if positives > 1 and negatives > 1:
                assert abs(w[ys == 1].sum() - w[ys == 0].sum()) < 1e-3


def test_short_findings_without_their_padding():
    texts = ["see abcdefghij here", "abcdefghijklmnop", "x abcdefghijklmnopq", "two  " + "a1" * 28, "ends with abcdefghijk"]
    codes = np.concatenate([secrets.window_rows(t, [(a, len(t) - b)]) for t in texts for a, b in ((0, 0), (4, 1))])
    net = secrets.CharNet()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.w["bias"] = np.random.default_rng(1).normal(0, 0.3, net.FILTERS)
    whole = net._forward(codes)[3]
    assert np.allclose(net.logits(codes), whole)
    y, weight = (np.arange(len(codes)) % 2).astype(np.float32), np.ones(len(codes))
    cut, all_steps = net._gradients(codes, y, weight), net._sums(codes, y, weight / len(y))
    assert all(np.allclose(cut[k], all_steps[k]) for k in cut)


def test_threshold_reaches_the_recall_in_each_group():
    rng = np.random.default_rng(4)
    groups = []
    for shift, n in ((2.0, 5000), (-1.0, 100)):
        y = (np.arange(n) % 2).astype(np.float32)
        groups.append((rng.normal(shift * y, 0.5), y, rng.integers(1, 4, n).astype(float)))
    net = secrets.CharNet()
    net.settle(groups, 0.98)
    reached = [n[(y == 1) & (net.score_of(z) >= net.threshold)].sum() / n[y == 1].sum() for z, y, n in groups]
    assert min(reached) >= 0.98 and abs(net.recall - min(reached)) < 1e-9


def plain_sums(net, codes, y, weight):
    """Gradients step by step, one finding after the other."""
    w, half = net.w, net.WIDE // 2
    embed = w["embed"].copy()
    embed[0] = 0
    g = {k: np.zeros_like(x) for k, x in w.items()}
    first, last = secrets.BEFORE - half, secrets.LENGTH - secrets.AFTER - net.WIDE + 1 + half
    for row, label, own in zip(codes, y, weight):
        cols = np.stack([embed[row[i : i + net.WIDE]].ravel() for i in range(secrets.LENGTH - net.WIDE + 1)])
        a = np.maximum(cols @ w["conv"] + w["bias"], 0)
        halves = np.arange(first, last), np.r_[:first, last : len(a)]
        pooled = np.concatenate([f(a[h], axis=0) for h in halves for f in (np.max, np.mean)])
        d = (1 / (1 + np.exp(-(pooled @ w["out"] + w["zero"][0]))) - label) * own
        g["out"] += d * pooled
        g["zero"] += d
        da = np.zeros_like(a)
        for h, (top, mean) in zip(halves, w["out"].reshape(2, 2, -1)):
            da[h] += d * mean / len(h)
            da[h[a[h].argmax(0)], np.arange(net.FILTERS)] += d * top
        da *= a > 0
        g["conv"] += cols.T @ da
        g["bias"] += da.sum(0)
        for i, back in enumerate((da @ w["conv"].T).reshape(len(a), net.WIDE, net.DEEP)):
            for code, x in zip(row[i : i + net.WIDE], back):
                g["embed"][code] += x * (code > 0)
    return g


def test_gradients_are_those_of_plain_steps():
    # Repeated characters: several steps reach a maximum together.
    texts = ["see " + "ab" * 30 + " aaaaaaaaaaaaaa", "x " + "a" * 70, "the abcdabcdabcd the abcdabcdabcd", "key=" + "aB3dE5gH" * 5]
    codes = np.concatenate([secrets.window_rows(t, [(4, len(t) - 3), (6, 18)]) for t in texts])
    y, weight = (np.arange(len(codes)) % 2).astype(np.float32), np.linspace(0.5, 1.5, len(codes))
    net = secrets.CharNet(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    net.w["bias"] = np.random.default_rng(1).normal(0, 0.3, net.FILTERS)
    got, want = net._gradients(codes, y, weight * len(y)), plain_sums(net, codes, y, weight)
    assert all(np.allclose(got[k], want[k]) for k in net.w)


def test_tables_of_a_step_run_over_all_its_findings():
    codes = np.random.default_rng(0).integers(1, 98, (150, secrets.LENGTH)).astype(np.int16)
    codes[:146, secrets.BEFORE + secrets.SHORT : secrets.BEFORE + secrets.INSIDE] = 0
    net = secrets.CharNet()
    lots = list(net._by_length(codes))
    assert sorted(i for rows, _ in lots for i in rows) == list(range(150))
    assert sorted(len(rows) for rows, _ in lots) == [4, 48, 49, 49]  # no small rest, which costs nearly as much
    for _, part in lots:
        table = net._forward(part)[1]
        assert table.shape == (part.shape[1] - net.WIDE + 1, len(part) * net.FILTERS) and table.flags.c_contiguous
