"""Line rules against a plain Python version."""

import random
import re
from collections import Counter, defaultdict

from millrace.llm import lines

KIND = "doc_id long, text string, source string, n_words long, kept boolean, place int"


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain(rows, most):
    docs = defaultdict(set)
    norm = lambda x: re.sub("[1-9]", "0", re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower())
    own = [[x for x in (t or "").split("\n") if split(x)] for _, t, _ in rows]
    for (_, t, s), ls in zip(rows, own):
        for x in ls:
            docs[s, norm(x)].add(t)
    bad = {k for k, texts in docs.items() if len(texts) >= most}
    out = []
    for (d, t, s), ls in zip(rows, own):
        w = split(t)
        wins = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        c = Counter(wins)
        repeated = len({i + j for i, x in enumerate(wins) if c[x] > 1 for j in range(8)})
        gone = sum(len(split(x)) for x in ls if (s, norm(x)) in bad)
        base = len(w) < 20 or 100 * repeated > 30 * len(w)
        depleted = gone > 0 and (len(w) - gone < 20 or 100 * gone > 80 * len(w))
        out.append((d, len(w), sum(map(len, w)), sum((t or "").count(x) for x in "#*$%&|<>"), len(ls) - len(set(ls)), repeated, base,
                    not base and not depleted, gone))
    return out


def made():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé#1") for _ in range(rng.randint(1, 5)))
    rows = []
    for i in range(160):
        own = [" ".join(word() for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 8))]
        if i % 3 == 0:
            own.insert(rng.randint(0, len(own)), rng.choice(["Share this page 12 ", "share  this page 34", "SHARE this page 56"]))
        if i % 7 == 0:
            own += [own[0], "x y z a b c d e " * 3] if own else ["x y z a b c d e " * 2]
        rows.append((i, "\n".join(own), rng.choice(["s0", "s0", "s1", None, ""])))
    copy = "\n".join(" ".join(f"{w}{c}" for w in "copied line with some words in it".split()) for c in "abcdefgh")
    rows += [(i, copy, "s0") for i in range(200, 240)]
    rows += [(300, None, "s0"), (301, "", "s0"), (302, " \n\t\n", None), (303, "a b c d e f g h " * 2000, "s1"), rows[3], rows[3]]
    return rows + [(None, "null id " * 5 + "\n" + rows[0][1], "s0"), (None, rows[0][1], "s0")]


def test_rules(spark):
    rows = made()
    docs = spark.createDataFrame([(*r, 1, True, 2) for r in rows], KIND).repartition(4)
    for most in (5, 20):
        got = [tuple(r) for r in lines.judge(docs, most=most).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, plain(rows, most)))
    assert all(r[7] for r in got if r[0] is not None and 200 <= r[0] < 240)
    assert lines.judge(docs.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    text = lines.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_remove_lines(spark):
    name = [chr(97 + i % 26) + chr(97 + i // 26) for i in range(30)]
    rows = [(i, f"own {name[i]} words\n\nSubscribe now {i % 9}\nend {name[i]}é", "h") for i in range(30)] + [(99, "alone", "h"), (98, None, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.clean_text for r in lines.remove_lines(docs).collect()}
    assert got == {i: f"own {name[i]} words\n\nend {name[i]}é" for i in range(30)}


def test_verdicts_do_not_follow_the_size_of_the_table(spark):
    """A three-line header over 25 texts goes whole, beside few or many other documents; copies make nothing frequent."""
    head = "Terms of this site\nAll rights are reserved\nRead our rules first"
    body = lambda i, n: "\n".join(f"own line {chr(97 + i % 26)}{chr(97 + i // 26)} " + " ".join(f"{chr(97 + k)}{c}" for c in "qrstuvwxyzab") for k in range(n))
    rows = [(i, f"{head}\n{body(i, 3)}", "h") for i in range(25)]
    copies = [(1000 + i, body(600, 4), "h") for i in range(60)]
    for others in (0, 400):
        more = [(2000 + i, body(26 + i, 2), "h") for i in range(others)]
        docs = spark.createDataFrame(rows + copies + more, "doc_id long, text string, source string").repartition(3)
        got = {r.doc_id: (r.n_removed_words, r.kept) for r in lines.judge(docs).collect()}
        assert {got[i] for i in range(25)} == {(12, True)}
        assert {got[1000 + i] for i in range(60)} == {(0, True)}
        assert all(got[2000 + i] == (0, True) for i in range(others))
