"""Costly text and JSON steps run once per row, and the short ways give what the rules give."""

import random

from pyspark.sql import functions as F

from millrace.functions import chunks as C
from millrace.functions import text as X
from millrace.functions.plan import once
from millrace.operators import decode, infer

BITS = (
    "* ** *** _ __ ~~ ` ``` # - -- --- === | > [a](b) ![p](q) <http://x.y> <b> </p> <p> <!--c--> <!D> <script>z</script> &amp; &lt; &#39; &nbsp; &quot;"
    " © é 漢 \U0001f468‍\U0001f469 1️⃣ ❤️ Gin bitters origin or the winter with ſecret Kup ünd 1. 2) a_b Note: SHAKEN"
).split() + [" ", "  ", "\t", "\n", "\n\n", " ", "\x07", "\x7f", "\\", '"']


def _texts(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randint(0, 30)))) for i in range(3000)]
    return spark.createDataFrame([*rows, (-1, None)], "i long, t string").repartition(4)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_groups_equal_rules(spark):
    t = F.col("t")
    for rules, groups in ((X.MARKDOWN_RULES, X.MARKDOWN_GROUPS), (X.HTML_RULES, X.HTML_GROUPS)):
        assert [n for numbers, _ in groups for n in numbers] == list(range(len(rules)))
        pairs = _texts(spark).select("t", X.apply_rules(t, rules).alias("a"), X.apply_groups(t, rules, groups).alias("b"))
        assert pairs.filter(~F.col("a").eqNullSafe(F.col("b"))).take(1) == []
    pairs = _texts(spark).select(X.apply_rules(t, [X.KEYCAP_RULE, X.EMOJI_RULE]).alias("a"), X.strip_emoji(t).alias("b"))
    assert pairs.filter(~F.col("a").eqNullSafe(F.col("b"))).take(1) == []


def test_category_equals_counts_of_each(spark):
    t = F.col("t")
    rows = _texts(spark).filter(t.isNotNull()).select(C.categorize(t).alias("got"), *[C.cue_score(t, name).alias(name) for name in C.CUES])
    for row in rows.collect():
        counts = [row[name] for name in C.CUES]
        best = list(C.CUES)[counts.index(max(counts))] if max(counts) > 0 else C.FALLBACK
        assert row.got == best


def test_blank_check_cleans_once(spark):
    plan = _plan(once(_texts(spark), b=X.is_blank(X.clean_text(F.col("t")))))
    assert plan.count("<script") == 1


def test_json_is_parsed_once(spark):
    plan = _plan(once(_texts(spark), v=decode.strict_json(F.col("t"))))
    assert plan.count("parseJson") == 1 and plan.count("lengthOfJsonArray") == 1
    plan = _plan(once(_texts(spark), v=infer.parse_answer(F.col("t"))))
    assert plan.count("from_json") + plan.count("jsontostructs") <= 2


def test_strict_json(spark):
    good = {"1": "1", ' {"a":[1,2]} ': '{"a":[1,2]}', "[]": "[]", "null": "null", '"x"': '"x"', '{"a":1,"a":2}': '{"a":2}'}
    bad = ["", " ", "1 2", "1,2", "1]", "1}", '1},{"v":2', "1],[2", '1,"v":2', "1,", "[1", "{'a':1}", "NaN", "01", "tru", '"a\tb"', "1} x", None]
    rows = spark.createDataFrame([(x,) for x in [*good, *bad]], "t string")
    read = rows.select("t", F.to_json(decode.strict_json(F.col("t"))).alias("v"), decode.is_json(F.col("t")).alias("ok")).collect()
    assert {r.t: r.v for r in read} == good | dict.fromkeys(bad)
    assert {r.t: r.ok for r in read} == dict.fromkeys(good, True) | dict.fromkeys(bad, False) | {None: None}
