"""Text functions against literal results and the Python standard library."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.functions import catalog
from millrace.functions import text as X
from millrace.functions.ids import uuid5_dns

MIXED = [
    "",
    "plain",
    'q"uote \\ back/slash',
    "line\nbreak\r\ttab\b\f",
    "bell\x07del\x7f\x1e\x00end",
    "é à 漢字   \U00020bb7\U0001f600",
    "  　\n",
    "\x1c padded \x85",
]


def _apply(spark, function, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = frame.select("i", function(F.col("t")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


def test_json_escape_equals_python(spark):
    assert _apply(spark, X.json_escape, MIXED) == [json.dumps(t)[1:-1] for t in MIXED]
    assert _apply(spark, X.json_escape, [None]) == [None]


def test_strip_equals_python(spark):
    assert _apply(spark, X.strip, MIXED) == [t.strip() for t in MIXED]
    assert _apply(spark, X.is_blank, [*MIXED, None]) == [t.strip() == "" for t in MIXED] + [True]


def test_uuid5_equals_python(spark):
    names = ["other-text", "ingredients-2 oz gin é漢"]
    assert _apply(spark, uuid5_dns, names) == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("# Title #1\ntext", "Title #1\ntext"),
        ("**b** *i* ***bi*** ~~s~~", "b i bi s"),
        ("**a *b* c**", "a b c"),
        ("snake_case and _em_ and __strong__", "snake_case and em and strong"),
        ("2 * 3 * 4", "2 * 3 * 4"),
        ("![alt](u) [text](v) <https://x.y/z>", "alt text https://x.y/z"),
        ("> quote\n>> deep", "quote\ndeep"),
        ("- a\n* b\n1. c\n- [x] d", "a\nb\nc\nd"),
        ("a\n---\nb\n***\nc", "a\n\nb\n\nc"),
        ("| a | b |\n|---|---|\n| 1 | 2 |", "a b\n\n1 2"),
        ("```json\n{}\n```", "{}"),
        ("```\nopen only", "open only"),
        ("```", ""),
        ("text\n```", "text\n"),
        ("a `code` b", "a code b"),
        ("-" * 20000, ""),
    ],
)
def test_markdown(spark, given, expected):
    assert _apply(spark, X.clean_markdown, [given]) == [expected]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("<p>a &amp; <b>b</b></p>", "a & b"),
        ("x<script>var a='</p>';</script>y", "xy"),
        ("<STYLE>p{}</STYLE>x<!-- c\n -->y", "xy"),
        ("a<br/>b<BR>c", "a\nb\nc"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("&lt;tag&gt; &amp;lt; &quot;q&#39;", "<tag> &lt; \"q'"),
        ("<pre>k</pre><param>z", "k\nz"),
    ],
)
def test_html(spark, given, expected):
    assert _apply(spark, X.clean_html, [given]) == [expected]


def test_emoji(spark):
    family = "\U0001f468‍\U0001f469‍\U0001f467"
    texts = [f"a{family}b", "1️⃣ 2", "\U0001f1eb\U0001f1f7x", "\U0001f44d\U0001f3fd!", "❤️", "漢字é 9#*"]
    assert _apply(spark, X.strip_emoji, texts) == ["ab", " 2", "x", "!", "", "漢字é 9#*"]


def test_sql_functions_equal_column_functions(spark):
    catalog.register_sql_functions(spark)
    texts = MIXED + ["# **a** <b>b</b> \U0001f600\n```x```", "'quoted' $1 \\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for name in catalog.sql_bodies():
        both = frame.select(F.expr(f"{name}(t)").alias("a"), catalog.column_function(name, "t").alias("b")).collect()
        assert all(r["a"] == r["b"] for r in both), name


def test_symbols_that_are_no_emoji_stay(spark):
    keep = "★ ✓ ♩ ➔ \U0001f0a1 \U0001f701"
    frame = spark.createDataFrame([(keep, "a✔️b☀c\U0001f389d❤e")], "keep string, drop string")
    row = frame.select(X.strip_emoji(F.col("keep")).alias("k"), X.strip_emoji(F.col("drop")).alias("d")).first()
    assert (row.k, row.d) == (keep, "abcde")
