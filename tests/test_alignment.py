"""Tolerant audits against a plain edit matrix."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import alignment, search


def plain(source, quote, most):
    row = [0] * (len(source) + 1)
    for i, x in enumerate(quote, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(source, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row) if min(row) <= most else None


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=40), st.text("abc", max_size=14), st.integers(0, 4))
def test_edits_equal_plain_matrix(source, quote, most):
    found = alignment.edits(source, quote, most)
    assert (found and found[0]) == plain(source, quote, most) or found == (0, 0) == (plain(source, quote, most), 0)


@settings(max_examples=200, deadline=None)
@given(st.text("ab é", min_size=30, max_size=80), st.integers(0, 20), st.lists(st.tuples(st.integers(0, 25), st.sampled_from("¤a")), max_size=4))
def test_damaged_quotes(source, start, damages):
    quote = list(source[start : start + 26])
    for at, letter in damages:
        quote[min(at, len(quote) - 1) :][:1] = letter
        quote[min(at, len(quote) - 1)] = letter
    quote = "".join(quote)
    found = alignment.edits(source, quote, 3)
    assert (found and found[0]) == plain(source, quote, 3)


def test_audit_rows(spark):
    rows = [(1, "the quick brown fox", "quick brown"), (2, "the quick brown fox", "quikc brown"), (3, "the quick brown fox", "lazy dogs here"),
            (4, None, "a"), (5, "a", None), (6, "", "a"), (7, "abc", ""), (8, "x" * 50_000 + "needle" + "y" * 50_000, "xxnedleyy"), (2, "again", "agaim")]
    frame = spark.createDataFrame(rows, "id int, source string, quote string")
    got = sorted(((r.id, r.edits) for r in alignment.audit(frame, "source", "quote", "id").collect()), key=repr)
    assert got == sorted([(1, 0), (2, 2), (3, None), (4, None), (5, None), (6, 1), (7, 0), (8, 1), (2, 1)], key=repr)
    assert alignment.audit(frame.limit(0), "source", "quote", "id").count() == 0


def test_pages_join_up(spark, tmp_path):
    rows = [(f"q{i % 7}", f"r{i}", float(i % 13)) for i in range(200)]
    frame = spark.createDataFrame(rows, "request_id string, record_id string, weighted_score double").repartition(6)
    search.write_ranking(frame, f"{tmp_path}/ranking")
    ranking = spark.read.parquet(f"{tmp_path}/ranking")
    expected = sorted(((q, r, s) for q, r, s in rows), key=lambda x: (-x[2], x[0], x[1]))
    seen, last = [], None
    while True:
        page = search.page_at(ranking, 0, 30) if last is None else search.page_after(ranking, last, 30)
        page = [(r.request_id, r.record_id, r.weighted_score) for r in page.collect()]
        if not page:
            break
        seen += page
        last = (page[-1][2], page[-1][0], page[-1][1])
    assert seen == expected
    assert search.page_after(ranking, (100.0, "", ""), 5).first().position == 0
    gone = search.page_after(ranking, (11.5, "q1", "r1"), 1).first()
    assert gone.weighted_score == 11.0
    plan = search.page_at(ranking, 60, 30)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(position" in plan and "LessThanOrEqual(position" in plan


@pytest.mark.parametrize("quote", ["", "a", "ab"])
def test_short_quotes(quote):
    assert alignment.edits("zzz", quote, 3)[0] == len(quote)
