"""Quality rules: cross-document line frequency, in DataFrame functions only.

Rules on one text come first (too few words, too many words in repeated windows).  Then
each line is normalised (lower case, digits as 0, spaces squeezed) and hashed with its
host.  A line is boilerplate when at least MOST_DOCUMENTS different documents of the host
hold it: documents of equal text are copies of one document and count once, however often
a text was copied.  So the verdict on a line only depends on the texts that hold it, not on
how many other documents there are.  Boilerplate lines are removed; a document that keeps
too few words is depleted and rejected.

Counts cover all documents.  Pairs of line and text are made distinct first and counted
with a map-side half, so a line in a third of all documents is a few rows when counts meet.
Null text has no words (base_failed).  Null is a host of its own.  Rows that repeat a text
are one document in the counts, and each gets a row.  Extra columns are ignored; an empty
table is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.plan import once
from millrace.llm.common import SPACES

WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
MOST_DOCUMENTS = 20
DEPLETED_PERCENT = 80  # removed share of the words from which a document is depleted
SYMBOLS = "[#*$%&|<>]"
BLANKS = r"[\x20\x09-\x0D]+"


def text_facts(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, row_key and the facts of each text on its own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", row_key(host).alias("row_key"), text.alias("t"))
    inner = F.btrim(F.col("t"), F.lit(SPACES))
    facts = once(plain, w=F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS)))
    facts = once(facts, h=F.transform("w", lambda w: F.xxhash64(w)), lines=word_lines(F.col("t")))
    window = F.transform(
        F.sequence(F.lit(0), F.size("h") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(WINDOW)]),
    )
    none = F.array().cast("array<bigint>")
    facts = once(facts, win=F.when(F.size("h") >= WINDOW, window).otherwise(none))
    # Most texts repeat no window; only the others sort theirs.
    pairs = F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    repeats = F.size(F.array_distinct("win")) < F.size("win")
    facts = once(facts, s=F.when(repeats, pairs))
    same = lambda i, j: F.get(F.col("s"), i)["x"] == F.get(F.col("s"), j)["x"]
    twice = F.filter("s", lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
    facts = once(facts, at=F.sort_array(F.transform(twice, lambda x: x["i"])))
    ahead = F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("at"), k + 1) - p, F.lit(WINDOW))))
    return facts.select(
        "doc_id",
        "row_key",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(ahead, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def row_key(host: str) -> Column:
    return F.xxhash64("doc_id", host, "text")


def line_words(line: Column) -> Column:
    """Words of a line that has one: the runs of separators inside it, and one."""
    return F.regexp_count(F.btrim(line, F.lit(SPACES)), F.lit(BLANKS)) + 1


def normalised(line: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))
    return F.regexp_replace(F.lower(squeezed), "[1-9]", "0")


def line_places(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, row_key, text_key, keys: the line keys of each text, in order, and the lines themselves."""
    facts = [row_key(host).alias("row_key"), F.xxhash64("text").alias("text_key"), F.col(host).alias("host")]
    lines = docs.select("doc_id", *facts, word_lines(F.col("text")).alias("lines"))
    lines = once(lines.where(F.size("lines") > 0), lines=F.col("lines"))
    # The null flag keeps a null host apart from an empty one.
    key = lambda x: F.xxhash64(F.col("host").isNull(), F.col("host"), normalised(x))
    return once(lines, keys=F.transform("lines", key)).select("doc_id", "row_key", "text_key", "lines", "keys")


def frequent_lines(docs: DataFrame, host: str = "source", most: int = MOST_DOCUMENTS) -> DataFrame:
    """Keys of lines that many different documents of a host hold, and how many."""
    places = line_places(docs, host)
    held = places.select("text_key", F.explode(F.array_distinct("keys")).alias("line_key")).distinct()
    return held.groupBy("line_key").agg(F.count("*").alias("docs")).where(F.col("docs") >= most)


def judge(docs: DataFrame, host: str = "source", most: int = MOST_DOCUMENTS) -> DataFrame:
    """The facts of each document, n_removed_words, base_failed and kept."""
    facts = text_facts(docs, host)
    places = line_places(docs, host).select("doc_id", "row_key", F.posexplode(F.arrays_zip("keys", "lines")).alias("place", "z"))
    occurrences = places.select("row_key", "place", F.col("z.keys").alias("line_key"), line_words(F.col("z.lines")).alias("words"))
    removed = (
        occurrences.join(frequent_lines(docs, host, most), "line_key", "left_semi")
        .groupBy("row_key", "place")  # rows that are equal in all columns share their places
        .agg(F.max("words").alias("words"))
        .groupBy("row_key")
        .agg(F.sum("words").alias("gone"))
    )
    joined = facts.join(removed, "row_key", "left").withColumn("n_removed_words", F.coalesce("gone", F.lit(0)).cast("long"))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & (
        (left < LEAST_WORDS) | (100 * F.col("n_removed_words") > DEPLETED_PERCENT * F.col("n_words"))
    )
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & ~depleted).alias("kept"), "n_removed_words",
    )


def remove_lines(docs: DataFrame, host: str = "source", most: int = MOST_DOCUMENTS) -> DataFrame:
    """doc_id, row_key and clean_text: the documents' text without its boilerplate lines.

    Lines without a word stay as they are; only documents that lose a line have a row.
    """
    lines = docs.select("doc_id", "text", row_key(host).alias("row_key"), F.col(host).alias("host"))
    lines = lines.select("doc_id", "row_key", "host", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    key = F.xxhash64(F.col("host").isNull(), F.col("host"), normalised(F.col("line")))
    marked = lines.withColumn("line_key", F.when(F.btrim(F.col("line"), F.lit(SPACES)) != "", key))
    found = marked.join(frequent_lines(docs, host, most).withColumnRenamed("docs", "seen"), "line_key", "left")
    # The lines of one document meet again: as many as the document has.
    whole = found.groupBy("row_key", "doc_id").agg(
        F.count("seen").alias("gone"),
        F.sort_array(F.collect_set(F.when(F.col("seen").isNull(), F.struct("place", "line")))).alias("rest"),
    )
    return whole.where("gone > 0").select("doc_id", "row_key", F.array_join(F.col("rest.line"), "\n").alias("clean_text"))


# The same in DuckDB SQL.  Words and lines are unnested, so windows are compared as text.
ORACLE = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id, source, text) AS rn FROM documents
), w AS (
  SELECT rn, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM d
), wins AS (
  SELECT rn, i, array_to_string(ws[i:i+7], ' ') AS win
  FROM (SELECT rn, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
), twice AS (
  SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, win) AS c FROM wins) WHERE c > 1
), rep AS (
  SELECT rn, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt FROM twice) GROUP BY rn
), l AS (
  SELECT rn, source, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM d
), lw AS (
  SELECT rn, source, line, p,
    translate(lower(trim(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'))), '123456789', '000000000') AS k,
    len(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS words
  FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), dup AS (
  SELECT rn, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY rn
), freq AS (
  SELECT lw.source, k FROM lw JOIN d USING (rn) GROUP BY lw.source, k HAVING count(DISTINCT t) >= 20
), gone AS (
  SELECT rn, sum(words) AS n FROM lw JOIN freq ON lw.k = freq.k AND lw.source IS NOT DISTINCT FROM freq.source GROUP BY rn
), f AS (
  SELECT d.doc_id, len(w.ws) AS n_words, len(translate(d.t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    len(d.t) - len(translate(d.t, '#*$%&|<>', '')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (rn) LEFT JOIN dup USING (rn) LEFT JOIN rep USING (rn) LEFT JOIN gone USING (rn)
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 20 OR 100 * n_removed_words > 80 * n_words)) AS kept,
  n_removed_words
FROM v
"""
