"""Queries over the chunk rules and their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import chunks as C
from millrace.operators import alignment, chunk, infer
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query

PIECE_LIMIT = 600


def _answer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk rows of all usable answers."""
    return chunk.chunk_rows(_usable(spark, sf_dir), "doc_id")


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.resolve(feeds.answered(spark, sf_dir)).filter("status = 'ok'")


@query(O.sql(f"SELECT doc_id, chunk_pos, category FROM f_answer_rows WHERE category NOT IN ({O.values(S.CATEGORIES)})"))
def category_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = chunk.category_violations(_answer_rows(spark, sf_dir))
    return bad.select("doc_id", F.col("chunk_pos").cast("long").alias("chunk_pos"), "category")


@query(
    O.sql(f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS pos, md5(span) AS span_md5,
                     {O.category("span")} AS category FROM f_lines""")
)
def categorize_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = chunk.categorize_spans(feeds.docs(spark, sf_dir), "doc_id", "content")
    return spans.select("doc_id", F.col("pos").cast("long").alias("pos"), F.md5("span").alias("span_md5"), "category")


_ANSWER_SPANS = f"""
    SELECT doc_id, category, span, sha256(span) AS span_hash FROM (
      SELECT doc_id, category, unnest(string_split(content, chr(10))) AS span FROM f_answer_rows)
    WHERE NOT {O.blank("span")}"""


@query(
    O.sql(
        """SELECT doc_id, span_hash, n_source, n_chunks, CASE WHEN n_chunks < n_source THEN 'omitted' ELSE 'added' END AS finding
           FROM (SELECT doc_id, span_hash, coalesce(a.n, 0) AS n_source, coalesce(b.n, 0) AS n_chunks
                 FROM (SELECT doc_id, sha256(span) AS span_hash, count(*) AS n FROM f_lines
                       WHERE doc_id IN (SELECT doc_id FROM f_answer_rows) GROUP BY ALL) a
                 FULL JOIN (SELECT doc_id, span_hash, count(*) AS n FROM f_answer_spans GROUP BY ALL) b USING (doc_id, span_hash))
           WHERE n_source <> n_chunks""",
        f_answer_spans=_ANSWER_SPANS,
    )
)
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.coverage_audit_in_row(_usable(spark, sf_dir), "doc_id", "content")


@query(
    O.sql(
        "SELECT doc_id, span_hash, count(*) AS copies FROM f_answer_spans GROUP BY ALL HAVING count(*) > 1",
        f_answer_spans=_ANSWER_SPANS,
    )
)
def duplicate_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.duplicate_spans(_answer_rows(spark, sf_dir), "doc_id")


@query(
    O.sql(f"""SELECT doc_id, chunk_pos, span FROM (
                SELECT doc_id, chunk_pos, unnest(string_split(content, chr(10))) AS span FROM f_answer_rows)
              JOIN f_docs USING (doc_id) WHERE NOT {O.blank("span")} AND NOT contains(f_docs.content, span)""")
)
def verbatim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk.verbatim_audit(_usable(spark, sf_dir), "doc_id", "content")
    return found.select("doc_id", F.col("chunk_pos").cast("long").alias("chunk_pos"), "span")


@query(O.sql("SELECT doc_id, category, content FROM f_chunk_rows"))
def merge_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunk_rows(feeds.chunked(spark, sf_dir), "doc_id").select("doc_id", "category", "content")


@query(
    O.sql(f"""SELECT doc_id, sha256(sentence) AS sentence_hash, min(category) AS first_category, max(category) AS last_category
              FROM (SELECT doc_id, category, {O.strip("s")} AS sentence
                    FROM (SELECT doc_id, category, unnest(regexp_extract_all(content, {O.lit(C.SENTENCE)})) AS s FROM f_answer_rows))
              WHERE sentence <> '' GROUP BY doc_id, sentence HAVING min(category) <> max(category)""")
)
def split_sentence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.split_sentence_audit(_answer_rows(spark, sf_dir), "doc_id")


@query(O.sql("SELECT doc_id, CAST(block AS BIGINT) AS block_pos, category, block_text AS text FROM f_blocks"))
def absorb_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = chunk.with_blocks(feeds.docs(spark, sf_dir).select("doc_id", "content"), "content")
    return blocked.select("doc_id", F.posexplode("blocks").alias("block_pos", "block")).select(
        "doc_id", F.col("block_pos").cast("long").alias("block_pos"), "block.category", "block.text"
    )


@query(
    O.sql(
        """SELECT doc_id, category, content FROM f_pieces""",
        # greedy packing by recursion over the blocks of one (document, category)
        f_ranked="""SELECT doc_id, category, block_text, length(block_text) AS n,
                      row_number() OVER (PARTITION BY doc_id, category ORDER BY block) AS rn FROM f_blocks""",
        f_packed=f"""SELECT * FROM (WITH RECURSIVE packed AS (
                SELECT doc_id, category, rn, block_text, n AS used, 0 AS piece FROM f_ranked WHERE rn = 1
                UNION ALL
                SELECT r.doc_id, r.category, r.rn, r.block_text,
                  CASE WHEN p.used + 1 + r.n <= {PIECE_LIMIT} THEN p.used + 1 + r.n ELSE r.n END,
                  CASE WHEN p.used + 1 + r.n <= {PIECE_LIMIT} THEN p.piece ELSE p.piece + 1 END
                FROM packed p JOIN f_ranked r ON r.doc_id = p.doc_id AND r.category = p.category AND r.rn = p.rn + 1)
              SELECT * FROM packed)""",
        f_pieces="""SELECT doc_id, category, string_agg(block_text, chr(10) ORDER BY rn) AS content
                    FROM f_packed GROUP BY doc_id, category, piece""",
    )
)
def split_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = feeds.chunked(spark, sf_dir, limit=PIECE_LIMIT)
    return chunk.chunk_rows(pieces, "doc_id").select("doc_id", "category", "content")


@query(
    O.sql("""SELECT doc_id, category, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
               printf('%02x', (CAST('0x' || substr(h, 17, 2) AS INT) & 63) | 128) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS chunk_id
             FROM (SELECT doc_id, category,
                     sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(category || '-' || content)) AS h FROM f_chunk_rows)""")
)
def chunk_uuids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunk.chunk_rows(feeds.chunked(spark, sf_dir), "doc_id")
    return chunk.chunk_ids(rows).select("doc_id", "category", "chunk_id")


# A quote of 200 letters is damaged where it would hold its 10th, 60th, 110th and 160th one.
_DAMAGES = (10, 60, 110, 160)


def _damaged(quote: str, substr: str) -> str:
    """SQL, the same in both engines: the first ``doc_id % 5`` places get a letter that no text has."""
    out = quote
    for n, at in enumerate(_DAMAGES, 1):
        kept = f"{substr}({out}, 1, {at - 1}) || '\u00a4' || {substr}({out}, {at + (1 if n % 2 else 0)})"
        out = f"CASE WHEN doc_id % 5 >= {n} AND length({quote}) >= {at} THEN {kept} ELSE {out} END"
    return out


@query(
    f"""SELECT doc_id, CASE WHEN marks <= 3 THEN marks END AS edits, marks > 0 AS damaged FROM (
          SELECT doc_id, CAST(length(quote) - length(replace(quote, '\u00a4', '')) AS INTEGER) AS marks FROM (
            SELECT doc_id, {_damaged("own", "substr")} AS quote FROM (SELECT doc_id, substr(text, 1 + doc_id % 50, 200) AS own FROM documents)))"""
)
def near_verbatim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of every document with up to four letters replaced or put in: edits up to three."""
    docs = feeds.table(spark, sf_dir, "documents").select("doc_id", "text", F.expr("substr(text, 1 + CAST(doc_id % 50 AS INT), 200)").alias("own"))
    quoted = docs.withColumn("quote", F.expr(_damaged("own", "substr"))).withColumn("damaged", F.contains("quote", F.lit("\u00a4")))
    return alignment.audit(quoted, "text", "quote", "doc_id", "damaged").select("doc_id", "edits", "damaged")
