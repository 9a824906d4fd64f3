"""One query for each operator, with production parameters over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, fim, lines, mixing, neardup, pages, quality, secrets, spelling, substrings, tokencount, topk, urls
from millrace.plans.registry import query

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT = 512

# host, path, action of the filter rules (fixed values).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    score = F.col("quality_score")
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= quality.ACCEPT, 1).otherwise(0).alias("predicted"),
    )


@query(lines.ORACLE)
def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.judge(table(spark, sf_dir, "documents"))


@query()
def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_anchored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 20
"""


@query(TOPK_SQL)
def op6_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


NEARDUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS sh FROM w
), u AS (
  SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT a, b FROM p UNION SELECT r.a, p.b FROM reach r JOIN p ON r.b = p.a
), c AS (
  SELECT a, min(b) AS least FROM reach GROUP BY a
)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, least(s.doc_id, coalesce(c.least, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(c.least, s.doc_id)) AS kept
FROM s LEFT JOIN c ON s.doc_id = c.a
"""


@query(NEARDUP_SQL)
def op7_hamming_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op8_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_secret_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))
    spans = F.col("secret_spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.BASE_KINDS],
        F.sha2(secrets.spans_text(spans, secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.spans_text(spans).alias("spans"),
    )


URL_SQL = r"""
WITH u AS (
  SELECT page_id, contains(coalesce(url, ''), '://') AS ok, substr(url, position('://' IN url) + 3) AS rest FROM pages
), h AS (
  SELECT page_id, CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u
), r(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT page_id, host, path, rh || rp AS rule, verdict FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) = 1
)
SELECT h.page_id, h.host, h.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""


@query(URL_SQL)
def op10_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


@query(spelling.ORACLE)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), d AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS h1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t
), c AS (
  SELECT doc_id, text, n, array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(u[greatest(h1, h2) + 1:], '') AS s, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM c
"""


@query(FIM_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query()
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencount.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
