"""Queries over change-event messages: decode, validate, fan out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions import chunks as C
from millrace.functions import text as X
from millrace.functions.plan import once
from millrace.operators import decode, infer
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query
from millrace.session import run_dir
from millrace.sources import message_log
from millrace.streaming import jobs


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.decode_messages(feeds.messages(spark, sf_dir))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.fan_out(_decoded(spark, sf_dir).filter(F.size("items") > 0), "event_id")


@query(
    O.sql("""SELECT CAST(user_id AS VARCHAR) AS key, CASE WHEN event_id % 11 <> 0 THEN 'record-updates' END AS topic,
             user_id % 6 AS partition, event_id AS "offset", epoch_us(ts) AS ts_us, body IS NOT NULL AS has_value
             FROM f_messages""")
)
def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages published to a log and read from it as a stream."""
    folder = run_dir(spark, "source-events")
    message_log.publish(feeds.messages(spark, sf_dir).drop("event_id"), f"{folder}/log")
    stream = message_log.read_log_stream(spark, f"{folder}/log")
    jobs.write_batches(stream, f"{folder}/out", f"{folder}/checkpoint", mode="append").awaitTermination()
    return spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/out").select(
        F.col("key").cast("string").alias("key"),
        "topic",
        F.col("partition").cast("long").alias("partition"),
        "offset",
        F.unix_micros("timestamp").alias("ts_us"),
        F.col("value").isNotNull().alias("has_value"),
    )


@query(O.sql("SELECT event_id, 'extraction-failed' AS ingestion_state FROM f_messages WHERE body IS NULL"))
def null_value_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        feeds.messages(spark, sf_dir)
        .filter(F.col("value").isNull())
        .select("event_id", F.lit("extraction-failed").alias("ingestion_state"))
    )


@query(
    O.sql("""SELECT event_id, try(decode(CASE WHEN damaged THEN encode(body) || '\\xFF'::BLOB ELSE encode(body) END)) IS NOT NULL AS valid
             FROM f_messages WHERE body IS NOT NULL""")
)
def utf8_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = feeds.messages(spark, sf_dir).filter(F.col("value").isNotNull())
    return sent.select("event_id", F.try_validate_utf8(F.col("value").cast("string")).isNotNull().alias("valid"))


@query(
    O.sql("""SELECT event_id, length(text) AS n_chars FROM f_decoded
             WHERE text IS NOT NULL AND NOT json_valid(text)""")
)
def json_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _decoded(spark, sf_dir).filter(decode.message_outcome() == "bad_json")
    return bad.select("event_id", F.char_length("text").cast("long").alias("n_chars"))


@query(
    O.sql("""SELECT event_id, CASE WHEN json_type(payload, '$.data') = 'ARRAY' THEN 'enveloped'
                    WHEN items IS NOT NULL THEN 'bare' ELSE 'not_a_list' END AS shape,
                    coalesce(items[1] ->> '$.id', '-') AS first_id
             FROM f_itemized WHERE payload IS NOT NULL""")
)
def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _decoded(spark, sf_dir).filter(F.col("payload").isNotNull())
    enveloped = F.try_variant_get("payload", "$.data", "array<variant>").isNotNull()
    return parsed.select(
        "event_id",
        F.when(enveloped, "enveloped").when(F.col("items").isNotNull(), "bare").otherwise("not_a_list").alias("shape"),
        F.coalesce(F.try_variant_get(F.get("items", F.lit(0)), "$.id", "string"), F.lit("-")).alias("first_id"),
    )


@query(
    O.sql("""SELECT len(items) AS item_count, count(*) AS n_messages, CAST(sum(len(items)) AS BIGINT) AS n_items
             FROM f_itemized WHERE items IS NOT NULL GROUP BY ALL""")
)
def item_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = decode.with_item_count(_decoded(spark, sf_dir)).filter(F.col("item_count").isNotNull())
    return counted.groupBy(F.col("item_count").cast("long").alias("item_count")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.sum(F.col("item_count")).cast("long").alias("n_items")
    )


@query(
    O.sql("""SELECT m.event_id, coalesce(i.item_pos, -1) AS item_pos, coalesce(i.item ->> '$.id', '-') AS item_id
             FROM f_itemized m LEFT JOIN f_items i USING (event_id)""")
)
def item_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.fan_out(_decoded(spark, sf_dir), "event_id").select(
        "event_id",
        F.coalesce(F.col("item_pos").cast("long"), F.lit(-1)).alias("item_pos"),
        F.coalesce(F.try_variant_get("item", "$.id", "string"), F.lit("-")).alias("item_id"),
    )


def _field_check_sql() -> str:
    tests = {
        "string": "= 'VARCHAR'",
        "instant": "= 'VARCHAR'",
        "int": "IN ('BIGINT', 'UBIGINT')",
        "boolean": "= 'BOOLEAN'",
        "array": "= 'ARRAY'",
        "object": "= 'OBJECT'",
    }
    return ", ".join(
        f"CASE WHEN coalesce(json_type(item, '$.{name}') {tests[kind]}, false) THEN NULL ELSE '{name}' END"
        for name, (_, kind) in S.REQUIRED_FIELDS.items()
    )


@query(
    O.sql(f"""SELECT event_id, item_pos, CASE WHEN json_type(item) <> 'OBJECT' THEN 'not_an_object'
                     ELSE coalesce(nullif(array_to_string(list_filter([{_field_check_sql()}], lambda f: f IS NOT NULL), ','), ''), 'ok') END AS finding
              FROM f_items""")
)
def item_schema_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode.check_items(_items(spark, sf_dir))
    return checked.select(
        "event_id",
        F.col("item_pos").cast("long").alias("item_pos"),
        F.when(~F.col("is_object"), "not_an_object")
        .otherwise(F.coalesce(F.nullif(F.array_join("bad_fields", ","), F.lit("")), F.lit("ok")))
        .alias("finding"),
    )


@query(
    O.sql("""SELECT event_id, item_pos, item ->> '$.id' AS id FROM f_items
             WHERE json_type(item) = 'OBJECT' AND item ->> '$.id' <> 'unknown'""")
)
def sentinel_id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir).withColumn("id", F.try_variant_get("item", "$.id", "string"))
    return decode.not_sentinel(items.filter(F.col("id").isNotNull())).select(
        "event_id", F.col("item_pos").cast("long").alias("item_pos"), "id"
    )


@query(
    O.sql("""SELECT event_id, item_pos, coalesce(length(item ->> '$.id') > 0, false) AS has_id FROM f_items
             WHERE json_type(item) = 'OBJECT'""")
)
def required_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode.check_items(_items(spark, sf_dir)).filter("is_object")
    return checked.select(
        "event_id", F.col("item_pos").cast("long").alias("item_pos"), decode.has_id("id").alias("has_id")
    )


@query(
    O.sql(f"""SELECT doc_id, CASE WHEN t = '' THEN 'dropped' WHEN {O.blank("t")} THEN 'rejected' ELSE 'accepted' END AS outcome
              FROM (SELECT doc_id, CASE WHEN doc_id % 16 = 15 THEN chr(160) || chr(10)
                                        ELSE {O.readable("content")} END AS t FROM f_docs)""")
)
def blank_text_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    blank = F.when(F.col("doc_id") % 16 == 15, "\u00a0\n").otherwise(X.clean_text(F.col("content")))
    texts = feeds.docs(spark, sf_dir).select("doc_id", blank.alias("extraction_text"))
    return texts.select("doc_id", decode.text_outcome("extraction_text").alias("outcome"))


@query(
    O.sql(f"""SELECT doc_id, n_given, n_kept, n_kept = 0 AS rejected FROM (
              SELECT doc_id, len(given) AS n_given, len(list_filter(given, lambda c: NOT {O.blank("c.content")})) AS n_kept
              FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 7 THEN altered[1:0] ELSE altered END AS given FROM f_altered
                    WHERE doc_id % 13 NOT IN (2, 3, 4, 5, 6)))""")
)
def blank_chunk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = infer.resolve(feeds.answered(spark, sf_dir)).filter(F.col("chunks").isNotNull())
    kept = once(parsed, kept=C.keep_filled(F.col("chunks")))
    return kept.select(
        "doc_id",
        F.size("chunks").cast("long").alias("n_given"),
        F.size("kept").cast("long").alias("n_kept"),
        (F.size("kept") == 0).alias("rejected"),
    )


@query(
    O.sql("""SELECT doc_id, CASE WHEN doc_id % 13 NOT IN (2, 3, 4, 5, 6, 7) AND len(altered) > 0 THEN 'accepted'
                    ELSE 'embedding-failed' END AS outcome FROM f_altered""")
)
def empty_chunks_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = infer.resolve(feeds.answered(spark, sf_dir))
    filled = F.coalesce(F.size("chunks") > 0, F.lit(False))
    return parsed.select("doc_id", F.when(filled, "accepted").otherwise("embedding-failed").alias("outcome"))


@query(
    O.sql("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '-' WHEN event_id % 5 = 0 THEN 'u-' || event_id
                    ELSE 't-' || event_id END AS trace,
                    CASE WHEN event_id % 10 = 0 THEN 0 ELSE 2 END AS n_headers FROM f_messages""")
)
def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<struct<key:string,value:binary>>")
    mapped = feeds.messages(spark, sf_dir).select(
        "event_id", decode.header_map(F.coalesce("headers", none)).alias("carrier")
    )
    return mapped.select(
        "event_id",
        F.coalesce(F.try_element_at("carrier", F.lit("trace")), F.lit("-")).alias("trace"),
        F.size("carrier").alias("n_headers"),
    )


@query(
    O.sql("""SELECT 'kafka' AS system, CASE WHEN event_id % 11 = 0 THEN 'unknown' ELSE 'record-updates' END AS topic,
                    'process' AS operation, user_id % 6 AS partition, event_id AS "offset" FROM f_messages""")
)
def source_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = decode.source_attributes(feeds.messages(spark, sf_dir))
    return attributes.withColumn("partition", F.col("partition").cast("long"))


@query(
    O.sql("""SELECT event_id, item_pos, unnest(list_filter(
                 [CASE WHEN item ->> '$.glassware[0]' NOT IN ('coupe') THEN 'glassware=' || (item ->> '$.glassware[0]') END,
                  CASE WHEN item ->> '$.ingredients[0].uoM' NOT IN ('ounces') THEN 'uoM=' || (item ->> '$.ingredients[0].uoM') END],
                 lambda v: v IS NOT NULL)) AS violation
             FROM f_items WHERE json_type(item) = 'OBJECT'""")
)
def enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = decode.check_items(_items(spark, sf_dir))
    return checked.select(
        "event_id", F.col("item_pos").cast("long").alias("item_pos"), F.explode("bad_values").alias("violation")
    )
