"""Queries over lookup, version dedup, sources, sinks and the ledger."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.plan import once
from millrace.operators import chunk, clean, decode, dedup, infer, ledger, shape
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query
from millrace.session import run_dir
from millrace.sources import message_log, sinks
from millrace.streaming import stages

_CLEANED = f"SELECT doc_id, id, {O.escape(O.readable('content'))} AS extraction_text FROM f_docs"


# --- sources and sinks -------------------------------------------------------


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(
        feeds.records(spark, sf_dir), extraction_text=X.clean_document(F.col("content"))
    )


@query(
    O.sql(
        """SELECT r.doc_id, r.title, r.serves, i.n_items, e.extraction_text FROM f_records r JOIN f_extracted e USING (doc_id)
           JOIN (SELECT doc_id, count(*) AS n_items FROM f_record_items GROUP BY doc_id) i USING (doc_id)""",
        f_extracted=_CLEANED,
    )
)
def source_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _extractions(spark, sf_dir).withColumn("record", feeds.record_struct())
    messages = sinks.result_messages(sent, "id", sinks.extraction_value(F.col("record")))
    read = decode.decode_extractions(messages)
    return read.select(
        F.col("record.id").cast("long").alias("doc_id"),
        "record.title",
        F.col("record.serves").cast("long").alias("serves"),
        F.size("record.ingredients").cast("long").alias("n_items"),
        "extraction_text",
    )


@query(
    O.sql("""SELECT doc_id, good AS exact_keys, CASE WHEN good THEN len(list) ELSE -1 END AS n_chunks
             FROM (SELECT *, coalesce(len(list) = 0 OR list_sort(json_keys(list[1])) = ['category', 'content'], false) AS good
                   FROM (SELECT doc_id, CASE WHEN json_valid(first_answer) AND json_type(first_answer) = 'ARRAY'
                                        THEN CAST(CAST(first_answer AS JSON) AS JSON[]) END AS list FROM f_answered))""")
)
def source_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer as a chunk result, also those that no decoder can read."""
    answers = feeds.answered(spark, sf_dir)
    value = F.concat(
        F.lit('{"record":{"id":"'), F.col("doc_id").cast("string"), F.lit('"},"chunks":'), "first_answer", F.lit("}")
    )
    messages = answers.select("doc_id", F.encode(value, "UTF-8").alias("value"))
    read = decode.decode_chunk_results(messages, "doc_id")
    return read.select(
        "doc_id", "exact_keys", F.when(F.col("exact_keys"), F.size("chunks")).otherwise(-1).cast("long").alias("n_chunks")
    )


def _through_log(spark: SparkSession, messages: DataFrame, label: str) -> DataFrame:
    """Messages as a reader of their log gets them."""
    path = run_dir(spark, label)
    message_log.publish(messages, path)
    return message_log.read_log(spark, path)


@query(
    O.sql(
        """SELECT id AS key, length(extraction_text) AS text_chars, extraction_text AS text, 'Record ' || id AS title
           FROM f_extracted WHERE extraction_text <> ''""",
        f_extracted=_CLEANED,
    )
)
def sink_extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = clean.drop_blank(_extractions(spark, sf_dir), "extraction_text").withColumn("record", feeds.record_struct())
    messages = sinks.result_messages(sent, "id", sinks.extraction_value(F.col("record")))
    messages = _through_log(spark, messages, "extractions")
    body = once(
        messages.select(F.col("key").cast("string").alias("key"), "value"),
        body=F.from_json(
            F.col("value").cast("string"), "struct<record:struct<title:string>,extraction_text:string>"
        ),
    )
    return body.select(
        "key",
        F.char_length("body.extraction_text").cast("long").alias("text_chars"),
        F.col("body.extraction_text").alias("text"),
        F.col("body.record.title").alias("title"),
    )


@query(
    O.sql("""SELECT CAST(doc_id AS VARCHAR) AS key, len(altered) AS n_chunks, coalesce(altered[1].category, '-') AS first_category,
               coalesce(altered[1].content, '-') AS first_content
             FROM f_altered WHERE doc_id % 13 NOT IN (2, 3, 4, 5, 6, 7) AND len(altered) > 0""")
)
def sink_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = infer.resolve(feeds.answered(spark, sf_dir)).filter("status = 'ok'")
    sent = usable.select(F.col("doc_id").cast("string").alias("id"), "chunks")
    messages = _through_log(spark, sinks.result_messages(sent, "id", sinks.chunk_value(F.struct("id"))), "chunks")
    read = once(
        messages.select(F.col("key").cast("string").alias("key"), "value"),
        body=F.from_json(F.col("value").cast("string"), "struct<chunks:array<struct<category:string,content:string>>>"),
    )
    first = F.get("body.chunks", F.lit(0))
    return read.select(
        "key",
        F.size("body.chunks").cast("long").alias("n_chunks"),
        first["category"].alias("first_category"),
        first["content"].alias("first_content"),
    )


@query(
    O.sql("""SELECT id, arg_max(event_type, (n_new, ts, event_id)) AS title, epoch_us(arg_max(ts, (n_new, ts, event_id))) AS version_us, max(n_new) = 1 AS from_batch
             FROM (SELECT *, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS n_new FROM f_events)
             GROUP BY id""")
)
def index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows from older event types, then a batch of newer ones on top."""
    events = feeds.events(spark, sf_dir)
    rows = events.select(
        "id", F.struct("ts", "event_id").alias("version"), F.col("event_type").alias("title"),
        F.col("event_type").isin("purchase", "signup").alias("from_batch"),
    )
    old = rows.filter(~F.col("from_batch"))
    index = old.groupBy("id").agg(F.max_by(F.struct("version", "title", "from_batch"), "version").alias("row")).select("id", "row.*")
    merged = sinks.upsert(index, rows.filter("from_batch"), "id", "version")
    return merged.select("id", "title", F.unix_micros("version.ts").alias("version_us"), "from_batch")


@query(
    O.sql("""SELECT id, max(event_id) FILTER (WHERE rn = 1) AS event_id, epoch_us(max(ts)) AS version_us, count(*) AS n_seen
             FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn FROM f_events) GROUP BY id""")
)
def record_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = dedup.newest_per_id(feeds.events(spark, sf_dir), "id", "ts", "event_id", "event_type")
    return newest.select("id", "event_id", F.unix_micros("ts").alias("version_us"), "n_seen")


@query(
    O.sql("""SELECT doc_id, CASE WHEN doc_id % 13 = 5 THEN 'second' ELSE 'first' END AS stage,
               length(CASE WHEN doc_id % 13 = 5 THEN second_answer ELSE first_answer END) AS n_chars,
               CASE doc_id % 13 WHEN 2 THEN 'not_a_list' WHEN 5 THEN 'bad_syntax' ELSE 'wrong_keys' END AS status
             FROM f_answered WHERE doc_id % 13 IN (2, 3, 4, 5)""")
)
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = infer.quarantine(infer.resolve(feeds.answered(spark, sf_dir)), "doc_id")
    return failed.select("doc_id", "stage", "status", F.char_length("answer").cast("long").alias("n_chars"))


@query(
    O.sql("""SELECT doc_id, title, strftime(modifiedOn, '%Y-%m-%dT%H:%M:%S.%fZ') AS modified_on, glassware[1] AS first_glass,
               doc_id % 5 = 0 AS null_nutrition_kept, doc_id % 3 = 0 AS null_strength_kept FROM f_records""")
)
def serialize_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = once(feeds.records(spark, sf_dir), json=sinks.serialize(feeds.record_struct()))
    return written.select(
        "doc_id",
        F.get_json_object("json", "$.title").alias("title"),
        F.get_json_object("json", "$.modifiedOn").alias("modified_on"),
        F.get_json_object("json", "$.glassware[0]").alias("first_glass"),
        F.contains("json", F.lit('"nutrition":null')).alias("null_nutrition_kept"),
        F.contains("json", F.lit('"keywordsStrength":null')).alias("null_strength_kept"),
    )


# --- lookup and versions -----------------------------------------------------


@query(
    O.sql("""SELECT id, epoch_us(version) AS version_us, n_chars, n_events FROM f_published
             JOIN (SELECT id, count(*) AS n_events FROM f_events GROUP BY id) e USING (id)""")
)
def latest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = feeds.published_docs(spark, sf_dir).select("id", "version", "n_chars")
    found = dedup.lookup_latest(feeds.events(spark, sf_dir), snapshot, "id")
    return found.select("id", F.unix_micros("version").alias("version_us"), "n_chars", "n_events")


@query(
    O.sql("""SELECT id, count(*) AS n_events FROM f_events WHERE user_id NOT IN (SELECT doc_id FROM labels) GROUP BY id""")
)
def missing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.missing_records(feeds.events(spark, sf_dir), feeds.published_docs(spark, sf_dir), "id")


@query(
    O.sql("""SELECT id, event_id, event_type, n_seen - 1 AS n_collapsed FROM (
               SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id DESC) AS rn,
                      count(*) OVER (PARTITION BY id) AS n_seen FROM f_events) WHERE rn = 1""")
)
def collapse_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = dedup.newest_per_id(feeds.events(spark, sf_dir), "id", "ts", "event_id", "event_type")
    return newest.select("id", "event_id", "event_type", (F.col("n_seen") - 1).alias("n_collapsed"))


def _old_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions processed by an earlier run: the time of every id's first event."""
    return feeds.events(spark, sf_dir).groupBy("id").agg(F.min("ts").alias("version"))


_OLD_LEDGER = "SELECT id, min(ts) AS version FROM f_events GROUP BY id"


@query(
    O.sql(
        """SELECT d.id, epoch_us(d.version) AS version_us, l.version IS NULL AS first_time FROM f_docs d LEFT JOIN f_ledger l USING (id)
           WHERE l.version IS NULL OR d.version > l.version""",
        f_ledger=_OLD_LEDGER,
    )
)
def version_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = feeds.docs(spark, sf_dir).select("id", "version")
    known = dedup.with_last_version(docs, _old_ledger(spark, sf_dir), "id")
    kept = known.filter(dedup.is_new_version(F.col("version"), F.col("last_version")))
    return kept.select(
        "id", F.unix_micros("version").alias("version_us"), F.col("last_version").isNull().alias("first_time")
    )


@query(O.sql("SELECT id, epoch_us(max(ts)) AS version_us FROM f_events GROUP BY id"))
def stream_version_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through a stage that passes versions on; the newest one published per id."""
    folder = run_dir(spark, "stream-versions")
    rows = feeds.events(spark, sf_dir).select("id", F.col("ts").alias("version"))
    message_log.publish(_announced(rows), f"{folder}/events")
    stage = stages.Stage("versions", _announcements("id string, version timestamp"), _passed_on)
    stream = message_log.read_log_stream(spark, f"{folder}/events")
    stages.run_stage(stage, stream, f"{folder}/versions", f"{folder}/out").awaitTermination()
    sent = message_log.read_log(spark, f"{folder}/out")
    newest = _announcements("id string, version timestamp")(sent)
    return newest.groupBy("id").agg(F.max(F.unix_micros("version")).alias("version_us"))


def _announced(rows: DataFrame) -> DataFrame:
    return sinks.result_messages(rows, "id", F.struct(*rows.columns))


def _announcements(ddl: str):
    """Rows as announced, with the headers of their messages."""
    return lambda messages: messages.select(F.from_json(F.col("value").cast("string"), ddl).alias("row"), "headers").select("row.*", "headers")


def _passed_on(due: DataFrame) -> DataFrame:
    value = sinks.serialize(F.struct("id", "version"))
    return due.select("*", F.lit(True).alias("succeeded"), F.encode("id", "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"))


@query(
    O.sql(
        f"""SELECT id, epoch_us(max(version)) AS version_us FROM (
              SELECT id, version FROM f_ledger UNION ALL
              SELECT d.id, d.version FROM f_docs d LEFT JOIN f_ledger l USING (id)
              WHERE (l.version IS NULL OR d.version > l.version) AND NOT {O.blank(O.readable("content"))}) GROUP BY id""",
        f_ledger=_OLD_LEDGER,
    )
)
def ledger_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger behind a stage that cleans and publishes: blank texts do not advance it."""
    folder = run_dir(spark, "ledger")
    stages.seed_ledger(_old_ledger(spark, sf_dir), f"{folder}/extraction")
    message_log.publish(_announced(feeds.docs(spark, sf_dir).select("id", "version", "content")), f"{folder}/events")
    stage = stages.Stage("extraction", _announcements("id string, version timestamp, content string"), _cleaned)
    stream = message_log.read_log_stream(spark, f"{folder}/events")
    stages.run_stage(stage, stream, f"{folder}/extraction", f"{folder}/out").awaitTermination()
    return stages.ledger_before(spark, f"{folder}/extraction/ledger").select(
        "id", F.unix_micros("version").alias("version_us")
    )


def _cleaned(due: DataFrame) -> DataFrame:
    ran = clean.extract(due, "content").drop("content")
    return ran.select(
        "*",
        (~X.is_blank(F.col("extraction_text"))).alias("succeeded"),
        F.encode("id", "UTF-8").alias("key"),
        F.encode("extraction_text", "UTF-8").alias("value"),
    )


@query(
    O.sql("""SELECT record_id, CAST(position // 4 AS INT) AS segment, CAST(sum(copies) AS BIGINT) AS n_items,
               string_agg(item, ';' ORDER BY position, item_id, units) AS items
             FROM (SELECT *, position || ':' || coalesce(p_name, '?') || ':' || coalesce(p_brand, '?') || ':' || copies AS item
                   FROM (SELECT record_id, position, item_id, units, count(*) AS copies FROM f_order_items GROUP BY ALL)
                   LEFT JOIN part ON p_partkey = item_id)
             GROUP BY record_id, position // 4""")
)
def resolve_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = feeds.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand")
    )
    lines = dedup.fold_copies(feeds.order_items(spark, sf_dir).drop("application"))
    nested = dedup.nest_items(
        dedup.resolve_items(lines, parts, "item_id"),
        "record_id",
        ["position", "item_id", "units"],
        ["name", "brand", "copies"],
        F.floor(F.col("position") / 4).cast("int"),
    )
    shown = F.transform(
        "items",
        lambda i: F.concat_ws(
            ":",
            i["position"].cast("string"),
            F.coalesce(i["name"], F.lit("?")),
            F.coalesce(i["brand"], F.lit("?")),
            i["copies"].cast("string"),
        ),
    )
    total = F.aggregate("items", F.lit(0).cast("long"), lambda acc, i: acc + i["copies"])
    return nested.select("record_id", "segment", total.alias("n_items"), F.array_join(shown, ";").alias("items"))


@query(
    O.sql("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Record API request failed: ' || event_type || ': k'
               WHEN 1 THEN 'Record API request failed: ' || event_type WHEN 2 THEN 'Record API request failed: Unknown error: k'
               ELSE 'Record API request failed with status ' || (400 + event_id % 7) END AS error_text FROM f_events""")
)
def lookup_error_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    kind = F.col("event_type")
    body = (
        F.when(e % 6 == 0, F.to_json(F.struct(kind.alias("title"), F.lit("k").alias("detail"))))
        .when(e % 6 == 1, F.to_json(F.struct(kind.alias("title"), F.lit("").alias("detail"))))
        .when(e % 6 == 2, F.to_json(F.struct(F.lit("").alias("title"), F.lit("k: ").alias("detail"))))
        .when(e % 6 == 3, "{}")
        .when(e % 6 == 4, "<html>")
    )
    problems = feeds.events(spark, sf_dir).select("event_id", body.alias("body"), (400 + e % 7).alias("status"))
    return dedup.lookup_errors(problems, "body", "status", "event_id")


# --- ledger and whole chain ----------------------------------------------------


def _variant(ctes: list[str], old: str, new: str, source: str) -> dict[str, str]:
    """Feed expressions re-based on another table of (doc_id, content)."""
    renames = {name: name.replace(old, new, 1) for name in ctes} | {"f_docs": source}
    moved = {name: re.sub(r"\bf_\w+", lambda m: renames.get(m.group(), m.group()), O.CTES[name]) for name in ctes}
    return {renames[name]: body for name, body in moved.items()}


_READ = {
    "f_read": f"SELECT * FROM (SELECT doc_id, id, version, {O.readable('content')} AS content FROM f_docs) WHERE NOT {O.blank('content')}",
    **_variant(["f_lines", "f_line_blocks", "f_blocks", "f_chunk_rows"], "f_", "f_read_", "f_read"),
}


@query(
    O.sql(
        """SELECT r.id, c.n_chunks, c.chunk_chars, CASE WHEN doc_id % 23 = 5 THEN 'bad_enum' ELSE 'ok' END AS outcome
           FROM f_read r JOIN (SELECT doc_id, count(*) AS n_chunks, CAST(sum(length(content)) AS BIGINT) AS chunk_chars
                               FROM f_read_chunk_rows GROUP BY doc_id) c USING (doc_id)
           LEFT JOIN f_ledger l ON l.id = r.id WHERE l.version IS NULL OR r.version > l.version""",
        f_ledger=_OLD_LEDGER,
        **_READ,
    )
)
def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip what is done, clean, chunk and shape every due record."""
    due = dedup.skip_seen(feeds.records(spark, sf_dir), _old_ledger(spark, sf_dir), "id", "modifiedOn")
    ran = ledger.run_chain(due)
    sizes = F.aggregate("content_chunks", F.lit(0).cast("long"), lambda acc, c: acc + F.char_length(c["content"]))
    return ran.select(
        "id",
        F.size("content_chunks").cast("long").alias("n_chunks"),
        sizes.alias("chunk_chars"),
        F.coalesce("reject_reason", F.lit("ok")).alias("outcome"),
    )


@query(
    O.sql(
        """SELECT r.id, c.n_chunks, c.chunk_chars, md5(r.content) AS text_md5
           FROM f_read r JOIN (SELECT doc_id, count(*) AS n_chunks, CAST(sum(length(content)) AS BIGINT) AS chunk_chars
                               FROM f_read_chunk_rows GROUP BY doc_id) c USING (doc_id)""",
        **_READ,
    )
)
def staged_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain over its messages: publish the cleaned text, decode the message, chunk what it says."""
    sent = clean.drop_blank(_extractions(spark, sf_dir), "extraction_text").withColumn("record", feeds.record_struct())
    messages = sinks.result_messages(sent, "id", sinks.extraction_value(F.col("record")))
    read = decode.decode_extractions(messages)
    kept = read.select(F.col("record.id").alias("id"), "text").filter(~X.is_blank(F.col("text")))
    chunked = chunk.with_chunks(kept, "text")
    sizes = F.aggregate("chunks", F.lit(0).cast("long"), lambda acc, c: acc + F.char_length(c["content"]))
    return chunked.select(
        "id", F.size("chunks").cast("long").alias("n_chunks"), sizes.alias("chunk_chars"), F.md5("text").alias("text_md5")
    )


@query(
    O.sql(
        f"""SELECT id, CASE WHEN NOT usable THEN 'chunking-failed' WHEN doc_id % 23 = 5 OR NOT filled THEN 'embedding-failed'
                    ELSE 'embedding-succeeded' END AS state,
                    CAST(CASE WHEN NOT usable THEN 2 ELSE 3 END AS BIGINT) AS n_states
            FROM (SELECT d.doc_id, d.id, d.content, a.doc_id % 13 NOT IN (2, 3, 4, 5, 6, 7) AND len(a.altered) > 0 AS usable,
                    len(list_filter(a.altered, lambda c: NOT {O.blank("c.content")})) > 0 AS filled
                  FROM f_docs d JOIN f_altered a USING (doc_id)) WHERE NOT {O.blank(O.readable("content"))}"""
    )
)
def state_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest state of every record after extraction, chunking and shaping."""
    answers = infer.resolve(feeds.answered(spark, sf_dir))
    # flags only go through the join, never the texts
    flags = once(
        answers,
        flags=F.struct(
            (~X.is_blank(X.clean_text(F.col("content")))).alias("extracted"),
            (F.size("chunks") > 0).alias("chunks_ok"),
            (F.size(shape.request_chunks(F.col("chunks"))) > 0).alias("filled"),
        ),
    ).select("doc_id", "flags.*")
    items = feeds.records(spark, sf_dir).select("doc_id", (F.size(shape.untranslatable()) == 0).alias("translated"))
    judged = flags.join(items, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        "extracted",
        "chunks_ok",
        (F.col("filled") & F.col("translated")).alias("request_ok"),
    )
    return ledger.newest_state(ledger.stage_states(judged, "id"))


@query(
    O.sql(
        """SELECT item ->> '$.id' AS id, max(epoch_us(CAST(item ->> '$.modifiedOn' AS TIMESTAMP))) AS version_us,
             'embedding-succeeded' AS state, CAST(1 AS BIGINT) AS n_requests
           FROM f_items WHERE json_type(item) = 'OBJECT' AND (item -> '$.title') IS NOT NULL AND item ->> '$.glassware[0]' <> 'teapot'
             AND item ->> '$.ingredients[0].uoM' <> 'gallons' AND item ->> '$.id' NOT IN ('unknown', '') GROUP BY 1"""
    )
)
def streamed_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events through the three connected stages: one request per record, of its newest version."""
    folder = run_dir(spark, "chain")
    message_log.publish(feeds.messages(spark, sf_dir).drop("event_id"), f"{folder}/events")
    logs = stages.run_chain(spark, f"{folder}/events", folder)
    requests = message_log.read_log(spark, logs["embedding"]).select(F.col("key").cast("string").alias("id"))
    states = stages.outcomes(spark, "embedding", f"{folder}/embedding")
    done = stages.ledger_before(spark, f"{folder}/embedding/ledger")
    counted = requests.groupBy("id").agg(F.count(F.lit(1)).alias("n_requests"))
    return done.join(states, "id").join(counted, "id").select(
        "id", F.unix_micros("version").alias("version_us"), "state", "n_requests"
    )


_REJECTS = """
    SELECT 'message' AS scope, CASE WHEN body IS NULL THEN 'no_value' WHEN text IS NULL THEN 'bad_utf8'
             WHEN payload IS NULL THEN 'bad_json' WHEN items IS NULL THEN 'not_a_list' END AS reason FROM f_itemized
    UNION ALL
    SELECT 'item', CASE WHEN json_type(item) <> 'OBJECT' THEN 'not_an_object' WHEN (item -> '$.title') IS NULL THEN 'bad_fields'
             WHEN item ->> '$.glassware[0]' = 'teapot' OR item ->> '$.ingredients[0].uoM' = 'gallons' THEN 'bad_enum'
             WHEN item ->> '$.id' = 'unknown' THEN 'sentinel_id' WHEN item ->> '$.id' = '' THEN 'empty_id' END FROM f_items"""


@query(O.sql(f"SELECT scope, reason, count(*) AS n FROM ({_REJECTS}) WHERE reason IS NOT NULL GROUP BY ALL"))
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects by scope and reason, from one pass over the messages.

    A message carries its own outcome with its item rows, so it is counted once, at its
    first row.
    """
    decoded = decode.decode_messages(feeds.messages(spark, sf_dir)).withColumn("outcome", decode.message_outcome())
    checked = decode.check_items(decode.fan_out(decoded, "outcome"))
    findings = F.array_compact(
        F.array(
            F.when(
                F.coalesce("item_pos", F.lit(0)).eqNullSafe(0) & (F.col("outcome") != "ok"),
                F.struct(F.lit("message").alias("scope"), F.col("outcome").alias("reason")),
            ),
            F.when(
                F.col("item_pos").isNotNull() & F.col("reject_reason").isNotNull(),
                F.struct(F.lit("item").alias("scope"), F.col("reject_reason").alias("reason")),
            ),
        )
    )
    return checked.select(F.inline(findings)).groupBy("scope", "reason").agg(F.count(F.lit(1)).alias("n"))
