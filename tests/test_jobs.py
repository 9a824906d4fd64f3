"""Operators on small literal frames, against hand-made or brute-force results."""

import json
import time

import pytest
from pyspark.sql import functions as F

from millrace.functions import chunks as C
from millrace.functions import text as X
from millrace.operators import catalogue, chunk, clean, decode, dedup, infer, ledger, matching, search, shape
from millrace.plans import feeds
from millrace.sources import messages as M
from millrace.sources import sinks
from millrace.streaming import jobs

SMALL = "/root/testdata/sf0.001"


def _record(**changes):
    item = {
        "id": "a", "title": "t", "descriptiveTitle": "d", "description": "x", "content": "c",
        "publishedOn": "2024-01-01T00:00:00Z", "modifiedOn": "2024-01-02T00:00:00+02:00", "serves": 1,
        "prepTimeMinutes": 5, "isIba": True,
        "images": [{"type": "tile", "uri": "u", "width": 1, "height": 2}], "glassware": ["coupe"],
        "rating": {"oneStars": 0, "twoStars": 0, "threeStars": 0, "fourStars": 0, "fiveStars": 1, "totalStars": 5,
                   "rating": 5.0, "ratingCount": 1},
        "reactions": {"like": 1}, "searchableTitles": [], "tags": [], "collections": [], "hashtags": [],
        "ingredients": [], "instructions": [{"display": "s", "order": 1}],
        "keywords": {**{k: [] for k in feeds.S.KEYWORD_LISTS}, **{k: "x" for k in feeds.S.KEYWORD_SCALARS}},
        "recipeCuisine": "r", "socialLinks": [],
    }
    item.update(changes)
    return {k: v for k, v in item.items() if v != "DROP"}


def _messages(spark, values):
    rows = [(v.encode() if isinstance(v, str) else v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, n int")


def test_message_outcomes(spark):
    values = [None, b"\xff\xfe", "{", "{}", '{"id":"a"}', "[]", '{"data":[]}', "5", '{"data":null}', '[1]']
    out = decode.decode_messages(_messages(spark, values)).select("n", decode.message_outcome().alias("o")).collect()
    found = [r["o"] for r in sorted(out, key=lambda r: r["n"])]
    assert found == ["no_value", "bad_utf8", "bad_json", "not_a_list", "not_a_list", "ok", "ok", "not_a_list", "not_a_list", "ok"]


def test_item_checks(spark):
    items = [
        _record(), _record(title="DROP"), _record(title=5), _record(serves="many"), _record(modifiedOn="2024-01-02T00:00:00"),
        _record(images=[{"type": "tile"}]), _record(glassware=["teapot"]), _record(id="unknown"), _record(id=""), "text", None,
        _record(nutrition={"calories": 1.0}), _record(nutrition=None, extra=1), _record(keywords={}),
    ]
    decoded = decode.decode_messages(_messages(spark, [json.dumps({"data": items})]))
    rows = decode.check_items(decode.fan_out(decoded)).select("item_pos", "reject_reason", "bad_fields").collect()
    found = {r["item_pos"]: (r["reject_reason"], list(r["bad_fields"] or [])) for r in rows}
    assert found[0] == (None, []) and found[12] == (None, [])
    assert found[1] == ("bad_fields", ["title"]) and found[2] == ("bad_fields", ["title"])
    assert found[3] == ("bad_fields", ["serves"]) and found[4] == ("bad_fields", ["modifiedOn"])
    assert found[5] == ("bad_fields", ["images"]) and found[13] == ("bad_fields", ["keywords"])
    assert found[11] == ("bad_fields", ["nutrition"])
    assert [found[i][0] for i in (6, 7, 8, 9)] == ["bad_enum", "sentinel_id", "empty_id", "not_an_object"]
    assert found[10][0] in ("not_an_object", "no_item")
    records = decode.typed_records(decode.check_items(decode.fan_out(decoded))).select("record.*").collect()
    assert len(records) == 2 and records[0]["modifiedOn"].isoformat().startswith("2024-01-01T22:00")


def test_content_blocks(spark):
    contents = ['[{"text":"a"},{"type":"image"},"b"]', '"  s "', '["  "]', "7", "null"]
    frame = spark.createDataFrame(list(enumerate(contents)), "i int, j string")
    rows = frame.select("i", clean.blocks_to_text(F.parse_json("j")).alias("o")).collect()
    assert [r["o"] for r in sorted(rows)] == ["a\nb", "s", None, "7", None]


MD, HTML, EMOJI, JSON = clean.LIST_TOOLS


@pytest.mark.parametrize(
    "plan, status, rounds",
    [
        ([MD, MD], "no_progress", 2),
        ([MD], "plan_end", 1),
        ([HTML, MD], "plan_end", 2),
        ([MD, "other"], "unknown_tool", 1),
        (["other", MD], "plan_end", 1),
        ([MD, HTML] * 4, "plan_end", 8),
        ([MD, HTML] * 4 + [MD], "too_many_runs", 9),
        ([clean.LOOKUP_TOOL, clean.LOOKUP_TOOL], "plan_end", 2),
        ([], "plan_end", 0),
    ],
)
def test_tool_stop_rules(spark, plan, status, rounds):
    frame = spark.createDataFrame([("**x**", plan)], "content string, tools array<string>")
    row = clean.run_tools(frame, "content").collect()[0]
    assert (row["status"], row["rounds"]) == (status, rounds)
    shows = status != "too_many_runs" and any(t in clean.LIST_TOOLS for t in plan)
    assert row["final_text"] == (("x" if MD in plan else "**x**") if shows else None)


def test_first_allowed_call(spark):
    frame = spark.sql(
        f"SELECT array(named_struct('name','no','id','1'), named_struct('name','{MD}','id','2'), named_struct('name','{HTML}','id','3')) AS c"
    )
    assert frame.select(clean.first_allowed(F.col("c"))["id"]).collect()[0][0] == "2"


def _pack(blocks, limit):
    pieces, current = [], None
    for block in blocks:
        if current is not None and len(current) + 1 + len(block) <= limit:
            current += "\n" + block
        else:
            pieces += [current] if current is not None else []
            current = block
    return pieces + ([current] if current is not None else [])


@pytest.mark.parametrize("limit", [10, 40, 1000])
def test_oversize_split_equals_brute_force(spark, limit):
    blocks = [("w%d " % i) * (i % 7 + 1) for i in range(60)] + ["x" * 90, "é漢" * 20]
    frame = spark.createDataFrame([(C.SEP.join(blocks),)], "content string").select(
        F.array(F.struct(F.lit("other").alias("category"), F.col("content"))).alias("chunks")
    )
    got = frame.select(C.split_oversize(F.col("chunks"), limit).alias("p")).collect()[0]["p"]
    assert [p["content"] for p in got] == _pack(blocks, limit)


def test_headings_stay_with_their_text(spark):
    text = "# Method\nShake and strain.\nNote:\n \nPairs with fish, try it.\nThe end"
    frame = spark.createDataFrame([(1, text), (2, "Only a title"), (3, "")], "id int, text string")
    rows = {r["id"]: [b["text"] for b in r["blocks"]] for r in chunk.with_blocks(frame).collect()}
    assert rows[1] == ["# Method\nShake and strain.", "Note:\nPairs with fish, try it.\nThe end"]
    assert rows[2] == ["Only a title"] and rows[3] == []


def test_lists_do_not_swallow_what_follows(spark):
    recipe = "Ingredients\n2 oz gin\nLime juice\nSugar syrup\nDirections\nShake with ice.\nStrain well.\nServing hints\nTry it cold."
    bare = "Gin\nLime juice\nSugar syrup\nShake with ice."
    long_title = "A " + "very " * 40 + "long title\nIt was made in Paris."
    prose = "Mix it. Then add this:\nSoda water.\nnotes\nKeep cold."
    frame = spark.createDataFrame([(1, recipe), (2, bare), (3, long_title), (4, prose)], "id int, text string")
    rows = {r["id"]: [b["text"] for b in r["blocks"]] for r in chunk.with_blocks(frame).collect()}
    assert rows[1] == [
        "Ingredients\n2 oz gin", "Lime juice", "Sugar syrup", "Directions\nShake with ice.", "Strain well.",
        "Serving hints\nTry it cold.",
    ]
    assert rows[2] == ["Gin\nLime juice", "Sugar syrup", "Shake with ice."]
    assert rows[3] == [long_title]
    assert rows[4] == ["Mix it. Then add this:", "Soda water.", "notes\nKeep cold."]


def test_last_answer_and_attempts(spark):
    answers = ['[{"category":"other","content":"x"}]', '{"a":1}', '[{"category":"other"}]', '["x"]', "[", "[", "", "[]"]
    seconds = [None, None, None, None, '[{"category":"other","content":"y"}]', "[", None, None]
    frame = spark.createDataFrame(
        list(zip(range(8), answers, seconds)), "id int, first_answer string, second_answer string"
    )
    rows = sorted(infer.resolve(frame).collect(), key=lambda r: r["id"])
    assert [(r["status"], r["attempts"]) for r in rows] == [
        ("ok", 1), ("not_a_list", 1), ("wrong_keys", 1), ("not_a_list", 1), ("ok", 2), ("bad_syntax", 2), ("no_answer", 1),
        ("empty_list", 1),
    ]
    log = infer.attempt_log(infer.resolve(frame), "id").collect()
    assert len(log) == 10 and all((r["validation_error"] is None) == (r["attempt_number"] == 1) for r in log)


def test_model_repair_failure_and_timeout(spark):
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "id int, text string").select(
        "id", infer.chunk_request(F.col("text")).alias("messages")
    )

    def flaky():
        return lambda batch: ["[" if len(m) == 2 else f'[{{"category":"other","content":"{len(m)}"}}]' for m in batch]

    rows = infer.call_model(frame, "id", factory=flaky).collect()
    assert {(r["first_answer"], r["second_answer"]) for r in rows} == {("[", '[{"category":"other","content":"4"}]')}

    def broken():
        def call(batch):
            raise ValueError("no model")

        return call

    assert {r["error"] for r in infer.call_model(frame, "id", factory=broken).collect()} == {"ValueError: no model"}

    def slow():
        return lambda batch: time.sleep(3) or ["[]"] * len(batch)

    rows = infer.call_model(frame.limit(1), "id", factory=slow, row_seconds=0.2).collect()
    assert rows[0]["first_answer"] is None and "longer" in rows[0]["error"]


def test_version_rules(spark):
    records = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "id string, v int")
    log = spark.createDataFrame([("a", 5), ("b", 4)], "id string, version int")
    assert {r["id"] for r in dedup.skip_seen(records, log, "id", "v").collect()} == {"b", "c"}
    moved = dedup.advance_ledger(log, spark.createDataFrame([("a", 3), ("b", 5)], "id string, v int"), "id", "v")
    assert {tuple(r) for r in moved.collect()} == {("a", 5), ("b", 5)}


def test_lookup_error_text(spark):
    frame = spark.createDataFrame(
        [('{"title":"T","detail":"d"}',), ('{"title":"T"}',), ('{"detail":"d: "}',), ("{}",), ("no",)], "b string"
    ).withColumn("s", F.lit(404))
    texts = [r["error_text"] for r in dedup.lookup_errors(frame, "b", "s").collect()]
    head = "Record API request failed"
    assert texts == [f"{head}: T: d", f"{head}: T", f"{head}: Unknown error: d", f"{head} with status 404", f"{head} with status 404"]


def test_published_text_is_unescaped(spark):
    texts = ["a\nb", 'q"\\', "\U0001f600 \u00e9\t", "\\n", "", "\x01\x7f/"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    read = frame.select("t", X.json_unescape(X.json_escape(F.col("t"))).alias("back")).collect()
    assert all(r["t"] == r["back"] for r in read)


def test_hit_lists_of_a_hot_record_are_whole_and_bounded(spark):
    hits = spark.range(1000).select(
        F.lit("q").alias("request_id"),
        F.when(F.col("id") < 900, "hot").otherwise("cold").alias("record_id"),
        F.col("id").alias("chunk_id"),
        (F.col("id") / 1000).alias("score"),
    )
    lists = search.hit_lists(hits, search.search_statistics(hits), per_list=100).collect()
    assert sum(len(r["scores"]) for r in lists) == 1000 and max(len(r["scores"]) for r in lists) <= 100
    assert all(r["scores"] == sorted(r["scores"], reverse=True) for r in lists)


def test_weighted_score_of_the_published_sample(spark):
    hits = spark.createDataFrame([("q", "r", i, 0.481590) for i in range(3)], "request_id string, record_id string, chunk_id long, score double")
    row = search.search_statistics(hits).collect()[0]
    assert round(row["weighted_score"], 6) == 0.626067 and row["hit_count"] == 3


def test_overlap_rules(spark):
    items = spark.createDataFrame(
        [("r1", 1, "base"), ("r1", 2, "garnishment"), ("r1", 2, "base"), ("r2", 1, "base"), ("r3", 9, "base"), ("r3", 8, "base")],
        "record_id string, item_id int, application string",
    )
    counts = matching.overlap_counts(items, spark.createDataFrame([(1,), (1,)], "item_id int"))
    assert {tuple(r) for r in counts.collect()} == {("r1", 2, 1, 1, 1), ("r2", 1, 1, 0, 0), ("r3", 2, 0, 2, 0)}
    found = lambda **kw: {r["record_id"] for r in matching.overlap_match(counts, **kw).collect()}
    assert found(minimum=1) == {"r1", "r2"} and found(minimum=2) == {"r2"}
    assert found(coverage=["exact"]) == {"r2"}
    assert found(coverage=["exact"], ignore_missing_garnish=True) == {"r1", "r2"}
    assert found(coverage=["all", "exact"]) == {"r1", "r2"}


def test_upserts(spark):
    index = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], "id string, version int, v string")
    batch = spark.createDataFrame([("a", 2, "x"), ("a", 3, "y"), ("c", 1, "z")], "id string, version int, v string")
    assert {(r["id"], r["v"]) for r in sinks.upsert(index, batch, "id", "version").collect()} == {("a", "y"), ("b", "old"), ("c", "z")}
    records = spark.sql("SELECT 1 AS id, array(named_struct('type','p','url','1'), named_struct('type','f','url','2')) AS socialLinks")
    updates = spark.createDataFrame([(1, "p", "new", 2), (1, "p", "older", 1), (1, "x", "3", 1)], "id int, type string, url string, version int")
    links = catalogue.upsert_links(records, updates, "id").collect()[0]["socialLinks"]
    assert [tuple(k) for k in links] == [("p", "new"), ("f", "2"), ("x", "3")]


def test_requests_and_chain(spark):
    ran = ledger.run_chain(feeds.records(spark, SMALL)).cache()
    assert ran.filter("reject_reason IS NULL AND request IS NULL").count() == 0
    assert ran.filter("reject_reason = 'bad_enum' AND doc_id % 23 <> 5").count() == 0
    lost = ran.filter(F.forall("content_chunks", lambda c: ~F.contains(F.col("text"), F.split(c["content"], "\n")[0])))
    assert lost.count() == 0
    outcome = spark.createDataFrame([(s,) for s in (204, 401, 403, 422, 500, 418)], "s int").select(shape.delivery_outcome(F.col("s")))
    assert [r[0].split(":")[0] for r in outcome.collect()] == [
        "delivered", "runtime_error", "runtime_error", "value_error", "runtime_error", "unexpected_status",
    ]


def test_quarantine_and_ledger_tables(spark, tmp_path):
    answers = spark.createDataFrame(
        [(1, '{"a":1}', None), (2, "[", "["), (3, "", None), (4, "[]", None)], "id int, first_answer string, second_answer string"
    )
    resolved = infer.resolve(answers)
    sinks.write_quarantine(infer.quarantine(resolved, "id"), f"{tmp_path}/bad")
    kept = spark.read.json(f"{tmp_path}/bad").collect()
    assert {(r["id"], r["stage"], r["answer"]) for r in kept} == {(1, "first", '{"a":1}'), (2, "second", "[")}
    rows = ledger.append_outcomes(
        ledger.outcome_rows(resolved, "id", "extraction", F.lit(True)),
        ledger.outcome_rows(resolved, "id", "chunking", F.coalesce(F.size("chunks") > 0, F.lit(False))),
    )
    assert {tuple(r) for r in ledger.newest_state(rows).collect()} == {(i, "chunking-failed", 2) for i in (1, 2, 3, 4)}
    assert {r["state"] for r in rows.collect()} <= set(feeds.S.STATES)


def test_coverage_forms_agree(spark):
    rows = spark.createDataFrame(
        [(1, "a\nb\nb\nc", [("other", "a\nb"), ("other", "d")]), (2, "x", [("other", "x")])],
        "id int, text string, chunks array<struct<category:string,content:string>>",
    )
    in_row = {tuple(r) for r in chunk.coverage_audit_in_row(rows, "id", "text").collect()}
    joined = {tuple(r) for r in chunk.coverage_audit(rows, chunk.chunk_rows(rows, "id"), "id").collect()}
    assert in_row == joined and sorted(r[4] for r in in_row) == ["added", "omitted", "omitted"]


def test_kafka_options():
    options = M.kafka_options("b:1", "topic", "group", "none", consumers=4)
    assert options["failOnDataLoss"] == "true" and options["minPartitions"] == "4" and options["includeHeaders"] == "true"
    for bad in ({"auto_offset_reset": "middle"}, {"max_poll_interval_ms": 10}):
        with pytest.raises(ValueError):
            M.kafka_options("b", "t", "g", **bad)


def test_message_files_stream_and_index(spark, tmp_path):
    good = lambda v, title: json.dumps({"data": [_record(id="a", title=title, serves=v), _record(id=f"n{v}", serves=v)]})
    for n, value in enumerate([good(1, "first"), good(2, "second"), "{"]):
        one = spark.createDataFrame([(value.encode(),)], "value binary").select(
            F.lit(b"k").alias("key"), "value", F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
            F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(n).cast("long").alias("offset"),
            F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
        ).coalesce(1)
        M.write_message_files(one, f"{tmp_path}/in/m{n}")
        time.sleep(1.1)  # file sources order by modification time
    assert M.file_messages(spark, f"{tmp_path}/in/*").count() == 3
    items = jobs.decoded_items(M.file_stream(spark, f"{tmp_path}/in/*", files_per_trigger=1))
    rows = items.filter("reject_reason IS NULL").select("id", F.col("offset").alias("version"), F.col("typed.title").alias("title"))
    jobs.index_stream(rows, f"{tmp_path}/index", f"{tmp_path}/cp").awaitTermination()
    current = {r["id"]: r["title"] for r in jobs.read_index(spark, f"{tmp_path}/index").collect()}
    assert current == {"a": "second", "n1": "t", "n2": "t"}
    jobs.compact_index(spark, f"{tmp_path}/index", f"{tmp_path}/compact")
    assert jobs.read_index(spark, f"{tmp_path}/compact").count() == 3
    late = jobs.decoded_items(M.file_stream(spark, f"{tmp_path}/in/*", files_per_trigger=1)).filter("id = 'a'")
    late = late.select("id", F.col("offset").alias("version"), F.lit("late").alias("title"))
    for _ in range(2):  # the second start finds nothing new and the same run
        jobs.index_stream(late, f"{tmp_path}/compact", f"{tmp_path}/other").awaitTermination()
    merged = {r["id"]: r["title"] for r in jobs.read_index(spark, f"{tmp_path}/compact").collect()}
    assert merged == {"a": "late", "n1": "t", "n2": "t"}
    assert jobs.index_run(spark, f"{tmp_path}/compact", f"{tmp_path}/other").startswith("00001-")
    assert jobs.index_run(spark, f"{tmp_path}/compact", f"{tmp_path}/third").startswith("00002-")


def test_stream_versions_across_triggers(spark, tmp_path):
    triggers = [[("a", 5), ("a", 4), ("b", 1)], [("a", 4), ("b", 1)], [("a", 5), ("b", 2), ("c", 1), ("c", 3)]]
    for n, rows in enumerate(triggers):
        frame = spark.createDataFrame(rows, "id string, s long").select("id", F.timestamp_seconds("s").alias("ts"))
        frame.coalesce(1).write.parquet(f"{tmp_path}/in/t{n}")
        time.sleep(1.1)
    stream = spark.readStream.schema("id string, ts timestamp").option("maxFilesPerTrigger", "1").parquet(f"{tmp_path}/in/*")
    jobs.version_filter(stream, "id", "ts", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    out = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out").collect()
    assert sorted((r["batch"], r["id"], r["version_us"] // 10**6) for r in out) == [
        (0, "a", 5), (0, "b", 1), (2, "b", 2), (2, "c", 3),
    ]


def test_one_row_costs_no_other_its_answer(spark):
    rows = [(f"r{i}", [{"role": "system", "content": ""}, {"role": "user", "content": str(i)}]) for i in range(6)]
    frame = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>").coalesce(1)

    def factory():
        def model(batch):
            if any(messages[1]["content"] == "3" for messages in batch):
                raise ValueError("no")
            return ["[]" for _ in batch]

        return model

    got = {r.id: (r.first_answer, r.error) for r in infer.call_model(frame, "id", factory=factory).collect()}
    assert got.pop("r3") == (None, "ValueError: no")
    assert set(got.values()) == {("[]", None)} and len(got) == 5


def test_json_must_end_with_its_value(spark):
    cases = {
        '[{"a": 1}]': True, '[{"a": 1}] Hope this helps!': False, '{"data": []} trailing': False, "1, 2": False, "1] x": False,
        "1} x": False, " [1] ": True, "": False, "null": True, "[1": False, "[1][2]": False,
    }
    frame = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r.t: r.ok for r in frame.select("t", decode.strict_json(F.col("t")).isNotNull().alias("ok")).collect()}
    assert got == cases


def test_republish_without_a_list(spark):
    records = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, v int")
    ids = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    found = lambda ids, all_: sorted(r.v for r in catalogue.republish_set(records, ids, "id", all_).collect())
    assert found(ids, True) == found(ids, False) == [1]
    assert found(ids.limit(0), True) == [1, 2, 3] and found(ids.limit(0), False) == []


def test_worker_and_judge_read_json_alike(spark):
    repeated = '[{"category":"a","content":"x","content":"y"}]'
    answers = {
        repeated: ("ok", 1, "y"),
        '[{"category":"a","content":"x"}]': ("ok", 1, "x"),
        '[{"category":"a","content":"x"}] Done!': ("bad_syntax", 2, None),
        '[{"category":"a","content":NaN}]': ("bad_syntax", 2, None),
        '[{"category":"a"}]': ("wrong_keys", 1, None),
        '{"category":"a","content":"x"}': ("not_a_list", 1, None),
        "[]": ("empty_list", 1, None),
        "": ("no_answer", 1, None),
    }
    frame = spark.createDataFrame([(a,) for a in answers], "id string")
    asked = frame.select("id", infer.chunk_request(F.col("id")).alias("messages"))

    def parrot():
        def said(messages):
            text = messages[1]["content"]
            return text[text.index(infer.SOURCE_OPEN) + len(infer.SOURCE_OPEN) : text.rindex(infer.SOURCE_CLOSE)]

        return lambda batch: [said(m) for m in batch]

    told = infer.call_model(asked, "id", parrot)
    for judged in (infer.resolve(told), infer.resolve(told.drop("asked_again"))):
        got = {r.id: (r.status, r.attempts, r.chunks[0].content if r.chunks else None) for r in judged.collect()}
        assert got == answers


def test_repair_message_is_the_one_that_is_sent(spark):
    bad = "[no"
    frame = spark.createDataFrame([("1", "text")], "id string, text string").select("id", infer.chunk_request(F.col("text")).alias("messages"))

    def echo():
        return lambda batch: [bad if len(m) == 2 else json.dumps(m) for m in batch]

    sent = json.loads(infer.call_model(frame, "id", echo).first().second_answer)
    request = infer.repair_request(F.col("messages"), F.lit(bad), infer.syntax_error(F.lit(bad)))
    assert sent == [m.asDict() for m in frame.select(request.alias("m")).first().m]
