"""The message log and the stages between logs: offsets, limits, tokens, reruns."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import decode
from millrace.sources import message_log, sinks
from millrace.streaming import stages


def messages(spark, *values):
    rows = [(f"k{v}".encode(), str(v).encode()) for v in values]
    return spark.createDataFrame(rows, "key binary, value binary")


def values(log):
    return sorted(bytes(r.value).decode() for r in log.select("value").collect())


def test_log_gives_places_and_takes_a_token_once(spark, tmp_path):
    path = f"{tmp_path}/log"
    message_log.publish(messages(spark, 1, 2, 3).repartition(2), path, "a")
    message_log.publish(messages(spark, 1, 2, 3), path, "a")
    message_log.publish(messages(spark, 4), path, "b")
    log = message_log.read_log(spark, path)
    rows = log.collect()
    assert values(log) == ["1", "2", "3", "4"]
    assert len({(r.partition, r.offset) for r in rows}) == 4 and {r.topic for r in rows} == {"log"}
    assert all(r.headers is None and r.timestamp is None for r in rows)
    assert len(message_log.Log(path).manifests()) == 2
    assert len(list((tmp_path / "log" / "data").iterdir())) == sum(len(message_log.Log(path).manifest(m)["files"]) for m in message_log.Log(path).manifests())


def test_log_keeps_given_places_headers_and_nulls(spark, tmp_path):
    rows = [(None, None, [("h", b"\xff"), ("n", None)], None, 3, 70), (b"", b"x", [], "t", None, 5)]
    ddl = "key binary, value binary, headers array<struct<key:string,value:binary>>, topic string, partition int, offset long"
    given = spark.createDataFrame(rows, ddl)
    message_log.publish(given, f"{tmp_path}/log")
    read = message_log.read_log(spark, f"{tmp_path}/log").select(*given.columns)
    assert sorted(map(repr, read.collect())) == sorted(map(repr, given.collect()))


def test_empty_and_missing_logs(spark, tmp_path):
    message_log.publish(messages(spark, 1).filter("false"), f"{tmp_path}/empty")
    assert message_log.read_log(spark, f"{tmp_path}/empty").count() == 0
    assert message_log.read_log(spark, f"{tmp_path}/missing").count() == 0
    with pytest.raises(Exception, match="only appended"):
        messages(spark, 1).write.format("message_log").mode("overwrite").save(f"{tmp_path}/empty")


def test_stream_admits_commits_and_goes_on_after_a_restart(spark, tmp_path):
    path, seen = f"{tmp_path}/log", []
    for v in range(5):
        message_log.publish(messages(spark, v), path)

    def run():
        stream = message_log.read_log_stream(spark, path, max_commits=2)
        query = (
            stream.writeStream.option("checkpointLocation", f"{tmp_path}/cp")
            .foreachBatch(lambda b, n: seen.append((n, values(b))))
            .start()
        )
        query.processAllAvailable()
        query.stop()

    run()
    assert seen == [(0, ["0", "1"]), (1, ["2", "3"]), (2, ["4"])]
    message_log.publish(messages(spark, 5, 6), path)
    message_log.publish(messages(spark, 7), path)
    message_log.publish(messages(spark, 8), path)
    run()
    assert [v for _, vs in seen for v in vs] == [str(v) for v in range(9)]


def test_stream_writer_commits_each_batch_once(spark, tmp_path):
    message_log.publish(messages(spark, 1, 2), f"{tmp_path}/in")

    def run(checkpoint):
        stream = message_log.read_log_stream(spark, f"{tmp_path}/in")
        writer = stream.writeStream.format("message_log").option("token", "copy").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()

    run(f"{tmp_path}/cp1")
    # The same batch again, as after a failure that lost the checkpoint's commit.
    run(f"{tmp_path}/cp2")
    assert values(message_log.read_log(spark, f"{tmp_path}/out")) == ["1", "2"]


def rows_of(messages):
    parsed = F.from_json(F.col("value").cast("string"), "id string, version timestamp, text string")
    return messages.select(parsed.alias("row"), "headers").select("row.*", "headers")


def kept_text(due):
    return due.select("*", (F.trim("text") != "").alias("succeeded"), F.encode("id", "UTF-8").alias("key"), F.encode("text", "UTF-8").alias("value"))


STAGE = stages.Stage("keep", rows_of, kept_text)


def announce(spark, path, *rows):
    frame = spark.createDataFrame(rows, "id string, day int, text string")
    frame = frame.select("id", F.expr("timestampadd(DAY, day, timestamp '2024-01-01')").alias("version"), "text")
    message_log.publish(sinks.result_messages(frame, "id", F.struct("id", "version", "text")), path)


def run(spark, tmp_path):
    stream = message_log.read_log_stream(spark, f"{tmp_path}/in", group="keep")
    stages.run_stage(STAGE, stream, f"{tmp_path}/keep", f"{tmp_path}/out").awaitTermination()
    return values(message_log.read_log(spark, f"{tmp_path}/out"))


def done(spark, tmp_path):
    return {r.id: r.version.day for r in stages.ledger_before(spark, f"{tmp_path}/keep/ledger").collect()}


def test_blank_text_is_tried_again_and_old_versions_are_skipped(spark, tmp_path):
    announce(spark, f"{tmp_path}/in", ("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, " "), ("c", 3, "c3"))
    assert run(spark, tmp_path) == ["a2", "c3"]
    assert done(spark, tmp_path) == {"a": 3, "c": 4}
    announce(spark, f"{tmp_path}/in", ("a", 1, "a1 late"), ("a", 2, "a2 again"), ("b", 1, "b1"), ("c", 4, ""))
    assert run(spark, tmp_path) == ["a2", "b1", "c3"]
    assert done(spark, tmp_path) == {"a": 3, "b": 2, "c": 4}
    states = {r.id: r.state for r in stages.outcomes(spark, "keep", f"{tmp_path}/keep").collect()}
    assert states == {"a": "keep-succeeded", "b": "keep-succeeded", "c": "keep-failed"}


def test_failed_publish_advances_nothing_and_a_rerun_publishes_once(spark, tmp_path, monkeypatch):
    announce(spark, f"{tmp_path}/in", ("a", 1, "a1"), ("b", 1, "b1"))
    batch = message_log.read_log(spark, f"{tmp_path}/in")
    own = (STAGE, f"{tmp_path}/keep", f"{tmp_path}/out")
    publish = message_log.publish
    monkeypatch.setattr(message_log, "publish", lambda *a: (_ for _ in ()).throw(OSError("no route")))
    with pytest.raises(OSError):
        stages.run_batch(batch, 0, *own)
    assert done(spark, tmp_path) == {}

    def publish_then_fail(*args):
        publish(*args)
        raise OSError("lost before the ledger")

    monkeypatch.setattr(message_log, "publish", publish_then_fail)
    with pytest.raises(OSError):
        stages.run_batch(batch, 0, *own)
    assert done(spark, tmp_path) == {}
    monkeypatch.setattr(message_log, "publish", publish)
    for _ in range(2):
        stages.run_batch(batch, 0, *own)
        assert values(message_log.read_log(spark, f"{tmp_path}/out")) == ["a1", "b1"]
    assert done(spark, tmp_path) == {"a": 2, "b": 2}


def test_folded_ledger_reads_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stages, "KEPT_BATCHES", 2)
    folder = f"{tmp_path}/keep"
    stages.seed_ledger(spark.sql("SELECT 'z' AS id, timestamp '2024-01-09' AS version"), folder)
    for n in range(5):
        announce(spark, f"{tmp_path}/in{n}", ("a", n, f"a{n}"), (f"b{n}", 1, "b"), ("z", 3, "old"))
        stages.run_batch(message_log.read_log(spark, f"{tmp_path}/in{n}"), n, STAGE, folder, f"{tmp_path}/out")
    assert stages.folders(spark, f"{folder}/ledger", "base=") == [-1, 1, 3]
    assert done(spark, tmp_path) == {"a": 5, "z": 9, **{f"b{n}": 2 for n in range(5)}}
    assert {r.id for r in stages.ledger_before(spark, f"{folder}/ledger", 2).collect()} == {"a", "z", "b0", "b1"}


def test_chain_connects_three_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    from millrace.plans import feeds

    given = feeds.messages(spark, sf).drop("event_id")
    message_log.publish(given, f"{tmp_path}/events")
    logs = stages.run_chain(spark, f"{tmp_path}/events", str(tmp_path))
    first = {n: message_log.read_log(spark, p).count() for n, p in logs.items()}
    assert first["extraction"] == first["chunking"] == first["embedding"] > 0
    bodies = message_log.read_log(spark, logs["embedding"]).collect()
    assert all(b"content_chunks" in bytes(b.value) for b in bodies)
    assert any(h.key == "trace" for b in bodies for h in b.headers or [])
    message_log.publish(given, f"{tmp_path}/events")  # the same versions again
    logs = stages.run_chain(spark, f"{tmp_path}/events", str(tmp_path))
    assert {n: message_log.read_log(spark, p).count() for n, p in logs.items()} == first


def test_chain_publishes_records_under_a_given_key(spark, tmp_path):
    from millrace.plans import feeds

    message_log.publish(feeds.messages(spark, "/root/testdata/sf0.001").drop("event_id").limit(400), f"{tmp_path}/events")
    logs = stages.run_chain(spark, f"{tmp_path}/events", str(tmp_path), record_key="the item's `model`")
    read = lambda name: message_log.read_log(spark, logs[name])
    assert all(b'"the item\'s `model`":{' in bytes(r.value) for r in read("extraction").collect())
    key = {"record_key": "the item's `model`"}
    ids = lambda frame: sorted(r.id for r in frame.select("record.id").collect())
    found = ids(decode.decode_extractions(read("extraction"), **key))
    assert found and None not in found and found == ids(decode.decode_chunk_results(read("chunking"), **key))
    assert read("embedding").count() == len(found)
    assert {r.id for r in decode.decode_extractions(read("extraction")).select("record.id").collect()} == {None}
