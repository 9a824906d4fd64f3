"""Queries over event time, several levels and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import decode, summaries, temporal
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query
from millrace.session import run_dir
from millrace.sources import message_log
from millrace.streaming import windows

_NEW = "event_type IN ('purchase', 'signup')"


@query(
    O.sql(
        """SELECT l.event_id, l.id, v.event_id AS version_id, v.event_type AS version_type
           FROM f_lookups l ASOF LEFT JOIN f_versions v ON l.id = v.id AND l.ts >= v.ts""",
        f_versions=f"SELECT id, ts, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM f_events WHERE {_NEW} GROUP BY id, ts",
        f_lookups=f"SELECT * FROM f_events WHERE NOT {_NEW}",
    )
)
def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each event saw: the record version that was valid when it came."""
    events = feeds.events(spark, sf_dir).select("event_id", "id", "ts", "event_type")
    versions = events.filter(F.expr(_NEW))
    seen = temporal.as_of(events.filter(~F.expr(_NEW)), versions, "id", "ts", "event_id")
    return seen.select(
        "event_id", "id", F.col("version.event_id").alias("version_id"), F.col("version.event_type").alias("version_type")
    )


@query(
    O.sql(
        """SELECT event_id, count(*) AS n_shown, min(p_partkey) AS first_shown, sum(p_partkey)::BIGINT AS key_sum
           FROM f_events JOIN f_periods ON ts >= shown_from AND ts < shown_until GROUP BY event_id""",
        f_periods=f"""SELECT p_partkey, TIMESTAMP '{feeds.BASE_INSTANT}' + to_minutes(p_partkey * 37 % 43200) AS shown_from,
                        TIMESTAMP '{feeds.BASE_INSTANT}' + to_minutes(p_partkey * 37 % 43200 + p_size * p_size) AS shown_until FROM part""",
    )
)
def displayed_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many display periods hold each event."""
    begin = F.col("p_partkey") * 37 % 43200
    periods = feeds.table(spark, sf_dir, "part").select(
        "p_partkey",
        feeds.minutes_after_base(begin).alias("shown_from"),
        feeds.minutes_after_base(begin + F.col("p_size") * F.col("p_size")).alias("shown_until"),
    )
    events = feeds.events(spark, sf_dir).select("event_id", "ts")
    shown = temporal.in_periods(events, periods, "ts", "shown_from", "shown_until", totals=("event_id", "p_partkey"))
    return shown.select("event_id", F.col("n").alias("n_shown"), F.col("least").alias("first_shown"), F.col("total").alias("key_sum"))


# Events come in six deliveries of five days; one in fifty comes three deliveries late.
_DELIVERY = "least(CAST(floor((epoch({ts}) - 1704067200) / 432000) AS INT), 5)"
_DELAYED = "event_id % 50 = 7 AND delivery <= 2"


def _delivered(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Events published to a log delivery by delivery."""
    delivery = F.least(F.floor((F.unix_micros("ts") - 1_704_067_200_000_000) / 432_000_000_000).cast("int"), F.lit(5))
    events = feeds.events(spark, sf_dir).select("event_id", "id", "ts", "event_type").withColumn("delivery", delivery)
    comes = F.when(F.expr(_DELAYED), F.col("delivery") + 3).otherwise(F.col("delivery"))
    value = F.to_json(F.struct("event_id", "event_type"))
    messages = events.select(
        comes.alias("comes"), F.encode("id", "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"), F.col("ts").alias("timestamp")
    )
    for number in range(6):
        message_log.publish(messages.filter(F.col("comes") == number).drop("comes"), f"{folder}/log", f"delivery {number}")
    return _opened(message_log.read_log(spark, f"{folder}/log"))


def _opened(messages: DataFrame) -> DataFrame:
    body = F.from_json(F.col("value").cast("string"), "event_id long, event_type string")
    return messages.select(F.col("key").cast("string").alias("id"), F.col("timestamp").alias("ts"), body.alias("body")).select("id", "ts", "body.*")


_ARRIVED = f"SELECT *, {_DELAYED} AS late FROM (SELECT *, {_DELIVERY.format(ts='ts')} AS delivery FROM f_events)"


@query(
    O.sql(
        """SELECT epoch_us(opens) AS window_us, event_type, count(*) FILTER (NOT late) AS n, count(*) FILTER (late) AS n_late
           FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS opens FROM f_arrived)
           GROUP BY ALL""",
        f_arrived=_ARRIVED,
    )
)
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type in windows of 12 hours every 6 hours, counted as they come, and the late ones."""
    folder = run_dir(spark, "sliding")
    rows = _delivered(spark, sf_dir, folder)
    span = ("12 hours", "6 hours")
    stream = _opened(message_log.read_log_stream(spark, f"{folder}/log", max_commits=1))
    running = windows.write_log(
        windows.sliding_counts(stream, "ts", "1 day", *span, "event_type"), f"{folder}/counts", f"{folder}/checkpoint", "update"
    )
    running.processAllAvailable()
    running.stop()
    counted = windows.newest_counts(spark.read.option("basePath", f"{folder}/counts").parquet(f"{folder}/counts"), "event_type")
    result = windows.with_late(counted, rows, "ts", *span, "event_type")
    return result.select(F.unix_micros("window.start").alias("window_us"), "event_type", "n", "n_late")


@query(
    O.sql(
        """SELECT id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS last_us, count(*) AS n
           FROM (SELECT id, ts, sum(fresh) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session
                 FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
                       FROM f_arrived WHERE NOT late))
           GROUP BY id, session HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT max(ts) - INTERVAL 1 DAY FROM f_arrived)""",
        f_arrived=_ARRIVED,
    )
)
def closed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each record's events that the watermark has closed; late events open none."""
    folder = run_dir(spark, "sessions")
    _delivered(spark, sf_dir, folder)
    stream = _opened(message_log.read_log_stream(spark, f"{folder}/log", max_commits=1))
    running = windows.write_log(windows.sessions(stream, "ts", "1 day", "2 hours", "id"), f"{folder}/out", f"{folder}/checkpoint", "append")
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(f"{folder}/out").select(
        "id", F.unix_micros("session_window.start").alias("start_us"), F.unix_micros("last").alias("last_us"), "n"
    )


_OUTCOMES = """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN body IS NULL THEN 'no_value' WHEN text IS NULL THEN 'bad_utf8'
        WHEN payload IS NULL THEN 'bad_json' WHEN items IS NULL THEN 'not_a_list' ELSE 'ok' END AS outcome FROM f_itemized"""


def _message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = feeds.events(spark, sf_dir).select("event_id", "event_type")
    decoded = decode.decode_messages(feeds.messages(spark, sf_dir))
    judged = decoded.select("event_id", F.date_format("timestamp", "yyyy-MM-dd").alias("day"), decode.message_outcome().alias("outcome"))
    return judged.join(types, "event_id")


@query(
    O.sql(
        """SELECT event_type, day, outcome, CAST(grouping(event_type, day, outcome) AS INT) AS level, count(*) AS n
           FROM f_outcomes GROUP BY CUBE (event_type, day, outcome)""",
        f_outcomes=_OUTCOMES,
    )
)
def outcome_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message outcomes by type, day and reason on all levels."""
    return summaries.count_levels(_message_outcomes(spark, sf_dir), ["event_type", "day", "outcome"])


@query(
    O.sql(
        """SELECT event_type, day, outcome, CAST(grouping(event_type, day, outcome) AS INT) AS level, count(*) AS n
           FROM f_outcomes GROUP BY GROUPING SETS ((event_type, day), (day, outcome), (outcome), ())""",
        f_outcomes=_OUTCOMES,
    )
)
def outcome_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message outcomes on four chosen levels."""
    levels = [["event_type", "day"], ["day", "outcome"], ["outcome"], []]
    return summaries.count_levels(_message_outcomes(spark, sf_dir), ["event_type", "day", "outcome"], levels)


@query(
    O.sql(
        """SELECT event_type, count(*) AS n, true AS items_close, true AS median_close, true AS p90_close FROM f_events GROUP BY event_type"""
    )
)
def value_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct records and value quantiles per type from daily sketches, against the exact numbers.

    Sketches are made per type and day and merged; a quantile is close if the share of
    values up to it is within four percent, a distinct count within ten.
    """
    events = feeds.events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    merged = summaries.merge(summaries.sketch(events, ["event_type", "day"], "id", "value"), ["event_type"])
    told = merged.select(
        "event_type", "n", summaries.distinct().alias("items"),
        summaries.quantile(0.5).alias("median"), summaries.quantile(0.9).alias("p90"),
    )
    below = lambda c: (F.count(F.when(F.col("value") <= F.col(c), 1)) / F.max("n")).alias(f"{c}_share")
    exact = events.join(told, "event_type").groupBy("event_type").agg(
        F.max("n").alias("n"), F.max("items").alias("items"), F.count_distinct("id").alias("exact"), below("median"), below("p90")
    )
    return exact.select(
        "event_type",
        "n",
        (F.abs(F.col("items") - F.col("exact")) <= 0.1 * F.col("exact")).alias("items_close"),
        (F.abs(F.col("median_share") - 0.5) <= 0.04).alias("median_close"),
        (F.abs(F.col("p90_share") - 0.9) <= 0.04).alias("p90_close"),
    )
