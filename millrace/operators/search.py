"""Statistics of vector hits, hit lists and ranked pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.vectors import SCORE_DIGITS
from millrace.session import shared_dir

HIT_BOOST = 0.1
HITS_PER_LIST = 256


def search_statistics(hits: DataFrame, boost: float = HIT_BOOST) -> DataFrame:
    """Sum, best, mean, boosted mean and number of hits per (request, record).

    Scores are summed as whole millionths, so the result does not depend on the order
    in which partial sums meet.
    """
    unit = 10**SCORE_DIGITS
    micro = F.round(F.col("score") * unit).cast("long")
    sums = hits.groupBy("request_id", "record_id").agg(
        F.sum(micro).alias("micro"), F.max("score").alias("max_score"), F.count(F.lit(1)).alias("hit_count")
    )
    mean = F.col("micro").cast("double") / F.col("hit_count") / unit
    return sums.select(
        "request_id",
        "record_id",
        (F.col("micro").cast("double") / unit).alias("total_score"),
        "max_score",
        mean.alias("avg_score"),
        (mean * (1 + boost * F.col("hit_count"))).alias("weighted_score"),
        "hit_count",
    )


def hit_lists(
    hits: DataFrame, statistics: DataFrame, per_list: int = HITS_PER_LIST, spread_by: Column | None = None
) -> DataFrame:
    """Hit scores per (request, record) as lists, best first.

    A record with very many hits gets several lists, dealt out by a hash of the chunk
    id; a hand that comes out over ``per_list`` is cut again by rank.  So no list is
    longer than that, and every hit is in one of them.  Ranking and collecting share
    one shuffle.
    """
    dealt = F.xxhash64("chunk_id") if spread_by is None else spread_by
    lists = statistics.select(
        "request_id", "record_id", F.ceil(F.col("hit_count") / per_list).cast("int").alias("n_lists")
    )
    hand = Window.partitionBy("request_id", "record_id", "hand").orderBy(F.col("score").desc(), "chunk_id")
    part = F.floor((F.row_number().over(hand) - 1) / per_list)
    return (
        hits.join(lists, ["request_id", "record_id"])
        .withColumn("hand", F.pmod(dealt, F.col("n_lists")))
        .withColumn("list_no", F.col("hand") + F.col("n_lists") * part)
        .groupBy("request_id", "record_id", "hand", "list_no")
        .agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
        .drop("hand")
    )


def search_page(statistics: DataFrame, skip: int = 0, take: int = 10, score: str = "weighted_score") -> DataFrame:
    """One page of the ranking; Spark keeps only skip + take rows per partition."""
    ranked = statistics.orderBy(F.col(score).desc(), "request_id", "record_id")
    return ranked.offset(skip).limit(take)


def write_ranking(statistics: DataFrame, path: str, score: str = "weighted_score") -> None:
    """The whole ranking as a table in order, best first, with each row's ``position`` from 0.

    Rows are sorted in range partitions.  A row's place in its partition comes from its row
    id, and one count per partition, through the driver, tells where each partition starts.
    """
    context = statistics.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(statistics.sparkSession))
    by = [F.col(score).desc(), "request_id", "record_id"]
    ranked = statistics.repartitionByRange(*by).sortWithinPartitions(*by).checkpoint()
    own = ranked.withColumn("_part", F.spark_partition_id()).withColumn(
        "_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    )
    counts = own.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts, total = {}, 0
    for r in counts:
        starts[r["_part"]], total = total, total + r["n"]
    start = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("_part")) if starts else F.lit(0)
    own.withColumn("position", (start + F.col("_row")).cast("long")).drop("_part", "_row").write.parquet(path)


def page_at(ranking: DataFrame, position: int, take: int) -> DataFrame:
    """Rows from a position on.  Both ends reach the scan, which skips all other row groups, so every page costs the same."""
    return ranking.filter(F.col("position").between(position, position + take - 1)).orderBy("position")


def page_after(ranking: DataFrame, last: tuple, take: int, score: str = "weighted_score") -> DataFrame:
    """The page behind a row given as (score, request_id, record_id); the row need not be there any more.

    The rows of the same score are the only ones read to find the place.
    """
    value, request, record = last
    same = ranking.filter(F.col(score) == value)
    behind = (F.col("request_id") > request) | ((F.col("request_id") == request) & (F.col("record_id") > record))
    found = same.agg(F.min(F.when(behind, F.col("position"))).alias("first"), F.max("position").alias("last")).first()
    if found["first"] is not None:
        place = found["first"]
    elif found["last"] is not None:
        place = found["last"] + 1
    else:
        lower = ranking.filter(F.col(score) < value).agg(F.min("position")).first()[0]
        place = lower if lower is not None else 1 << 62
    return page_at(ranking, place, take)
