"""Joins over time: the version valid at a moment, and the periods that hold a moment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import shared_dir

LEVELS = 48  # sizes of bins, each twice the one before


def _fixed(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, however often they are read."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def as_of(lookups: DataFrame, versions: DataFrame, key: str, time: str, order: str) -> DataFrame:
    """Every lookup with its newest version at that time: the columns of ``lookups`` and ``version``.

    ``version`` is a struct of the columns of ``versions``, null where no version is that
    old.  Of versions of one time the one with the highest ``order`` counts.  A null key or
    time meets nothing.

    Versions and lookups are sorted together by (key, time) in range partitions, so a key
    with very many rows lies in several of them.  A sweep over a partition carries the
    newest version along; what is carried over a partition's edge is one row per
    partition, which goes through the driver.
    """
    whole = lambda df: F.struct(*df.columns)
    named = lambda df, kind, tie: [
        F.col(key).alias("key"), F.col(time).alias("time"), F.lit(kind).alias("kind"), tie.alias("tie")
    ]
    known = versions.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = known.select(*named(known, 0, F.col(order)), whole(known).alias("version")).unionByName(
        lookups.select(*named(lookups, 1, F.lit(None).cast(known.schema[order].dataType)), whole(lookups).alias("lookup")),
        allowMissingColumns=True,
    )
    by = [F.col(c).asc_nulls_first() for c in ("key", "time", "kind", "tie")]
    rows = _fixed(rows.repartitionByRange(*by).sortWithinPartitions(*by)).withColumn("part", F.spark_partition_id())
    edges = rows.select("part", "key", "kind", "version").mapInArrow(
        _edge, f"part int, key {_type(rows, 'key')}, version {_type(rows, 'version')}"
    )
    start: dict[int, tuple] = {}
    carried: tuple = (None, None)
    for edge in sorted(edges.collect(), key=lambda r: r.part):
        start[edge.part] = carried
        if edge.version is not None:
            carried = (edge.key, edge.version.asDict(recursive=True))
        elif edge.key != carried[0]:
            carried = (edge.key, None)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if state is None:
                state = start.get(batch.column("part")[0].as_py(), (None, None))
            found, state = _filled(batch, state)
            wanted = pc.equal(batch.column("kind"), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lookup").filter(wanted), found.filter(wanted)], names=["lookup", "version"]
            )

    swept = rows.drop("time", "tie").mapInArrow(sweep, f"lookup {_type(rows, 'lookup')}, version {_type(rows, 'version')}")
    return swept.select("lookup.*", "version")


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _filled(batch: pa.RecordBatch, state: tuple) -> tuple[pa.Array, tuple]:
    """The version that each row sees, and the last key with its version."""
    keys, versions, n = batch.column("key"), batch.column("version"), batch.num_rows
    fresh = np.ones(n, bool)
    fresh[1:] = pc.fill_null(pc.not_equal(keys[1:], keys[:-1]), True).to_numpy(zero_copy_only=False)
    at = np.arange(n)
    run = np.maximum.accumulate(np.where(fresh, at, 0))
    given = np.asarray(batch.column("kind")) == 0
    last = np.maximum.accumulate(np.where(given, at, -1))
    key, carried = state
    goes_on = key is not None and keys[0].as_py() == key
    pool = pa.concat_arrays([pa.array([carried], versions.type), versions])
    # place 0 of the pool is what was carried here; it serves the first run only
    place = np.where(last >= run, last + 1, 0)
    none = (last < run) & ((run > 0) | (not goes_on))
    found = pool.take(pa.array(place, mask=none))
    return found, (keys[n - 1].as_py(), found[n - 1].as_py())


def _edge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last key of a partition and the newest version of it that the partition holds."""
    state, final = (None, None), None
    for batch in batches:
        if batch.num_rows:
            _, state = _filled(batch, state)
            final = batch
    if final is not None:
        yield pa.RecordBatch.from_arrays(
            [
                final.column("part")[-1:],
                pa.array([state[0]], final.column("key").type),
                pa.array([state[1]], final.column("version").type),
            ],
            names=["part", "key", "version"],
        )


def in_periods(
    moments: DataFrame,
    periods: DataFrame,
    time: str,
    start: str,
    end: str,
    grain: float = 60.0,
    totals: tuple[str, str] | None = None,
) -> DataFrame:
    """Every (moment, period) with start <= time < end, columns of both.

    Periods are cut into bins of 1, 2, 4, ... grains (seconds): the fewest that cover one,
    at most two of a size.  A moment lies in one bin of each size that occurs, so moments
    and periods meet by an equi-join on (level, bin), each pair once; the outermost bins
    are wider than the period, so its ends are compared as well.  Nulls meet nothing, and
    periods that end before they start hold nothing.

    With ``totals``, a key of the moments and a number of the periods, the result is per
    key what the pairs amount to: the key, ``n``, ``least`` and ``total`` of the number.
    The pairs, which grow with the product of both sides, are not made (see ``_period_totals``).
    """
    if totals is not None:
        return _period_totals(moments, periods, time, start, end, *totals)
    unit = int(grain * 1_000_000)
    tick = lambda c: F.floor(F.unix_micros(F.col(c)) / unit).cast("long")
    real = periods.filter(F.col(start) < F.col(end))
    last = F.floor((F.unix_micros(F.col(end)) - 1) / unit).cast("long") + 1
    binned = real.withColumn("_bin", F.explode(_cover(tick(start), last)))
    binned = binned.select("*", "_bin.level", "_bin.number").drop("_bin")
    # As many rows as there are sizes.
    levels = binned.groupBy().agg(F.collect_set("level").alias("_levels"))
    spread = moments.filter(F.col(time).isNotNull()).join(F.broadcast(levels))
    spread = spread.withColumn("level", F.explode("_levels")).drop("_levels")
    spread = spread.withColumn("number", F.shiftright(tick(time), 0)).withColumn("number", F.expr("shiftright(number, level)"))
    # The size of a table is guessed from before its rows are spread, so no side may be sent whole.
    joined = spread.join(binned.hint("merge"), ["level", "number"])
    return joined.filter((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("level", "number")


def _period_totals(moments: DataFrame, periods: DataFrame, time: str, start: str, end: str, key: str, number: str) -> DataFrame:
    """n, least and total of the periods that hold the moments of a key.

    Bins are of 1, 4, 16, ... microseconds, so a period is exactly its bins, at most three
    at either end of a size, and no end is left to compare.  Periods are summed up by bin
    first; a moment then meets one row for each size, however many periods there are.
    """
    # floor and ceiling of x / 4 ** level
    down = lambda x: F.expr(f"shiftright({x}, 2 * _level)")
    up = lambda x: -F.expr(f"shiftright(-{x}, 2 * _level)")
    real = periods.filter(F.col(start) < F.col(end))
    real = real.select(F.unix_micros(F.col(start)).alias("_low"), F.unix_micros(F.col(end)).alias("_high"), F.col(number).alias("_number"))
    # no bin is larger than the period
    size = F.floor(F.log2((F.col("_high") - F.col("_low")).cast("double")) / 2).cast("int") + 1
    levels = real.withColumn("_level", F.explode(F.sequence(F.lit(0), size)))
    ends = levels.select("_level", "_number", up("_low").alias("_first"), down("_high").alias("_last")).filter("_first < _last")
    # what the next size leaves: up to its first bin, and from the end of its last one
    first, last = F.col("_first"), F.col("_last")
    left, right = -4 * F.shiftright(-first, 2), 4 * F.shiftright(last, 2)
    bins = F.array_compact(
        F.array(
            *[F.when(first + n < F.least(left, last), first + n) for n in range(3)],
            *[F.when((left <= right) & (right + n < last), right + n) for n in range(3)],
        )
    )
    sums = lambda n: [F.sum(n).alias("n"), F.min("least").alias("least"), F.sum("total").alias("total")]
    binned = ends.select("_level", F.explode(bins).alias("_bin"), F.lit(1).cast("long").alias("n"), F.col("_number").alias("least"))
    binned = binned.withColumn("total", F.col("least")).groupBy("_level", "_bin").agg(*sums("n"))
    # As many rows as there are sizes.
    occurring = binned.groupBy().agg(F.collect_set("_level").alias("_levels"))
    known = moments.filter(F.col(time).isNotNull()).select(F.col(key).alias("_key"), F.unix_micros(F.col(time)).alias("_time"))
    spread = known.join(F.broadcast(occurring)).withColumn("_level", F.explode("_levels"))
    spread = spread.select("_key", "_level", down("_time").alias("_bin"))
    # The size of a table is guessed from before its rows are spread, so no side may be sent whole.
    met = spread.join(binned.hint("merge"), ["_level", "_bin"])
    return met.groupBy(F.col("_key").alias(key)).agg(*sums("n"))


def _cover(first: Column, last: Column) -> Column:
    """The fewest aligned bins that make up [first, last): at each size an odd left end and an odd right end."""
    bin_of = lambda level, number: F.struct(level.cast("int").alias("level"), number.alias("number"))
    empty = F.array().cast("array<struct<level:int,number:bigint>>")
    begin = F.struct(first.alias("low"), last.alias("high"), empty.alias("bins"))

    def step(state: Column, level: Column) -> Column:
        low, high = state["low"], state["high"]
        is_open = low < high
        left, right = is_open & (low % 2 != 0), is_open & (high % 2 != 0)
        own = F.concat(
            F.when(left, F.array(bin_of(level, low))).otherwise(empty),
            # one bin that is odd on both ends is taken once
            F.when(right & ~(left & (high - low == 1)), F.array(bin_of(level, high - 1))).otherwise(empty),
        )
        up = lambda x: F.shiftright(x, 1)
        return F.struct(
            up(F.when(left, low + 1).otherwise(low)).alias("low"),
            up(F.when(right, high - 1).otherwise(high)).alias("high"),
            F.concat(state["bins"], own).alias("bins"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), begin, step)["bins"]
