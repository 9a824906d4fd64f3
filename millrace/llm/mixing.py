"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a share of the words by its weight; a share stops at ``most`` times the
source's size and what is left over is shared again by weight.  A target is made of
complete epochs (the whole source) and a fraction.  For the fraction each document draws an
exponential key divided by its quality weight; documents of a source are sorted by key and
taken while the words fit, the last one up to the missing words.  Keys come from a hash of
the row and a seed, so reruns agree.  The weight is the score of a quality model, or a
column; without either all documents weigh the same.

Null text has no words; documents without words are never taken.  Null is a source of its
own and comes last.  Quality weights that are null, not positive or not finite count as the smallest weight.
Repeated rows are separate rows.  An empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import bounded, durable, running_before, word_count
from millrace.llm.quality import AdditiveModel, score

WEIGHTS = (1, 2, 3)  # by source in code point order, repeating
MOST = 3
SEED = 20240101
LEAST_WEIGHT = 0.01


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target from rows (source, size): weighted shares with a ceiling.

    The level (words for one unit of weight) rises until no source passes its ceiling: in
    each round sources below it keep weight * level and the others stop.  Each round is one
    aggregate over a row per source and fixes at least one more source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = running_before(totals.withColumn("all", F.lit(0)), "all", ["source"], "one", "rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = durable(
        ranked.select("source", "source_size", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight"))
    )
    ceiling = F.col("source_size") * float(most)
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        full = ceiling <= F.col("weight") * level
        row = table.agg(
            F.count_if(full), F.sum(F.when(full, ceiling).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if row[0] == stopped or not row[2]:
            break
        stopped = row[0]
        level = (whole - row[1]) / row[2]
    return table.select("source", "source_size", F.least(ceiling, F.col("weight") * F.lit(level)).alias("target"))


def mix_sources(
    docs: DataFrame,
    quality: Column | AdditiveModel | None = None,
    keep: tuple[str, ...] = ("doc_id",),
    seed: int = SEED,
) -> DataFrame:
    """Columns ``keep``, row_key, size, source_size, target, taken (words, repeats counted)."""
    bounded(docs.sparkSession)
    facts = [*keep, F.col("source").alias("__source"), word_count(F.col("text")).alias("size"), row_key().alias("row_key")]
    if isinstance(quality, AdditiveModel):
        # The text goes to the model and does not come back.
        rows = score(docs.select(*facts, F.col("text").alias("text")), quality, keep=(*keep, "__source", "size", "row_key"))
        rows = rows.withColumnRenamed("quality_score", "__quality")
    else:
        rows = docs.select(*facts, (F.lit(1.0) if quality is None else quality).alias("__quality"))
    weight = F.col("__quality")
    usable = weight.isNotNull() & ~F.isnan(weight) & (weight > 0) & (weight < float("inf"))
    weight = F.when(usable, F.greatest(weight, F.lit(LEAST_WEIGHT))).otherwise(F.lit(LEAST_WEIGHT))
    rows = rows.withColumn("__weight", weight).drop("__quality")
    unit = (F.shiftrightunsigned(F.xxhash64("row_key", F.lit(seed)), 11) + 1) / F.lit(float(2**53 + 1))
    rows = durable(rows.withColumn("__key", -F.ln(unit) / F.col("__weight")).drop("__weight"))
    targets = source_targets(rows.select(F.col("__source").alias("source"), "size"))
    targets = targets.withColumnRenamed("source", "__name")
    sized = rows.join(targets, F.col("__source").eqNullSafe(F.col("__name"))).drop("__name")
    summed = running_before(sized, "__source", ["__key", "row_key"], "size")
    epochs = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    fraction = F.floor(F.col("target") - epochs * F.col("source_size"))
    taken = epochs * F.col("size") + F.least(F.col("size"), F.greatest(F.lit(0), fraction - F.col("before")))
    return summed.select(*keep, "row_key", "size", "source_size", "target", taken.cast("long").alias("taken"))


def row_key() -> Column:
    """One number for a row's id and text."""
    return F.xxhash64("doc_id", "text")


def cut_words(text: Column, words: Column) -> Column:
    """The first ``words`` words of a text, separators kept."""
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(words.cast("int"), F.lit(0))), "")


def repeat_taken(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of the mix with the columns of ``docs``: one row for each time a document is taken.

    The last copy of a document at the edge of a budget holds its first words only, and its
    n_chars follows.  Rows of equal id and text share what the mix takes of them: each row
    gets the words of one of their rows in ``mixed``.
    """
    # Equal rows follow each other in the mix, so their words have at most three values:
    # with the fractional pass, at its edge, and behind it.
    values = mixed.groupBy("row_key", "taken").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    shares = F.sort_array(F.collect_list(F.struct("taken", "rows")), asc=False)
    take = values.groupBy("row_key").agg(F.max("size").alias("size"), shares.alias("shares"))
    # The columns of a document stay in one struct, so none of them meets a name used here.
    whole = docs.select(F.struct(*docs.columns).alias("doc"), row_key().alias("row_key"))
    whole = whole.withColumn("number", F.row_number().over(Window.partitionBy("row_key").orderBy("row_key")))
    found = F.aggregate(
        "shares",
        F.struct(F.col("number").cast("long").alias("left"), F.lit(0).cast("long").alias("taken")),
        lambda state, share: F.struct(
            (state["left"] - share["rows"]).alias("left"),
            F.when((state["left"] > 0) & (state["left"] <= share["rows"]), share["taken"]).otherwise(state["taken"]).alias("taken"),
        ),
    )["taken"]
    joined = whole.join(take, "row_key").withColumn("taken", found).where("taken > 0")
    copies = F.ceil(F.col("taken") / F.col("size")).cast("int")
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size"))
    cut = words < F.col("size")
    text = F.when(cut, cut_words(F.col("doc.text"), words)).otherwise(F.col("doc.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length(text).cast("long")).otherwise(F.col("doc.n_chars"))
    return each.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
