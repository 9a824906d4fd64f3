"""Catalogue queries: filters, facets, rollups, ratings, collections, links, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyword_filter(
    records: DataFrame,
    lists: dict[str, list[str]] | None = None,
    strength: str | None = None,
    temperature: str | None = None,
) -> DataFrame:
    """Records that share a keyword with every given list and equal every given scalar."""
    found = records
    for field, wanted in (lists or {}).items():
        if wanted:
            found = found.filter(F.arrays_overlap(F.col(f"keywords.{field}"), F.array(*[F.lit(w) for w in wanted])))
    if strength:
        found = found.filter(F.col("keywords.keywordsStrength") == strength)
    if temperature:
        found = found.filter(F.col("keywords.keywordsTemperature") == temperature)
    return found


def filter_facets(items: DataFrame, usage: DataFrame) -> DataFrame:
    """Facet rows: group, id, name, parent, used.

    Facets stay rows, one per item, because a group has no size bound.  An item is used
    when its flag is null; ``usage`` has item_id for items that occur in a record.
    """
    used = usage.groupBy("item_id").agg(F.lit(None).cast("boolean").alias("flag")).withColumn("seen", F.lit(True))
    distinct_items = items.groupBy("facet", "item_id").agg(F.min(F.struct("name", "parent")).alias("shown"))
    joined = distinct_items.select("facet", "item_id", "shown.*").join(used, "item_id", "left")
    flag = F.when(F.col("seen").isNull(), F.lit(False)).otherwise(F.col("flag"))
    return joined.select("facet", "item_id", "name", "parent", F.coalesce(flag, F.lit(True)).alias("used"))


def taxonomy_rollup(counts: DataFrame, path: str = "path", measure: str = "n") -> DataFrame:
    """Totals at every level of a broad-to-specific path."""
    levels = counts.select(measure, F.col(path), F.posexplode(path).alias("level", "name"))
    node = F.array_join(F.slice(F.col(path), F.lit(1), F.col("level") + 1), "/")
    return levels.groupBy(F.col("level"), node.alias("node")).agg(F.sum(measure).alias(measure))


def rating_aggregate(ratings: DataFrame, key: str, stars: str = "stars") -> DataFrame:
    names = "one_stars two_stars three_stars four_stars five_stars".split()
    counts = [F.count_if(F.col(stars) == n + 1).alias(name) for n, name in enumerate(names)]
    return ratings.groupBy(key).agg(
        *counts,
        F.sum(stars).alias("total_stars"),
        F.count(stars).alias("rating_count"),
    ).withColumn("rating", F.col("total_stars") / F.col("rating_count"))


def reaction_totals(reactions: DataFrame, key: str, kind: str, amount: str) -> DataFrame:
    """Totals per reaction type as a map; the lists collected hold one row per type."""
    totals = reactions.groupBy(key, kind).agg(F.sum(amount).alias("total"))
    return totals.groupBy(key).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(kind, "total")))).alias("reactions")
    )


def ordered_steps(steps: Column) -> Column:
    """Instruction steps by their order number."""
    ordered = F.array_sort(F.transform(steps, lambda s: F.struct(s["order"].alias("order"), s["display"].alias("display"))))
    return F.transform(ordered, lambda s: s["display"])


def visible_collections(collections: DataFrame, season: str | None = None, holiday: str | None = None) -> DataFrame:
    """Collections shown always, or in the caller's season or holiday, in display order."""
    shown = F.col("visibility") == "always"
    if season:
        shown |= (F.col("visibility") == "season") & (F.col("season") == season)
    if holiday:
        shown |= (F.col("visibility") == "holiday") & (F.col("holiday") == holiday)
    return collections.filter(shown).orderBy("order", "id")


def related_collections(collections: DataFrame) -> DataFrame:
    """Rows of collection and existing related collection, in list order."""
    wanted = collections.select("id", F.posexplode("related_ids").alias("pos", "related_id"))
    known = collections.select(F.col("id").alias("related_id"), F.col("title").alias("related_title"))
    return wanted.join(known, "related_id")


def republish_set(records: DataFrame, ids: DataFrame, key: str, empty_means_all: bool = False) -> DataFrame:
    """Records to announce again: those asked for, or all where an empty list means all."""
    asked = ids.select(F.col(key).alias("asked"))
    if not empty_means_all:
        return records.join(asked, records[key] == F.col("asked"), "left_semi")
    # one row says whether the list is empty; the join brings it to every record
    some = asked.agg((F.count(F.lit(1)) > 0).alias("some"))
    named = records.join(asked.distinct().withColumn("named", F.lit(True)), records[key] == F.col("asked"), "left")
    return named.join(some).where(~F.col("some") | F.col("named")).select(*records.columns)


def upsert_link(links: Column, kind: Column, url: Column) -> Column:
    """Links with the given type's url replaced, or added at the end."""
    new = F.struct(kind.alias("type"), url.alias("url"))
    others = F.filter(links, lambda k: k["type"] != kind)
    has = F.exists(links, lambda k: k["type"] == kind)
    replaced = F.transform(links, lambda k: F.when(k["type"] == kind, new).otherwise(k))
    return F.when(has, replaced).otherwise(F.array_append(others, new))


def upsert_links(records: DataFrame, updates: DataFrame, key: str, links: str = "socialLinks") -> DataFrame:
    """Bulk form: one newest url per (record, type), then each applied to its record's row."""
    newest = updates.groupBy(key, "type").agg(F.max_by("url", "version").alias("url"))
    per_record = newest.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("type", "url"))).alias("new_links"))
    joined = records.join(per_record, key, "left")
    merged = F.aggregate(
        F.coalesce("new_links", F.array().cast("array<struct<type:string,url:string>>")),
        F.col(links),
        lambda acc, new: upsert_link(acc, new["type"], new["url"]),
    )
    return joined.withColumn(links, merged).drop("new_links")


def report_projection(records: DataFrame, key: str) -> DataFrame:
    """Flat report rows: record fields with one row per item, records without items kept."""
    return records.select(
        key,
        "title",
        "serves",
        "isIba",
        F.size("images").alias("n_images"),
        F.array_join("glassware", ",").alias("glassware"),
        F.posexplode_outer("ingredients").alias("item_pos", "item"),
    ).select(
        key, "title", "serves", "isIba", "n_images", "glassware", "item_pos",
        F.col("item.name").alias("item_name"), F.col("item.display").alias("item_display"),
        F.col("item.units").alias("item_units"),
    )
