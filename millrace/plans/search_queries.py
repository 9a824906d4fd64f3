"""Queries over request shaping, vector search, matching and the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions.plan import once
from millrace.operators import catalogue, matching, search, shape, vectors
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query
from millrace.session import run_dir

# --- shaping -------------------------------------------------------------------

@query(
    O.sql(f"""SELECT r.doc_id, title, CAST(serves AS INT) AS serves, CAST(prepTimeMinutes AS INT) AS prep, isIba AS is_iba, rating,
                array_to_string(glassware, ',') AS glassware, len(image_types) AS n_images, items
              FROM f_records r JOIN (SELECT doc_id, string_agg(item_id, ',' ORDER BY item_pos) AS items FROM f_record_items GROUP BY doc_id) i USING (doc_id)""")
)
def shape_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = feeds.records(spark, sf_dir).select("doc_id", shape.document().alias("d"))
    return shaped.select(
        "doc_id",
        "d.title",
        "d.serves",
        F.col("d.prepTimeMinutes").alias("prep"),
        F.col("d.isIba").alias("is_iba"),
        "d.rating",
        F.array_join("d.glassware", ",").alias("glassware"),
        F.size("d.images").cast("long").alias("n_images"),
        F.array_join(F.transform("d.ingredients", lambda i: i["id"]), ",").alias("items"),
    )


@query(
    O.sql("""SELECT doc_id, item_pos, item_id, name, units, display, preparation,
               CASE WHEN uoM = 'gallons' THEN '?' ELSE uoM END AS unit, kind, application || ',base' AS applications, requirement
             FROM f_record_items""")
)
def reshape_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = feeds.records(spark, sf_dir).select(
        "doc_id", F.posexplode(shape.reshape_items(F.col("ingredients"))).alias("item_pos", "i")
    )
    return shaped.select(
        "doc_id",
        F.col("item_pos").cast("long").alias("item_pos"),
        F.col("i.id").alias("item_id"),
        "i.name",
        "i.units",
        "i.display",
        "i.preparation",
        F.coalesce("i.uoM", F.lit("?")).alias("unit"),
        F.array_join("i.types", ",").alias("kind"),
        F.array_join("i.applications", ",").alias("applications"),
        "i.requirement",
    )


@query(
    O.sql("""SELECT doc_id, CASE WHEN doc_id % 23 = 5 THEN 'uoM=gallons' ELSE 'ok' END AS outcome FROM f_records""")
)
def enum_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.array_join(shape.untranslatable(), ";")
    return feeds.records(spark, sf_dir).select(
        "doc_id", F.coalesce(F.nullif(failed, F.lit("")), F.lit("ok")).alias("outcome")
    )


@query(
    O.sql("""SELECT doc_id, CAST(i AS BIGINT) AS pos, image_types[i + 1] AS type, 'https://img.example/' || id || '-' || image_types[i + 1] || '.webp' AS uri,
               CASE image_types[i + 1] WHEN 'tile' THEN 300 ELSE 600 END AS width, CASE image_types[i + 1] WHEN 'tile' THEN 300 ELSE 400 END AS height
             FROM (SELECT *, unnest(range(len(image_types))) AS i FROM f_records)""")
)
def reshape_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.records(spark, sf_dir).select(
        "doc_id", F.posexplode(shape.reshape_images(F.col("images"))).alias("pos", "i")
    ).select("doc_id", F.col("pos").cast("long").alias("pos"), "i.type", "i.uri", "i.width", "i.height")


def _keyword_sql() -> str:
    lists = ", ".join(f"coalesce(array_to_string({k}, ','), '') AS {k}" for k in S.KEYWORD_LISTS)
    scalars = ", ".join(f"coalesce(nullif({k}, ''), '-') AS {k}" for k in S.KEYWORD_SCALARS)
    return O.sql(f"SELECT doc_id, {lists}, {scalars} FROM f_records")


@query(_keyword_sql())
def keyword_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = feeds.records(spark, sf_dir).select("doc_id", shape.keyword_defaults().alias("k"))
    return filled.select(
        "doc_id",
        *[F.array_join(f"k.{k}", ",").alias(k) for k in S.KEYWORD_LISTS],
        *[F.coalesce(f"k.{k}", F.lit("-")).alias(k) for k in S.KEYWORD_SCALARS],
    )


@query(
    O.sql(f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_pos) - 1 AS pos, category, content
              FROM f_answer_rows WHERE NOT {O.blank("content")}""")
)
def request_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators import infer

    usable = infer.resolve(feeds.answered(spark, sf_dir)).filter("status = 'ok'")
    rows = usable.select("doc_id", F.posexplode(shape.request_chunks(F.col("chunks"))).alias("pos", "c"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "c.category", "c.content")


@query(
    O.sql("""SELECT r.doc_id, CASE WHEN r.doc_id % 23 = 5 THEN 'bad_enum' ELSE 'ok' END AS outcome,
               CASE WHEN r.doc_id % 23 = 5 THEN '-' ELSE r.title END AS title, CASE WHEN r.doc_id % 23 = 5 THEN -1 ELSE c.n END AS n_chunks,
               CASE WHEN r.doc_id % 23 = 5 THEN '-' ELSE coalesce(array_to_string(keywordsMood, ','), '') END AS mood
             FROM f_records r JOIN (SELECT doc_id, count(*) AS n FROM f_chunk_rows GROUP BY doc_id) c USING (doc_id)""")
)
def embedding_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole request bodies, read back from their JSON."""
    from millrace.operators import chunk
    from millrace.sources.sinks import serialize

    chunked = chunk.with_chunks(feeds.records(spark, sf_dir), "content")
    bodies = once(shape.embedding_requests(chunked), body=serialize(F.col("request")))
    read = F.from_json(
        "body",
        "struct<content_chunks:array<struct<content:string,category:string>>,document:struct<title:string>,"
        "keywords:struct<keywordsMood:array<string>>>",
    )
    parsed = once(bodies.select("doc_id", "reject_reason", "body"), request=read)
    return parsed.select(
        "doc_id",
        F.coalesce("reject_reason", F.lit("ok")).alias("outcome"),
        F.coalesce("request.document.title", F.lit("-")).alias("title"),
        F.coalesce(F.size("request.content_chunks"), F.lit(-1)).cast("long").alias("n_chunks"),
        F.coalesce(F.array_join("request.keywords.keywordsMood", ","), F.lit("-")).alias("mood"),
    )


# Answers of the index, by event_id modulo 6.
STATUSES = (204, 401, 403, 422, 500, 503)


@query(
    """SELECT CASE event_id % 6 WHEN 0 THEN 'delivered' WHEN 1 THEN 'runtime_error: unauthorized' WHEN 2 THEN 'runtime_error: forbidden'
         WHEN 3 THEN 'value_error: unprocessable' WHEN 4 THEN 'runtime_error: server' ELSE 'unexpected_status' END AS outcome,
         count(*) AS n FROM events GROUP BY ALL"""
)
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*[F.lit(s) for s in STATUSES])
    status = F.get(codes, (F.col("event_id") % len(STATUSES)).cast("int"))
    log = feeds.events(spark, sf_dir).select(shape.delivery_outcome(status).alias("outcome"))
    return log.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# --- vector search -------------------------------------------------------------

MIN_SCORE = 0.2
_HITS = f"SELECT * FROM f_scores WHERE score >= {MIN_SCORE}"
_STATS = f"""
    SELECT request_id, record_id, micro / 1000000 AS total_score, max_score, micro / hit_count / 1000000 AS avg_score,
           micro / hit_count / 1000000 * (1 + CAST({search.HIT_BOOST} AS DOUBLE) * hit_count) AS weighted_score, hit_count
    FROM (SELECT request_id, record_id, CAST(CAST(sum(CAST(round(score * 1000000) AS BIGINT)) AS BIGINT) AS DOUBLE) AS micro,
                 max(score) AS max_score, count(*) AS hit_count FROM f_hits GROUP BY ALL)"""


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.hits(feeds.chunk_vectors(spark, sf_dir), feeds.search_requests(spark, sf_dir), MIN_SCORE)


@query(O.sql("SELECT request_id, record_id, chunk_id, score FROM f_hits", f_hits=_HITS))
def vector_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir)


@query(
    O.sql(
        "SELECT request_id, record_id, total_score, max_score, avg_score, hit_count FROM f_stats", f_hits=_HITS, f_stats=_STATS
    )
)
def search_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_statistics(_hits(spark, sf_dir)).drop("weighted_score")


@query(
    O.sql(
        """SELECT request_id, record_id, CAST(hand + n_lists * ((rn - 1) // 4) AS BIGINT) AS list_no,
             string_agg(printf('%.6f', score), ',' ORDER BY score DESC) AS scores
           FROM (SELECT *, row_number() OVER (PARTITION BY request_id, record_id, hand ORDER BY score DESC, chunk_id) AS rn
                 FROM (SELECT h.request_id, h.record_id, chunk_id, score, CAST(ceil(hit_count / 4) AS BIGINT) AS n_lists,
                              chunk_id % CAST(ceil(hit_count / 4) AS BIGINT) AS hand
                       FROM f_hits h JOIN f_stats USING (request_id, record_id)))
           GROUP BY ALL""",
        f_hits=_HITS,
        f_stats=_STATS,
    )
)
def search_hit_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits are scored once and kept as a table, from which statistics and lists are made."""
    path = run_dir(spark, "hits")
    _hits(spark, sf_dir).write.parquet(path)
    hits = spark.read.parquet(path)
    lists = search.hit_lists(hits, search.search_statistics(hits), per_list=4, spread_by=F.col("chunk_id"))
    shown = F.transform("scores", lambda s: F.format_string("%.6f", s))
    return lists.select(
        "request_id", "record_id", F.col("list_no").cast("long").alias("list_no"), F.array_join(shown, ",").alias("scores")
    )


@query(
    O.sql("SELECT request_id, record_id, weighted_score FROM f_stats", f_hits=_HITS, f_stats=_STATS)
)
def weighted_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_statistics(_hits(spark, sf_dir)).select("request_id", "record_id", "weighted_score")


@query(
    O.sql(
        """SELECT request_id, record_id, weighted_score FROM f_stats
           ORDER BY weighted_score DESC, request_id, record_id LIMIT 10 OFFSET 5""",
        f_hits=_HITS,
        f_stats=_STATS,
    )
)
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = search.search_page(search.search_statistics(_hits(spark, sf_dir)), skip=5, take=10)
    return page.select("request_id", "record_id", "weighted_score")


@query(
    O.sql(
        """SELECT request_id, record_id, weighted_score, position FROM (
             SELECT *, row_number() OVER (ORDER BY weighted_score DESC, request_id, record_id) - 1 AS position FROM f_stats)
           WHERE position >= 25 AND position < 35""",
        f_hits=_HITS,
        f_stats=_STATS,
    )
)
def search_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the last row of a first page of 25."""
    path = run_dir(spark, "ranking")
    search.write_ranking(search.search_statistics(_hits(spark, sf_dir)), path)
    ranking = spark.read.parquet(path).select("request_id", "record_id", "weighted_score", "position")
    first = search.page_at(ranking, 0, 25).collect()
    if not first:
        return ranking
    last = first[-1]
    return search.page_after(ranking, (last["weighted_score"], last["request_id"], last["record_id"]), 10)


@query(
    O.sql("""SELECT request_id, record_id, score, CAST(rank AS INT) AS rank FROM (
               SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, record_id) AS rank
               FROM (SELECT request_id, record_id, max(score) AS score FROM f_scores WHERE request_id <> record_id GROUP BY ALL))
             WHERE rank <= 3""")
)
def related_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    related = vectors.nearest_records(feeds.chunk_vectors(spark, sf_dir), feeds.search_requests(spark, sf_dir), k=3)
    return related.select("request_id", "record_id", "score", "rank")


# --- item overlap --------------------------------------------------------------

_COUNTS = """
    SELECT record_id, count(*) AS n_items, count(*) FILTER (WHERE have) AS n_matched, count(*) FILTER (WHERE NOT have) AS n_unmatched,
           count(*) FILTER (WHERE NOT have AND garnish) AS n_missing_garnish
    FROM (SELECT record_id, item_id, bool_or(application = 'garnishment') AS garnish,
                 item_id IN (SELECT p_partkey FROM part WHERE p_size <= 30) AS have
          FROM f_order_items GROUP BY record_id, item_id)
    GROUP BY record_id"""
_BUCKET = (
    "CASE {m} WHEN 0 THEN 'exact' WHEN 1 THEN 'missing_1' WHEN 2 THEN 'missing_2' ELSE 'missing_3_plus' END AS coverage"
)


def _overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplied = feeds.table(spark, sf_dir, "part").filter("p_size <= 30").select(F.col("p_partkey").alias("item_id"))
    return matching.overlap_counts(feeds.order_items(spark, sf_dir), supplied)


@query(O.sql("SELECT record_id, n_items, n_matched FROM f_counts WHERE n_matched >= 3 OR n_unmatched = 0", f_counts=_COUNTS))
def overlap_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.overlap_match(_overlap(spark, sf_dir), minimum=3).select("record_id", "n_items", "n_matched")


@query(O.sql("SELECT record_id, n_unmatched FROM f_counts", f_counts=_COUNTS))
def overlap_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlap(spark, sf_dir).select("record_id", "n_unmatched")


@query(O.sql("SELECT record_id, n_missing_garnish FROM f_counts", f_counts=_COUNTS))
def overlap_garnish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlap(spark, sf_dir).select("record_id", "n_missing_garnish")


@query(
    O.sql(
        f"""SELECT record_id, coverage FROM (SELECT *, {_BUCKET.format(m="n_unmatched")} FROM f_counts
            WHERE n_matched >= 1 OR n_unmatched = 0) WHERE coverage IN ('exact', 'missing_1')""",
        f_counts=_COUNTS,
    )
)
def overlap_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.overlap_match(_overlap(spark, sf_dir), coverage=["exact", "missing_1"])
    return found.select("record_id", "coverage")


@query(
    O.sql(
        f"""SELECT record_id, coverage, n_unmatched, n_missing_garnish FROM (
              SELECT *, {_BUCKET.format(m="(n_unmatched - n_missing_garnish)")} FROM f_counts
              WHERE n_matched >= 2 OR n_unmatched - n_missing_garnish = 0) WHERE coverage IN ('exact', 'missing_2')""",
        f_counts=_COUNTS,
    )
)
def overlap_ignore_garnish(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matching.overlap_match(
        _overlap(spark, sf_dir), minimum=2, coverage=["exact", "missing_2"], ignore_missing_garnish=True
    )
    return found.select("record_id", "coverage", "n_unmatched", "n_missing_garnish")


# --- catalogue -----------------------------------------------------------------


@query(
    O.sql("""SELECT doc_id FROM f_records WHERE list_has_any(keywordsFlavorProfile, ['en', 'kw-3'])
             AND list_has_any(keywordsMood, ['en', 'fr', 'kw-1']) AND keywordsStrength = 'strong'""")
)
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"keywordsFlavorProfile": ["en", "kw-3"], "keywordsMood": ["en", "fr", "kw-1"]}
    return catalogue.keyword_filter(feeds.records(spark, sf_dir), wanted, strength="strong").select("doc_id")


@query(
    """SELECT p_type AS facet, p_partkey AS item_id, p_name AS name, p_brand AS parent,
         p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) >= 30) AS used FROM part"""
)
def filter_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items as filter choices; those in at least 30 lines count as used."""
    parts = feeds.table(spark, sf_dir, "part").select(
        F.col("p_type").alias("facet"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("parent"),
    )
    lines = feeds.order_items(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_lines"))
    usage = lines.filter("n_lines >= 30").select("item_id")
    return catalogue.filter_facets(parts, usage)


@query(
    """SELECT CAST(level AS INT) AS level, node, count(*) AS n FROM (
         SELECT unnest([0, 1, 2]) AS level, unnest([p_type, p_type || '/' || p_brand, p_type || '/' || p_brand || '/' || p_name]) AS node
         FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY ALL"""
)
def taxonomy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record items per taxonomy node; items are counted per part before the join."""
    counted = feeds.order_items(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    paths = feeds.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.array("p_type", "p_brand", "p_name").alias("path")
    )
    return catalogue.taxonomy_rollup(counted.join(paths, "item_id"))


@query(
    """SELECT user_id AS record_id, count(*) FILTER (WHERE s = 1) AS one_stars, count(*) FILTER (WHERE s = 2) AS two_stars,
         count(*) FILTER (WHERE s = 3) AS three_stars, count(*) FILTER (WHERE s = 4) AS four_stars, count(*) FILTER (WHERE s = 5) AS five_stars,
         CAST(sum(s) AS BIGINT) AS total_stars, count(*) AS rating_count, CAST(sum(s) AS BIGINT) / count(*) AS rating
       FROM (SELECT user_id, least(5, 1 + CAST(floor(value / 50) AS INT)) AS s FROM events) GROUP BY user_id"""
)
def rating_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = feeds.events(spark, sf_dir).select(F.col("user_id").alias("record_id"), feeds.star(F.col("value")).alias("stars"))
    return catalogue.rating_aggregate(given, "record_id")


@query(
    """SELECT id, string_agg(event_type || '=' || total, ';' ORDER BY event_type) AS reactions FROM (
         SELECT user_id AS id, event_type, CAST(sum(CAST(props ->> '$.k' AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY ALL) GROUP BY id"""
)
def reaction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = feeds.events(spark, sf_dir).select(
        F.col("user_id").alias("id"), "event_type", F.get_json_object("props", "$.k").cast("long").alias("k")
    )
    totals = catalogue.reaction_totals(given, "id", "event_type", "k")
    shown = F.transform(F.map_entries("reactions"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return totals.select("id", F.array_join(shown, ";").alias("reactions"))


@query(
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Step 1' WHEN 1 THEN 'Step 1,Step 3' ELSE 'Step 0,Step 1,Step 3' END AS steps FROM documents"""
)
def ordered_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = catalogue.ordered_steps(F.col("instructions"))
    return feeds.records(spark, sf_dir).select("doc_id", F.array_join(steps, ",").alias("steps"))


_COLLECTIONS = """
    SELECT 'brand-' || n AS id, 'Brand ' || n || ' (' || n_items || ')' AS title, n AS "order",
      ['always', 'season', 'holiday'][n % 3 + 1] AS visibility, ['spring', 'summer', 'autumn', 'winter'][n % 4 + 1] AS season,
      ['halloween', 'christmas', 'easter'][n % 5 % 3 + 1] AS holiday, n
    FROM (SELECT CAST(substr(p_brand, 7) AS INT) AS n, count(*) AS n_items FROM part GROUP BY ALL)"""


def _collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections of items by brand, with made-up display rules."""
    brands = (
        feeds.table(spark, sf_dir, "part")
        .groupBy(F.substring("p_brand", 7, 9).cast("int").alias("n"))
        .agg(F.count(F.lit(1)).alias("n_items"))
    )
    n = F.col("n")
    pick = lambda names, i: F.get(F.array(*[F.lit(v) for v in names]), i)
    tag = lambda i: F.concat(F.lit("brand-"), i.cast("string"))
    return brands.select(
        tag(n).alias("id"),
        F.concat(F.lit("Brand "), n.cast("string"), F.lit(" ("), F.col("n_items").cast("string"), F.lit(")")).alias("title"),
        n.alias("order"),
        pick(["always", "season", "holiday"], n % 3).alias("visibility"),
        pick(["spring", "summer", "autumn", "winter"], n % 4).alias("season"),
        pick(["halloween", "christmas", "easter"], n % 5 % 3).alias("holiday"),
        F.array(tag(n + 1), tag(n + 7)).alias("related_ids"),
    )


@query(
    O.sql(
        """SELECT id, title, "order" FROM f_collections WHERE visibility = 'always' OR (visibility = 'season' AND season = 'summer')
           OR (visibility = 'holiday' AND holiday = 'halloween') ORDER BY "order", id""",
        f_collections=_COLLECTIONS,
    )
)
def visible_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = catalogue.visible_collections(_collections(spark, sf_dir), season="summer", holiday="halloween")
    return shown.select("id", "title", "order")


@query(
    O.sql(
        """SELECT a.id, CAST(p.pos AS INT) AS pos, b.id AS related_id, b.title AS related_title
           FROM f_collections a CROSS JOIN (VALUES (0, 1), (1, 7)) p(pos, step) JOIN f_collections b ON b.n = a.n + p.step""",
        f_collections=_COLLECTIONS,
    )
)
def related_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.related_collections(_collections(spark, sf_dir)).select("id", "pos", "related_id", "related_title")


@query(
    """SELECT 'record' AS kind, doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
       UNION ALL SELECT 'item', p_partkey FROM part"""
)
def republish_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records asked for by id, and all items, as an empty item list means all."""
    asked = feeds.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    records = catalogue.republish_set(feeds.table(spark, sf_dir, "documents").select("doc_id"), asked, "doc_id")
    parts = feeds.table(spark, sf_dir, "part").select("p_partkey")
    items = catalogue.republish_set(parts, parts.filter(F.lit(False)), "p_partkey", empty_means_all=True)
    return records.select(F.lit("record").alias("kind"), F.col("doc_id").alias("id")).unionByName(
        items.select(F.lit("item").alias("kind"), F.col("p_partkey").alias("id"))
    )


@query(
    """SELECT doc_id, array_to_string(list_filter(['pinterest>' || CASE WHEN quality = 0 THEN 'new' ELSE 'https://p.example/' || doc_id END,
         CASE WHEN quality = 1 THEN 'facebook>new' WHEN doc_id % 2 = 1 THEN 'facebook>https://f.example/' || doc_id END,
         CASE WHEN quality = 1 THEN 'x>new' END], lambda v: v IS NOT NULL), ';') AS links
       FROM documents LEFT JOIN labels USING (doc_id)"""
)
def link_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = feeds.table(spark, sf_dir, "labels")
    kinds = F.when(F.col("quality") == 1, F.array(F.lit("facebook"), F.lit("x"))).otherwise(F.array(F.lit("pinterest")))
    updates = labels.select("doc_id", F.explode(kinds).alias("type")).select(
        "doc_id", "type", F.explode(F.array(F.lit(1), F.lit(2))).alias("version")
    )
    updates = updates.withColumn("url", F.when(F.col("version") == 2, "new").otherwise("old"))
    records = feeds.records(spark, sf_dir).select("doc_id", "socialLinks")
    linked = catalogue.upsert_links(records, updates, "doc_id")
    shown = F.transform("socialLinks", lambda k: F.concat_ws(">", k["type"], k["url"]))
    return linked.select("doc_id", F.array_join(shown, ";").alias("links"))


@query(
    O.sql("""SELECT doc_id, title, CAST(serves AS INT) AS serves, isIba AS is_iba, CAST(len(image_types) AS INT) AS n_images,
               array_to_string(glassware, ',') AS glassware, CAST(item_pos AS INT) AS item_pos, name AS item_name, display AS item_display, units AS item_units
             FROM f_records JOIN f_record_items USING (doc_id)""")
)
def report_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.report_projection(feeds.records(spark, sf_dir), "doc_id").withColumnRenamed("isIba", "is_iba")
