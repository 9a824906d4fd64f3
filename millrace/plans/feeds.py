"""Input feeds made from the given tables.

The given tables hold plain text and plain events, so markdown, HTML, emoji,
broken messages and faulty answers are added by fixed rules on the row's own id.
Every feed keeps all rows and whole texts of its table, adds no shuffle of its own
unless it says so, and has a twin in ``oracle_feeds``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas as S
from millrace.functions.plan import once
from millrace.operators import chunk
from millrace.session import LANES

# Text put before and after a document, by doc_id modulo 16.
DECORATIONS = {
    1: ("# Origin story\nFirst poured in **London** in the 1920s.\n", ""),
    2: ("```markdown\n## Method\nShake with *ice* and `strain`.\n", "\n```"),
    3: (
        "",
        "\n- 2 oz gin ![pic](http://x.example/a.png)\n1. [lime](http://x.example/lime) juice\n> Serve chilled \U0001f378",
    ),
    4: ("<p>Bright &amp; dry <b>finish</b></p>\n", "<script>var a = '</p>';</script><!-- note -->\n<style>p{}</style>"),
    5: (
        "",
        "\nFamily \U0001f468\u200d\U0001f469\u200d\U0001f467 flag \U0001f1eb\U0001f1f7 keycap 1\ufe0f\u20e3"
        " thumbs \U0001f44d\U0001f3fd done \u2764\ufe0f",
    ),
    6: ('"quoted" back\\slash tab\t bell \x07\x7f café 漢字 \U00020bb7\n', ""),
    7: (
        "## Variations\nSwap gin for vodka.\n## Pairing:\nPairs well with oysters.\n***\n",
        "\n| a | b |\n| --- | --- |\n| 1 | 2 |\nLast note",
    ),
    8: ("<!-- ", " -->"),
    9: ("\u00a0\n***Nested *marks* here*** and __under__ but snake_case ~~gone~~\n", "\n\u3000\n"),
    10: ("Shake it well. Shake it well.\n", "\nShake it well. Shake it well."),
}
BASE_INSTANT = "2024-01-01 00:00:00"


DEALT = ("documents", "conversations", "events", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the ones that feed costly maps in as many lanes as the session asks for."""
    read = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    lanes = spark.conf.get(LANES, None)
    return read.repartition(int(lanes)) if lanes and name in DEALT else read


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def minutes_after_base(minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(F.lit(BASE_INSTANT).cast("timestamp")) + minutes * 60_000_000)


def decorate(text: Column, doc_id: Column) -> Column:
    out = text
    for k, (before, after) in DECORATIONS.items():
        out = F.when(doc_id % 16 == k, F.concat(F.lit(before), text, F.lit(after))).otherwise(out)
    return out


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: id, raw content and version."""
    named = text_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        "lang",
        "source",
        "n_chars",
        "text",
        minutes_after_base(F.col("n_chars")).alias("version"),
    )
    return named.withColumn("content", decorate(F.col("text"), F.col("doc_id")))


def published_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record store: documents that carry a label (so some announced ids are missing)."""
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs(spark, sf_dir).join(labels, "doc_id", "left_semi")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.col("user_id").cast("string").alias("id"),
        "event_type",
        "value",
        "props",
    )


# One record as JSON text; the same SQL runs in both engines.
EVENT_ITEM_SQL = """
'{"id":"' || CASE WHEN event_id % 16 = 15 THEN '' ELSE CAST(user_id AS STRING) END
|| '","title":"' || event_type || '","descriptiveTitle":"' || event_type || ' event","description":"change","content":"Event '
|| CAST(event_id AS STRING) || ' of <b>' || event_type || '</b>","publishedOn":"2024-01-01T00:00:00Z","modifiedOn":"'
|| iso || '","serves":1,"prepTimeMinutes":' || CAST(event_id % 20 AS STRING)
|| ',"isIba":true,"images":[],"glassware":["' || CASE WHEN event_id % 7 = 0 THEN 'teapot' ELSE 'coupe' END
|| '"],"rating":{"oneStars":0,"twoStars":0,"threeStars":0,"fourStars":0,"fiveStars":1,"totalStars":5,"rating":5.0,"ratingCount":1},"reactions":'
|| props || ',"searchableTitles":[],"tags":[],"collections":[],"hashtags":[],"ingredients":[{"id":"gin","name":"Gin","uoM":"'
|| CASE WHEN event_id % 17 = 3 THEN 'gallons' ELSE 'ounces' END
|| '","requirement":"required","display":"2 oz gin","units":2.0,"preparation":"none","suggestions":"","types":[],"taxonomyFilterType":"spirits","applications":["base"]}],"instructions":[{"display":"Stir","order":1}],"keywords":{'
|| '"keywordsBaseSpirit":["gin"],"keywordsSpiritSubtype":[],"keywordsFlavorProfile":[],"keywordsCocktailFamily":[],"keywordsTechnique":[],'
|| '"keywordsSeason":[],"keywordsOccasion":[],"keywordsMood":[],"keywordsSearchTerms":[],"keywordsStrength":"light","keywordsTemperature":"cold"},"recipeCuisine":"none","socialLinks":[],"extra":1}'
"""
EVENT_VALUE_SQL = """
CASE WHEN event_id % 16 < 7 THEN '{"data":[' || item || ']}'
     WHEN event_id % 16 < 10 THEN '[' || item || ']'
     WHEN event_id % 16 = 10 THEN '{"data":[' || item || ',' || replace(item, '{"id":"' || CAST(user_id AS STRING) || '"', '{"id":"unknown"') || ']}'
     WHEN event_id % 16 = 11 THEN '{"data":[' || replace(item, '"title":', '"titel":') || ',"x",' || item || ']}'
     WHEN event_id % 16 = 12 THEN '{"data":[' || item
     WHEN event_id % 16 = 13 THEN NULL
     WHEN event_id % 32 = 14 THEN '{"data":[]}'
     WHEN event_id % 16 = 14 THEN item
     ELSE '[' || item || ']' END
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events as broker messages in all shapes, good and bad."""
    bad = F.unhex(F.lit("FF"))
    stamped = events(spark, sf_dir).withColumn("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    shaped = once(once(stamped, item=F.expr(EVENT_ITEM_SQL)), body=F.expr(EVENT_VALUE_SQL))
    tag = F.col("event_id").cast("string")
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.alias("value"))
    headers = F.array_compact(
        F.array(
            header("trace", F.encode(F.concat(F.lit("t-"), tag), "UTF-8")),
            header("broken", bad),
            header("empty", F.lit(None).cast("binary")),
            F.when(F.col("event_id") % 5 == 0, header("trace", F.encode(F.concat(F.lit("u-"), tag), "UTF-8"))),
            header("origin", F.encode(F.col("event_type"), "UTF-8")),
        )
    )
    body = F.encode(F.col("body"), "UTF-8")
    return shaped.select(
        "event_id",
        F.encode("id", "UTF-8").alias("key"),
        F.when(F.col("event_id") % 13 == 0, F.concat(body, bad)).otherwise(body).alias("value"),
        F.when(F.col("event_id") % 10 != 0, headers).alias("headers"),
        F.when(F.col("event_id") % 11 != 0, F.lit("record-updates")).alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def _pick(values: list[str], index: Column) -> Column:
    # one literal, split when the plan is optimised: far fewer calls than a literal per value
    return F.get(F.split(F.lit(" ".join(values)), " "), (index % len(values)).cast("int"))


def _item(doc_id: Column, i: Column) -> Column:
    n = (doc_id * (i + 3)) % 97
    at = doc_id + i
    unit = F.when((doc_id % 23 == 5) & (i == 0), F.lit("gallons")).otherwise(_pick(S.UNITS, at))
    return F.struct(
        F.concat(F.lit("item-"), n.cast("string")).alias("id"),
        F.concat(F.lit("Item "), n.cast("string")).alias("name"),
        unit.alias("uoM"),
        _pick(S.REQUIREMENTS, at).alias("requirement"),
        F.concat((i + 1).cast("string"), F.lit(" of item "), n.cast("string")).alias("display"),
        ((i + 1) * F.lit(0.5)).cast("double").alias("units"),
        _pick(S.PREPARATIONS, at).alias("preparation"),
        F.lit("").alias("suggestions"),
        F.array(F.concat(F.lit("kind-"), (n % 7).cast("string"))).alias("types"),
        _pick(S.TAXONOMY_GROUPS, at).alias("taxonomyFilterType"),
        F.array(_pick(S.APPLICATIONS, at), F.lit("base")).alias("applications"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full nested records, one per document, built inside the row."""
    d = F.col("doc_id")
    small = lambda m: (d % m).cast("int")
    stars = [small(3), small(2), small(5), small(7), small(11)]
    count = sum(stars[1:], stars[0])
    total = sum((s * (i + 2) for i, s in enumerate(stars[1:])), stars[0])
    rating = F.struct(
        *[s.alias(n) for s, n in zip(stars, "oneStars twoStars threeStars fourStars fiveStars".split())],
        total.alias("totalStars"),
        F.when(count > 0, F.round(total / count, 4)).otherwise(F.lit(0.0)).alias("rating"),
        count.alias("ratingCount"),
    )
    image = lambda kind, w, h: F.struct(
        F.lit(kind).alias("type"),
        F.concat(F.lit("https://img.example/"), F.col("id"), F.lit(f"-{kind}.webp")).alias("uri"),
        F.lit(w).alias("width"),
        F.lit(h).alias("height"),
    )
    words = lambda *v: F.array(*v).cast("array<string>")
    keywords = []
    for n, name in enumerate(S.KEYWORD_LISTS):
        keywords.append(
            F.when((d + n) % 4 == 0, F.lit(None).cast("array<string>"))
            .when((d + n) % 4 == 1, words())
            .otherwise(words(F.col("lang"), F.concat(F.lit("kw-"), ((d + n) % 10).cast("string"))))
            .alias(name)
        )
    keywords.append(
        F.when(d % 3 == 0, F.lit(None).cast("string")).when(d % 3 == 1, "").otherwise("strong").alias("keywordsStrength")
    )
    keywords.append(F.when(d % 2 == 0, "").otherwise("cold").alias("keywordsTemperature"))
    steps = F.transform(
        F.sequence(F.lit(0), (d % 3).cast("int")),
        lambda i: F.struct(
            F.concat(F.lit("Step "), ((i * 2 + 1) % 5).cast("string")).alias("display"),
            ((i * 2 + 1) % 5).cast("int").alias("order"),
        ),
    )
    nutrients = "calories servingVolumeMl carbohydrateContent sugarContent fatContent saturatedFatContent".split()
    nutrients += "proteinContent fiberContent sodiumContent".split()
    nutrition = F.struct(
        *[(d % (k + 5)).cast("double").alias(n) for k, n in enumerate(nutrients)],
        F.lit(True).alias("isEstimated"),
        (d % 2 == 0).alias("isComplete"),
    )
    diets = "isVegan isVegetarian isDairyFree isGlutenFree isNutFree isComplete".split()
    dietary = F.struct(*[(d % (k + 2) == 0).alias(n) for k, n in enumerate(diets)])
    return docs(spark, sf_dir).select(
        "doc_id",
        "id",
        F.concat(F.lit("Record "), "id").alias("title"),
        F.concat("source", F.lit(": record "), "id").alias("descriptiveTitle"),
        F.concat("lang", F.lit(" text from "), "source").alias("description"),
        "content",
        minutes_after_base(d).alias("publishedOn"),
        F.col("version").alias("modifiedOn"),
        (small(4) + 1).alias("serves"),
        (F.col("n_chars") % 20 + 3).cast("int").alias("prepTimeMinutes"),
        (d % 3 == 0).alias("isIba"),
        F.when(d % 2 == 0, F.array(image("tile", 300, 300), image("detail", 600, 400)))
        .otherwise(F.array(image("tile", 300, 300)))
        .alias("images"),
        F.array(_pick(S.GLASSWARE, d), _pick(S.GLASSWARE, d * 7)).alias("glassware"),
        rating.alias("rating"),
        F.create_map(F.lit("like"), small(9), F.lit("save"), small(4)).alias("reactions"),
        F.array(F.concat(F.lit("Record "), "id")).alias("searchableTitles"),
        F.array("lang", "source").alias("tags"),
        F.array("source").alias("collections"),
        F.array(F.concat(F.lit("#"), "lang")).alias("hashtags"),
        F.transform(F.sequence(F.lit(0), (d % 3 + 1).cast("int")), lambda i: _item(d, i)).alias("ingredients"),
        steps.alias("instructions"),
        F.struct(*keywords).alias("keywords"),
        F.col("lang").alias("recipeCuisine"),
        F.when(
            d % 2 == 0,
            F.array(F.struct(F.lit("pinterest").alias("type"), F.concat(F.lit("https://p.example/"), "id").alias("url"))),
        )
        .otherwise(
            F.array(
                F.struct(F.lit("pinterest").alias("type"), F.concat(F.lit("https://p.example/"), "id").alias("url")),
                F.struct(F.lit("facebook").alias("type"), F.concat(F.lit("https://f.example/"), "id").alias("url")),
            )
        )
        .alias("socialLinks"),
        F.when(d % 5 != 0, nutrition).alias("nutrition"),
        F.when(d % 7 != 0, dietary).alias("dietary"),
    )


RECORD_COLUMNS = [*S.REQUIRED_FIELDS, *S.OPTIONAL_FIELDS]


def record_struct() -> Column:
    return F.struct(*RECORD_COLUMNS)


def chunked(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    """Documents with rule-made chunks of their raw content."""
    return chunk.with_chunks(docs(spark, sf_dir).select("doc_id", "content"), "content", limit)


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers per document: good ones and every kind of fault, by doc_id modulo 13.

    ``first_answer`` is the first try; ``second_answer`` is what a repair request would
    get.
    """
    k = F.col("doc_id") % 13
    head = F.get(F.col("chunks"), F.lit(0))
    tail = F.filter("chunks", lambda c, i: i > 0)

    def one(category: Column, content: Column) -> Column:
        return F.array(F.struct(category.alias("category"), content.alias("content")))

    altered = (
        F.when(k == 8, F.concat(one(F.lit("mystery"), head["content"]), tail))
        .when(k == 9, F.concat(F.col("chunks"), one(F.lit("other"), F.lit(" \t"))))
        .when(k == 10, tail)
        .when(k == 11, F.concat(F.col("chunks"), one(F.lit("other"), head["content"])))
        .when(k == 12, F.concat(one(head["category"], F.concat(head["content"], F.lit(" (sic)"))), tail))
        .otherwise(F.col("chunks"))
    )
    good = F.to_json(F.col("altered"))
    cut = F.substring(good, F.lit(1), F.char_length(good) - 1)
    base = once(chunked(spark, sf_dir), altered=altered).drop("chunks")
    return once(
        base,
        first_answer=(
            F.when(k.isin(1, 5), cut)
            .when(k == 2, F.concat(F.lit('{"chunks":'), good, F.lit("}")))
            .when(k == 3, F.to_json(F.transform("altered", lambda c: F.struct(c["category"].alias("category")))))
            .when(
                k == 4,
                F.to_json(
                    F.transform(
                        "altered",
                        lambda c: F.struct(
                            c["category"].alias("category"), c["content"].alias("content"), F.lit("y").alias("note")
                        ),
                    )
                ),
            )
            .when(k == 6, "")
            .when(k == 7, "[]")
            .otherwise(good)
        ),
        second_answer=F.when(k == 1, good).when(k == 5, cut),
    ).drop("altered")


def star(value: Column) -> Column:
    return F.least(F.lit(5), F.floor(value / 50).cast("int") + 1)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as record items: part as item, return flag as its use."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("item_id"),
        F.when(flag == "R", "garnishment").when(flag == "A", "base").otherwise("additional").alias("application"),
        F.col("l_quantity").alias("units"),
    )


def chunk_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("label").cast("string").alias("record_id"), "embedding"
    )


def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search request per record: its first chunk vector."""
    return (
        chunk_vectors(spark, sf_dir)
        .groupBy(F.col("record_id").alias("request_id"))
        .agg(F.min_by("embedding", "chunk_id").alias("query_vector"))
    )
