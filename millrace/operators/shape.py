"""Nested projections from a record and its chunks to an index request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.chunks import keep_filled
from millrace.functions.plan import once
from millrace.schemas import ENUMS, KEYWORD_LISTS, KEYWORD_SCALARS


def translate(value: Column, enum: str) -> Column:
    """Member of the target enumeration with the source value's name; null for no member."""
    return F.when(value.isin(*ENUMS[enum]), value)


def untranslatable(record: dict[str, Column] | None = None) -> Column:
    """``field=value`` for every value of a record that has no member to go to."""
    glassware = F.col("glassware") if record is None else record["glassware"]
    items = F.col("ingredients") if record is None else record["ingredients"]

    def failures(values: Column, enum: str) -> Column:
        bad = F.filter(values, lambda v: translate(v, enum).isNull())
        return F.transform(bad, lambda v: F.concat(F.lit(f"{enum}="), F.coalesce(v, F.lit("null"))))

    def each(field: str) -> Column:
        return F.transform(items, lambda i: i[field])

    return F.concat(
        failures(glassware, "glassware"),
        *[failures(each(f), f) for f in ("uoM", "preparation", "requirement")],
        failures(F.flatten(each("applications")), "applications"),
    )


def reshape_items(items: Column) -> Column:
    """Ten of the eleven item fields, enumerations translated; the taxonomy group stays behind."""
    return F.transform(
        items,
        lambda i: F.struct(
            i["id"].alias("id"),
            i["name"].alias("name"),
            i["units"].alias("units"),
            i["display"].alias("display"),
            i["suggestions"].alias("suggestions"),
            translate(i["preparation"], "preparation").alias("preparation"),
            translate(i["uoM"], "uoM").alias("uoM"),
            i["types"].alias("types"),
            F.transform(i["applications"], lambda a: translate(a, "applications")).alias("applications"),
            translate(i["requirement"], "requirement").alias("requirement"),
        ),
    )


def reshape_images(images: Column) -> Column:
    return F.transform(
        images,
        lambda i: F.struct(*[i[f].alias(f) for f in ("type", "uri", "width", "height")]),
    )


def document() -> Column:
    """The ten fields of a record that the index keeps, from the record's columns."""
    return F.struct(
        *[F.col(c) for c in ("id", "title", "descriptiveTitle", "serves", "prepTimeMinutes", "isIba")],
        reshape_items(F.col("ingredients")).alias("ingredients"),
        F.transform("glassware", lambda g: translate(g, "glassware")).alias("glassware"),
        F.col("rating.rating").alias("rating"),
        reshape_images(F.col("images")).alias("images"),
    )


def keyword_defaults(keywords: Column | None = None) -> Column:
    """List keywords: null becomes empty.  Single keywords: empty becomes null."""
    given = F.col("keywords") if keywords is None else keywords
    empty = F.array().cast("array<string>")
    return F.struct(
        *[F.coalesce(given[k], empty).alias(k) for k in KEYWORD_LISTS],
        *[F.nullif(given[k], F.lit("")).alias(k) for k in KEYWORD_SCALARS],
    )


def request_chunks(chunks: Column) -> Column:
    return F.transform(
        keep_filled(chunks), lambda c: F.struct(c["content"].alias("content"), c["category"].alias("category"))
    )


def embedding_requests(records: DataFrame, chunks: str = "chunks") -> DataFrame:
    """One request per record; ``reject_reason`` says why a record has none to send."""
    shaped = once(records, failures=untranslatable(), content_chunks=request_chunks(F.col(chunks)))
    request = F.struct(F.col("content_chunks"), document().alias("document"), keyword_defaults().alias("keywords"))
    return shaped.withColumn(
        "reject_reason",
        F.when(F.coalesce(F.char_length("id"), F.lit(0)) == 0, "empty_id")
        .when(F.coalesce(F.size("content_chunks"), F.lit(0)) <= 0, "no_chunks")
        .when(F.size("failures") > 0, "bad_enum"),
    ).withColumn("request", F.when(F.col("reject_reason").isNull(), request))


def delivery_outcome(status: Column) -> Column:
    """What an index answer means: done, an error of kind runtime or value, or unexpected."""
    return (
        F.when(status == 204, "delivered")
        .when(status == 401, "runtime_error: unauthorized")
        .when(status == 403, "runtime_error: forbidden")
        .when(status == 422, "value_error: unprocessable")
        .when(status == 500, "runtime_error: server")
        .otherwise("unexpected_status")
    )
