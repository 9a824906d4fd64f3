"""Decoding and checking of change-event messages.

A message frame has the columns of ``schemas.MESSAGE_SCHEMA``.  Nothing here
throws on bad data: every check is a null-returning function or a predicate, and
what fails carries a reason, so one bad message or item never stops another.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.plan import let, once
from millrace.functions.text import is_blank, json_unescape
from millrace.schemas import ENUMS, OPTIONAL_FIELDS, RECORD_KEY, REQUIRED_FIELDS, UNKNOWN_ID, result_ddl

INSTANT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9:.]+(?:[Zz]|[+-][0-9]{2}:?[0-9]{2})\z"


def _named(text: Column) -> Column:
    """An object that holds the JSON value at the start of the text under ``v``."""
    return F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))


def _alone(text: Column) -> Column:
    """Whether the text is one value in brackets: read as tokens, no value is built."""
    return F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1


def strict_json(text: Column) -> Column:
    """The JSON value that makes up the whole text; null if anything follows it.

    The parser stops at the end of a value.  Inside brackets and inside an object what
    follows has to fit as well, and no text can close both.
    """
    return F.when(_alone(text), F.try_variant_get(_named(text), "$.v", "variant"))


def is_json(text: Column) -> Column:
    """Whether the whole text is a JSON value; null for no text."""
    return F.when(text.isNotNull(), F.coalesce(_alone(text), F.lit(False)) & _named(text).isNotNull())


def decode_messages(messages: DataFrame) -> DataFrame:
    """Add ``text``, ``payload`` and ``items``; null where a step failed."""
    read = once(messages, text=F.try_validate_utf8(F.col("value").cast("string")))
    return once(once(read, payload=strict_json(F.col("text"))), items=unwrap(F.col("payload")))


def unwrap(payload: Column) -> Column:
    """Array under ``data``, else the payload itself when that is an array."""
    listed = lambda path: F.try_variant_get(payload, path, "array<variant>")
    return let(listed("$.data"), lambda data: F.when(data.isNotNull(), data).otherwise(listed("$")))


def message_outcome() -> Column:
    """Why a decoded message yields nothing, or ``ok``."""
    return (
        F.when(F.col("value").isNull(), "no_value")
        .when(F.col("text").isNull(), "bad_utf8")
        .when(F.col("payload").isNull(), "bad_json")
        .when(F.col("items").isNull(), "not_a_list")
        .otherwise("ok")
    )


def with_item_count(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("item_count", F.when(F.col("items").isNotNull(), F.size("items")))


def fan_out(decoded: DataFrame, *keep: str) -> DataFrame:
    """One row per item; a message without items keeps one row with a null item."""
    return decoded.select(*keep, F.posexplode_outer("items").alias("item_pos", "item"))


FIELDS = {**REQUIRED_FIELDS, **OPTIONAL_FIELDS}
VARIANT_STRUCT = "struct<" + ",".join(f"{name}:variant" for name in FIELDS) + ">"


def _typed(name: str) -> Column:
    given = F.col("top")[name]
    spark_type, kind = FIELDS[name]
    if kind == "instant":
        return F.try_to_timestamp(F.try_variant_get(given, "$", "string"))
    return F.try_variant_get(given, "$", spark_type)


def _complete(value: Column, spark_type: T.DataType) -> Column:
    """No null anywhere that the schema does not allow; every nested field is required."""
    if isinstance(spark_type, T.StructType):
        parts = [_complete(value[f.name], f.dataType) for f in spark_type.fields]
        return reduce(lambda a, b: a & b, parts, value.isNotNull())
    if isinstance(spark_type, T.ArrayType):
        return value.isNotNull() & F.forall(value, lambda v: _complete(v, spark_type.elementType))
    return value.isNotNull()


def _valid(name: str) -> Column:
    given, value = F.col("top")[name], F.col("typed")[name]
    spark_type, kind = FIELDS[name]
    if kind == "string":
        return F.schema_of_variant(given) == "STRING"
    if kind == "instant":
        return value.isNotNull() & F.try_variant_get(given, "$", "string").rlike(INSTANT)
    whole = _complete(value, T.StructType.fromDDL(f"v {spark_type}")["v"].dataType)
    if name in OPTIONAL_FIELDS:
        return given.isNull() | F.is_variant_null(given) | whole
    return whole


def bad_fields() -> Column:
    """Names of fields that are absent or of the wrong kind."""
    checks = [F.when(~F.coalesce(_valid(name), F.lit(False)), F.lit(name)) for name in FIELDS]
    return F.array_compact(F.array(*checks))


def enum_violations(glassware: Column, ingredients: Column) -> Column:
    """``field=value`` for every enumerated value outside its declared set."""

    def outside(values: Column, field: str) -> Column:
        bad = F.filter(values, lambda v: v.isNull() | ~v.isin(*ENUMS[field]))
        found = F.transform(bad, lambda v: F.concat(F.lit(f"{field}="), F.coalesce(v, F.lit("null"))))
        return F.coalesce(found, F.array().cast("array<string>"))

    def each(field: str) -> Column:
        return F.transform(ingredients, lambda i: i[field])

    return F.concat(
        outside(glassware, "glassware"),
        *[outside(each(f), f) for f in ("uoM", "preparation", "requirement", "taxonomyFilterType")],
        outside(F.flatten(each("applications")), "applications"),
    )


def check_items(items: DataFrame) -> DataFrame:
    """Add ``id``, the typed record, and ``reject_reason`` (null for a good item).

    An item is opened once into its fields, each field is cast once, and all checks
    read the casts.  String fields must be JSON strings; nested text takes any scalar.
    """
    opened = once(items, top=F.try_variant_get("item", "$", VARIANT_STRUCT))
    typed = once(opened, typed=F.struct(*[_typed(name).alias(name) for name in FIELDS]))
    checked = once(
        typed,
        id=F.col("typed.id"),
        is_object=F.col("top").isNotNull(),
        bad_fields=bad_fields(),
        bad_values=enum_violations(F.col("typed.glassware"), F.col("typed.ingredients")),
    ).drop("top")
    return checked.withColumn(
        "reject_reason",
        F.when(F.col("item").isNull(), "no_item")
        .when(~F.col("is_object"), "not_an_object")
        .when(F.size("bad_fields") > 0, "bad_fields")
        .when(F.size("bad_values") > 0, "bad_enum")
        .when(F.col("id") == UNKNOWN_ID, "sentinel_id")
        .when(F.char_length("id") == 0, "empty_id"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNull())


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reject_reason").isNotNull())


def typed_records(checked: DataFrame, *keep: str) -> DataFrame:
    """Accepted items as typed record structs."""
    return accepted(checked).select(*keep, F.col("typed").alias("record"))


def not_sentinel(df: DataFrame, column: str = "id") -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column) != UNKNOWN_ID))


def has_id(column: str = "id") -> Column:
    return F.coalesce(F.char_length(column) > 0, F.lit(False))


def text_outcome(column: str) -> Column:
    """Receipt rule then validation rule for an extraction text."""
    text = F.col(column)
    return F.when(text.isNull() | (text == ""), "dropped").when(is_blank(text), "rejected").otherwise("accepted")


def header_map(headers: Column) -> Column:
    """Headers as a map: only decodable byte values, the last of a repeated key."""
    decoded = F.transform(
        headers, lambda h: F.struct(h["key"].alias("key"), F.try_validate_utf8(h["value"].cast("string")).alias("value"))
    )
    usable = F.filter(decoded, lambda h: h["key"].isNotNull() & h["value"].isNotNull())
    names = F.array_distinct(F.transform(usable, lambda h: h["key"]))
    last = F.transform(names, lambda n: F.element_at(F.filter(usable, lambda h: h["key"] == n), -1)["value"])
    return F.map_from_arrays(names, last)


def source_attributes(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.lit("kafka").alias("system"),
        F.coalesce("topic", F.lit("unknown")).alias("topic"),
        F.lit("process").alias("operation"),
        "partition",
        "offset",
    )


def decode_extractions(messages: DataFrame, *keep: str, record_key: str = RECORD_KEY) -> DataFrame:
    """Extraction results from their JSON values: ``record`` (published as ``record_key``), ``extraction_text`` as published, and
    ``text``, the same with its escapes resolved, which is what gets chunked."""
    parsed = F.from_json(F.try_validate_utf8(F.col("value").cast("string")), result_ddl(record_key, "extraction_text:string"))
    record = F.col("result")[record_key].alias("record")
    opened = once(messages, result=parsed).select(*keep, record, "result.extraction_text")
    return opened.withColumn("text", json_unescape(F.col("extraction_text")))


def decode_chunk_results(messages: DataFrame, *keep: str, record_key: str = RECORD_KEY) -> DataFrame:
    """Chunk results from their JSON values; ``exact_keys`` is false where a chunk has
    other keys than the two it must have, and where there is no list of chunks."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    schema = result_ddl(record_key, "chunks:array<map<string,string>>")
    parsed = once(messages, result=F.from_json(text, schema)).select(*keep, "result")
    return (
        parsed.select(*keep, F.col("result")[record_key].alias("record"), F.col("result.chunks").alias("raw_chunks"))
        .withColumn("exact_keys", F.coalesce(exact_keys(F.col("raw_chunks")), F.lit(False)))
        .withColumn("chunks", F.when(F.col("exact_keys"), as_chunks(F.col("raw_chunks"))))
        .drop("raw_chunks")
    )


def exact_keys(maps: Column) -> Column:
    """True when every object has the keys category and content and no other."""
    return F.forall(maps, lambda m: F.array_sort(F.map_keys(m)) == F.array(F.lit("category"), F.lit("content")))


def as_chunks(maps: Column) -> Column:
    return F.transform(
        maps, lambda m: F.struct(m["category"].alias("category"), m["content"].alias("content"))
    )
