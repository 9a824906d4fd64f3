"""Cleaning functions under SQL names, and chunks as a table function."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.functions import chunks as C
from millrace.functions import text as X
from millrace.functions.ids import uuid5_dns

# name -> column function of one text column
COLUMN_FUNCTIONS = {
    "remove_markdown": X.clean_markdown,
    "remove_html_tags": X.clean_html,
    "remove_emojis": X.strip_emoji,
    "remove_special_json_characters": X.json_escape,
    "clean_document": X.clean_document,
    "strip_space": X.strip,
    "unwrap_code_fence": X.unwrap_fence,
    "span_category": C.categorize,
    "uuid5_dns": uuid5_dns,
}


def _literal(value: str) -> str:
    """A SQL string literal that parses back to ``value``."""
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if " " <= c <= "~" else _escape(c) for c in quoted) + "'"


def _escape(char: str) -> str:
    return f"\\u{ord(char):04x}" if ord(char) < 0x10000 else f"\\U{ord(char):08x}"


def _rule_sql(expr: str, rule: tuple[str, str, str]) -> str:
    flags, pattern, replacement = rule
    return f"regexp_replace({expr}, {_literal(f'(?d{flags}){pattern}')}, {_literal(replacement)})"


def _rules_sql(expr: str, rules: list[tuple[str, str, str]]) -> str:
    for rule in rules:
        expr = _rule_sql(expr, rule)
    return expr


def _strip_sql(expr: str) -> str:
    return f"btrim({expr}, {_literal(X.SPACE_CHARS)})"


def _escape_sql(expr: str) -> str:
    for char, short in X.SHORT_ESCAPES:
        expr = f"replace({expr}, {_literal(char)}, {_literal(short)})"
    units = "lower(hex(encode(r, 'UTF-16BE')))"
    return (
        f"array_join(transform(regexp_extract_all({expr}, {_literal('([ -~]+|[^ -~]+)')}, 1), "
        f"r -> CASE WHEN rlike(r, {_literal(chr(92) + 'A[ -~]')}) THEN r "
        f"ELSE regexp_replace({units}, '(....)', {_literal(chr(92) * 2 + 'u$1')}) END), '')"
    )


def sql_bodies() -> dict[str, str]:
    """Bodies of the SQL functions over their argument ``t``."""
    markdown = f"replace({_strip_sql(_rule_sql(_strip_sql(_rules_sql('t', X.MARKDOWN_RULES)), X.FENCE_RULE))}, '`', '')"
    return {
        "remove_markdown": markdown,
        "remove_html_tags": _strip_sql(_rules_sql("t", X.HTML_RULES)),
        "remove_emojis": _rules_sql("t", [X.KEYCAP_RULE, X.FAST_EMOJI_RULE]),
        "remove_special_json_characters": _escape_sql("t"),
        "clean_document": (
            "remove_special_json_characters(remove_emojis(remove_html_tags(remove_markdown(coalesce(t, '')))))"
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Cleaners as SQL functions of the session.

    They are SQL bodies, which Catalyst expands in place: no Python runs per row.
    """
    names = []
    for name, body in sql_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN {body}")
        names.append(name)
    return names


def register_chunk_table_function(spark: SparkSession, name: str = "text_chunks") -> None:
    """``text_chunks(t)`` gives one row per span of a text, again as a plain SQL body."""
    spans = f"filter(split(t, '\\n'), s -> rlike(s, {_literal(f'[^{X.SPACE}]')}))"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS TABLE (pos INT, span STRING) "
        f"RETURN SELECT p, s FROM (SELECT posexplode({spans}) AS (p, s))"
    )


def column_function(name: str, column: Column | str) -> Column:
    """Registry look-up by name, as for a tool named by a model."""
    return COLUMN_FUNCTIONS[name](F.col(column) if isinstance(column, str) else column)
