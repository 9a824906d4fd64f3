"""Cleaning jobs over tables of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.plan import once

# The names under which the cleaning tools are offered and called.
LIST_TOOLS = {
    "remove_markdown": X.clean_markdown,
    "remove_html_tags": X.clean_html,
    "remove_emojis": X.strip_emoji,
    "remove_special_json_characters": X.json_escape,
}
LOOKUP_TOOL = "get_record"
MAX_LIST_RUNS = 8


def clean_column(df: DataFrame, source: str, function, target: str = "cleaned") -> DataFrame:
    """One cleaning function over a column, with what it changed."""
    before = F.coalesce(F.col(source), F.lit(""))
    return (
        once(once(df, before=before), **{target: function(F.col("before"))})
        .withColumn("chars_removed", F.char_length("before") - F.char_length(target))
        .withColumn("changed", F.col("before") != F.col(target))
        .drop("before")
    )


def extract(df: DataFrame, source: str, use_model: bool = False, tool_plan: str = "tools") -> DataFrame:
    """Mode switch: the fixed cleaning path, or a model's own sequence of tool calls."""
    if not use_model:
        return once(df, extraction_text=X.clean_document(F.col(source)))
    return run_tools(df, source, tool_plan).withColumn("extraction_text", F.col("final_text"))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~X.is_blank(F.col(column)))


def blank_only(df: DataFrame, column: str) -> DataFrame:
    return df.filter(X.is_blank(F.col(column)))


def blocks_to_text(content: Column) -> Column:
    """Plain text of a message content held as VARIANT.

    A string is stripped.  A list keeps its strings and the ``text`` of its objects,
    stripped, blanks dropped, one per line.  Anything else is its own string form.
    """
    kind = F.schema_of_variant(content)
    items = F.try_variant_get(content, "$", "array<variant>")

    def item_text(item: Column) -> Column:
        item_kind = F.schema_of_variant(item)
        inner = F.try_variant_get(item, "$.text", "variant")
        return (
            F.when(item_kind == "STRING", F.try_variant_get(item, "$", "string"))
            .when(
                item_kind.startswith("OBJECT") & (F.schema_of_variant(inner) == "STRING"),
                F.try_variant_get(item, "$.text", "string"),
            )
            .otherwise(F.lit(""))
        )

    parts = F.filter(F.transform(items, lambda i: X.strip(item_text(i))), lambda p: p != "")
    return (
        F.when(kind == "STRING", X.strip(F.try_variant_get(content, "$", "string")))
        .when(kind.startswith("ARRAY"), F.nullif(F.array_join(parts, "\n"), F.lit("")))
        .when(kind == "VOID", F.lit(None).cast("string"))
        .otherwise(F.try_variant_get(content, "$", "string"))
    )


def first_allowed(calls: Column, allowed: list[str] | None = None) -> Column:
    """First proposed tool call whose name is on the allow-list, else null."""
    names = allowed or [LOOKUP_TOOL, *LIST_TOOLS]
    return F.get(F.filter(calls, lambda call: call["name"].isin(*names)), F.lit(0))


def final_text(final: Column, current: Column) -> Column:
    return F.coalesce(F.nullif(final, F.lit("")), F.nullif(current, F.lit("")))


def tool_summary(tools: Column) -> Column:
    return F.coalesce(F.nullif(F.array_join(tools, ", "), F.lit("")), F.lit("none"))


def run_tools(df: DataFrame, source: str, plan: str = "tools") -> DataFrame:
    """Apply a record's planned tool calls one after another until a stop rule holds.

    The current text starts empty; while it is empty a cleaning tool reads the source.
    Stop rules: the same cleaning tool twice in a row with no change; a tool that is
    not on the list; more than eight runs of listed tools (an error, no text).  The
    lookup tool is a listed run that empties the current text.  A stop with nothing
    to show is no stop, and a plan that ends leaves the current text as the answer.

    The state travels as a struct through ``aggregate`` in one map-only pass, so no
    round needs a shuffle, a checkpoint or a driver loop.
    """
    state = F.aggregate(
        F.col(plan),
        F.struct(
            F.lit("").alias("text"),
            F.lit("").alias("last_tool"),
            F.array().cast("array<string>").alias("done"),
            F.lit("running").alias("status"),
        ),
        lambda acc, tool: F.when(acc["status"] != "running", acc).otherwise(_step(acc, tool, F.col(source))),
    )
    return (
        once(df, state=state)
        .withColumn("status", F.when(F.col("state.status") == "running", "plan_end").otherwise(F.col("state.status")))
        .withColumn("completed_tools", F.col("state.done"))
        .withColumn("rounds", F.size("state.done"))
        .withColumn(
            "final_text",
            F.when(F.col("status") != "too_many_runs", final_text(F.lit(None).cast("string"), F.col("state.text"))),
        )
        .drop("state")
    )


def _step(state: Column, tool: Column, source: Column) -> Column:
    cleaning = tool.isin(*LIST_TOOLS)
    given = F.when(state["text"] == "", F.coalesce(source, F.lit(""))).otherwise(state["text"])
    outcome = F.lit("")
    for name, function in LIST_TOOLS.items():
        outcome = F.when(tool == name, function(given)).otherwise(outcome)
    def taken(stripped: Column) -> Column:
        return (
            F.when(cleaning & (stripped != ""), stripped)
            .when(tool == LOOKUP_TOOL, F.lit(""))
            .otherwise(state["text"])
        )

    def judged(new: Column) -> Column:
        listed = cleaning | (tool == LOOKUP_TOOL)
        stuck = cleaning & (tool == state["last_tool"]) & (new == state["text"])
        return F.struct(
            new.alias("text"),
            F.when(listed, tool).otherwise(state["last_tool"]).alias("last_tool"),
            F.when(listed, F.array_append(state["done"], tool)).otherwise(state["done"]).alias("done"),
            F.when(~listed & (new != ""), "unknown_tool")
            .when(stuck & (new != ""), "no_progress")
            .when(listed & ~stuck & (F.size(state["done"]) >= MAX_LIST_RUNS), "too_many_runs")
            .otherwise("running")
            .alias("status"),
        )

    # one-element transforms give the stripped outcome and the new text a name, so each is computed once
    new_text = F.transform(F.array(X.strip(outcome)), taken)
    return F.transform(new_text, judged)[0]
