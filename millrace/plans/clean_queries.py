"""Queries over the cleaning jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as X
from millrace.functions.plan import once
from millrace.operators import clean
from millrace.plans import feeds
from millrace.plans import oracle_feeds as O
from millrace.plans.registry import query


def _report(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, "cleaned", F.col("chars_removed").cast("long").alias("chars_removed"), "changed")


def _report_sql(source: str, key: str, column: str, cleaned: str) -> str:
    return O.sql(
        f"""SELECT {key}, cleaned, length(b) - length(cleaned) AS chars_removed, b <> cleaned AS changed
            FROM (SELECT {key}, coalesce({column}, '') AS b, {cleaned} AS cleaned FROM {source})"""
    )


def _on_docs(spark: SparkSession, sf_dir: str, function) -> DataFrame:
    return _report(clean.clean_column(feeds.docs(spark, sf_dir), "content", function), "doc_id")


@query(_report_sql("f_docs", "doc_id", "content", O.markdown("coalesce(content, '')")))
def clean_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_docs(spark, sf_dir, X.clean_markdown)


@query(_report_sql("f_docs", "doc_id", "content", O.unwrap("content")))
def unwrap_code_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_docs(spark, sf_dir, X.unwrap_fence)


@query(_report_sql("f_docs", "doc_id", "content", "replace(content, '`', '')"))
def strip_backticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_docs(spark, sf_dir, X.strip_backticks)


@query(_report_sql("pages", "page_id", "html", O.html("html")))
def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = feeds.text_table(spark, sf_dir, "pages").select("page_id", "html")
    return _report(clean.clean_column(pages, "html", X.clean_html), "page_id")


@query(_report_sql("f_docs", "doc_id", "content", O.emoji("content")))
def strip_emoji(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_docs(spark, sf_dir, X.strip_emoji)


@query(_report_sql("f_docs", "doc_id", "content", O.escape("content")))
def json_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _on_docs(spark, sf_dir, X.json_escape)


_CLEANED = f"SELECT doc_id, id, version, {O.escape(O.readable('content'))} AS extraction_text FROM f_docs"


@query(O.sql(f"SELECT doc_id, extraction_text FROM ({_CLEANED})"))
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.extract(feeds.docs(spark, sf_dir), "content").select("doc_id", "extraction_text")


@query(
    O.sql(
        f"""SELECT doc_id, CASE WHEN {O.blank('extraction_text')} THEN 'blank' ELSE 'kept' END AS outcome,
            length(extraction_text) AS n_chars FROM ({_CLEANED})"""
    )
)
def drop_blank_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean.extract(feeds.docs(spark, sf_dir).select("doc_id", "content"), "content").drop("content")
    outcome = F.when(X.is_blank(F.col("extraction_text")), "blank").otherwise("kept")
    return cleaned.select(
        "doc_id", outcome.alias("outcome"), F.char_length("extraction_text").cast("long").alias("n_chars")
    )


def _turn_content() -> Column:
    """Message content of five shapes, as JSON text, from a conversation turn."""
    k = (F.col("conv_id") + F.col("turn")) % 5
    quoted = F.concat(F.lit('"'), X.json_escape(F.col("text")), F.lit('"'))
    return (
        F.when(k == 0, quoted)
        .when(
            k == 1,
            F.concat(
                F.lit('["  a ",{"type":"text","text":'), quoted, F.lit('},{"type":"image","n":1},"",{"text":5}," b"]')
            ),
        )
        .when(k == 2, '["  ",{"type":"image"}]')
        .when(k == 3, F.concat(F.lit(""), F.col("turn").cast("string")))
        .otherwise("null")
    )


@query(
    f"""SELECT conv_id, turn, CASE (conv_id + turn) % 5 WHEN 0 THEN {O.strip("text")}
          WHEN 1 THEN 'a' || chr(10) || CASE WHEN {O.strip("text")} = '' THEN '' ELSE {O.strip("text")} || chr(10) END || 'b'
          WHEN 2 THEN '(none)' WHEN 3 THEN CAST(turn AS VARCHAR) ELSE '(none)' END AS plain_text
        FROM conversations"""
)
def blocks_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = feeds.text_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    parsed = once(turns, content=F.try_parse_json(_turn_content()))
    plain = once(parsed, plain_text=clean.blocks_to_text(F.col("content")))
    return plain.select("conv_id", "turn", F.coalesce("plain_text", F.lit("(none)")).alias("plain_text"))


# Tool sequences by doc_id modulo 9.
_M, _H, _E, _J = clean.LIST_TOOLS
TOOL_PLANS = {
    0: [_M, _H, _E, _J],
    1: [clean.LOOKUP_TOOL, _M, _M, _M],
    2: [_M, _H, "translate", _E],
    3: [_M, _H, _M, _H, _M, _H, _M, _H, _E],
    4: [],
    5: [_E, _E, _E, _J],
    6: [clean.LOOKUP_TOOL, _H, clean.LOOKUP_TOOL, _M],
    7: ["translate", _M, "translate"],
    8: [_M, _H, _M, _H, _M, _H, _M, _H],
}


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = F.array().cast("array<string>")
    for k, tools in TOOL_PLANS.items():
        if tools:
            plan = F.when(F.col("doc_id") % 9 == k, F.array(*[F.lit(t) for t in tools])).otherwise(plan)
    return feeds.docs(spark, sf_dir).select("doc_id", "content", plan.alias("tools"))


def _run_sql() -> str:
    """The tool loop unrolled, one common table expression per step."""
    plans = " ".join(f"WHEN {k} THEN CAST({O.listing(t)} AS VARCHAR[])" for k, t in TOOL_PLANS.items())
    ctes = {
        "f_run0": f"""SELECT doc_id, content, CASE doc_id % 9 {plans} END AS tools, '' AS txt, '' AS last_tool,
                      CAST([] AS VARCHAR[]) AS done, 'running' AS status FROM f_docs"""
    }
    names = O.values(list(clean.LIST_TOOLS))
    for i in range(1, 10):
        ctes[f"f_run{i}"] = f"""
          SELECT doc_id, content, tools, CASE WHEN live THEN new_text ELSE txt END AS txt,
            CASE WHEN live AND listed THEN tool ELSE last_tool END AS last_tool,
            CASE WHEN live AND listed THEN list_append(done, tool) ELSE done END AS done,
            CASE WHEN NOT live THEN status
                 WHEN NOT listed AND new_text <> '' THEN 'unknown_tool'
                 WHEN cleaning AND tool = last_tool AND new_text = txt AND new_text <> '' THEN 'no_progress'
                 WHEN listed AND NOT (cleaning AND tool = last_tool AND new_text = txt) AND len(done) >= 8 THEN 'too_many_runs'
                 ELSE 'running' END AS status
          FROM (SELECT *, cleaning OR tool = '{clean.LOOKUP_TOOL}' AS listed,
                  CASE WHEN cleaning THEN coalesce(nullif({O.strip("outcome")}, ''), txt)
                       WHEN tool = '{clean.LOOKUP_TOOL}' THEN '' ELSE txt END AS new_text
                FROM (SELECT *, CASE tool WHEN '{_M}' THEN {O.markdown("given")} WHEN '{_H}' THEN {O.html("given")}
                                WHEN '{_E}' THEN {O.emoji("given")} WHEN '{_J}' THEN {O.escape("given")} ELSE '' END AS outcome
                      FROM (SELECT *, coalesce(tools[{i}], '-') AS tool, len(tools) >= {i} AND status = 'running' AS live,
                              coalesce(tools[{i}], '-') IN ({names}) AS cleaning,
                              CASE WHEN txt = '' THEN content ELSE txt END AS given FROM f_run{i - 1})))"""
    return O.sql(
        """SELECT doc_id, CASE WHEN status = 'running' THEN 'plan_end' ELSE status END AS status, len(done) AS rounds,
                  coalesce(nullif(array_to_string(done, ','), ''), '-') AS completed_tools,
                  CASE WHEN status = 'too_many_runs' THEN '(none)' ELSE coalesce(nullif(txt, ''), '(none)') END AS final_text
           FROM f_run9""",
        **ctes,
    )


@query(_run_sql())
def clean_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    ran = clean.extract(_planned(spark, sf_dir), "content", use_model=True)
    return ran.select(
        "doc_id",
        "status",
        F.col("rounds").cast("long").alias("rounds"),
        F.coalesce(F.nullif(F.array_join("completed_tools", ","), F.lit("")), F.lit("-")).alias("completed_tools"),
        F.coalesce("extraction_text", F.lit("(none)")).alias("final_text"),
    )


def _calls() -> Column:
    """Proposed tool calls of one event, in five mixes of listed and unlisted names."""
    k = F.col("event_id") % 5

    def call(name: str, n: int) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.create_map(F.lit("text"), F.col("event_type")).alias("args"),
            F.concat(F.lit(f"call-{n}-"), F.col("event_id").cast("string")).alias("id"),
        )

    none = F.array().cast("array<struct<name:string,args:map<string,string>,id:string>>")
    return (
        F.when(k == 0, F.array(call("translate", 1), call(_M, 2)))
        .when(k == 1, F.array(call(_H, 1), call(_E, 2)))
        .when(k == 2, F.array(call("translate", 1)))
        .when(k == 3, F.array(call(clean.LOOKUP_TOOL, 1)))
        .otherwise(none)
    )


@query(
    f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{_M}' WHEN 1 THEN '{_H}' WHEN 3 THEN '{clean.LOOKUP_TOOL}' ELSE '-' END AS tool,
          CASE event_id % 5 WHEN 0 THEN 'call-2-' || event_id WHEN 1 THEN 'call-1-' || event_id WHEN 3 THEN 'call-1-' || event_id
               ELSE '-' END AS call_id FROM events"""
)
def select_first_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    proposed = once(feeds.table(spark, sf_dir, "events").select("event_id", "event_type"), calls=_calls())
    chosen = proposed.withColumn("call", clean.first_allowed(F.col("calls")))
    return chosen.select(
        "event_id",
        F.coalesce("call.name", F.lit("-")).alias("tool"),
        F.coalesce("call.id", F.lit("-")).alias("call_id"),
    )


@query(
    """SELECT event_id, coalesce(nullif(CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '' END, ''),
                                 nullif(CASE event_id % 3 WHEN 0 THEN '' ELSE props END, ''), '(none)') AS final_text FROM events"""
)
def final_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    final = F.when(e % 4 == 0, F.col("event_type")).when(e % 4 == 1, "")
    current = F.when(e % 3 == 0, "").otherwise(F.col("props"))
    rows = feeds.table(spark, sf_dir, "events")
    return rows.select(
        "event_id", F.coalesce(clean.final_text(final, current), F.lit("(none)")).alias("final_text")
    )


@query(
    "SELECT doc_id, CASE doc_id % 9 "
    + " ".join(f"WHEN {k} THEN {O.lit(', '.join(t) or 'none')}" for k, t in TOOL_PLANS.items())
    + " END AS summary FROM documents"
)
def tool_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir).select("doc_id", clean.tool_summary(F.col("tools")).alias("summary"))
