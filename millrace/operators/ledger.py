"""Run ledger: what happened to every record, stage by stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, is_blank, json_escape
from millrace.functions.plan import once
from millrace.operators import chunk, shape

STAGES = {"extraction": 1, "chunking": 2, "embedding": 3}


def outcome_rows(df: DataFrame, key: str, stage: str, succeeded) -> DataFrame:
    """Ledger rows of one stage: id, state, stage number."""
    state = F.when(succeeded, f"{stage}-succeeded").otherwise(f"{stage}-failed")
    return df.select(F.col(key).alias("id"), state.alias("state"), F.lit(STAGES[stage]).alias("stage_no"))


def append_outcomes(*stages: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), stages)


def newest_state(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("id").agg(
        F.max_by("state", "stage_no").alias("state"), F.count(F.lit(1)).alias("n_states")
    )


def stage_states(records: DataFrame, key: str) -> DataFrame:
    """All stage outcomes of a chained run in one pass, one row per record and stage reached.

    ``records`` needs the flags extracted, chunks_ok and request_ok.  The stages of one
    record are exploded from its own row, so the chain above is not run once per stage.
    """
    read, cut = F.col("extracted"), F.col("chunks_ok")
    states = F.array_compact(
        F.array(
            F.when(read, _state("extraction", F.lit(True))),
            F.when(read, _state("chunking", cut)),
            F.when(read & cut, _state("embedding", F.col("request_ok"))),
        )
    )
    return records.select(F.col(key).alias("id"), F.inline(states))


def _state(stage: str, succeeded):
    ok = F.coalesce(succeeded, F.lit(False))
    return F.struct(
        F.when(ok, f"{stage}-succeeded").otherwise(f"{stage}-failed").alias("state"),
        F.lit(STAGES[stage]).alias("stage_no"),
    )


def run_chain(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Extract, chunk and shape in one job: map-only from the record to its request.

    Cleaned text is chunked with real newlines, then escaped for publishing.
    """
    read = once(records, text=clean_text(F.col("content")))
    kept = read.filter(~is_blank(F.col("text")))
    chunked = chunk.with_chunks(kept, "text", limit)
    return shape.embedding_requests(chunked).withColumn("extraction_text", json_escape(F.col("text")))
