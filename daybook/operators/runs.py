"""Run audit (E1-E3): one `pipeline_runs` row per run, the status rule, the latest runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import trunc_second
from ..sources.schemas import PIPELINE_RUNS


def status_col(failed: Column | str, aborted: Column | str | bool = False) -> Column:
    """Abort -> 'failed'; any failed entity -> 'partial'; else 'success'."""
    f = F.col(failed) if isinstance(failed, str) else failed
    a = F.lit(aborted) if isinstance(aborted, bool) else (F.col(aborted) if isinstance(aborted, str) else aborted)
    return F.when(a, "failed").when(f > 0, "partial").otherwise("success")


def run_row(metrics: DataFrame, source: str, started: datetime | str, finished: datetime | str,
            run_id: Column | None = None, aborted: bool = False,
            error_message: str | None = None) -> DataFrame:
    """The audit row of one run from a one-row metrics frame with columns
    `fetched, inserted, updated, failed` (e.g. counts computed by Spark jobs).

    `run_id` defaults to a random UUID (non-deterministic, so keep it out of comparisons).
    """
    rid = run_id if run_id is not None else F.expr("uuid()")
    return metrics.select(
        rid.alias("run_id"), F.lit(source).alias("source"),
        F.lit(str(started)).cast("timestamp_ntz").alias("started_at"),
        F.lit(str(finished)).cast("timestamp_ntz").alias("finished_at"),
        status_col(F.col("failed"), aborted).alias("status"),
        F.col("fetched").cast("int").alias("records_fetched"),
        F.col("inserted").cast("int").alias("records_inserted"),
        F.col("updated").cast("int").alias("records_updated"),
        F.col("failed").cast("int").alias("records_failed"),
        F.lit(error_message).cast("string").alias("error_message"),
    ).select(*PIPELINE_RUNS.fieldNames())


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The latest `n` runs by start time (top-k, a `TakeOrderedAndProject`), start
    truncated to seconds; `run_id` breaks ties so the pick is deterministic."""
    return (runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)
            .select("run_id", "source", "status", trunc_second("started_at").alias("started_at"),
                    "records_fetched", "records_inserted", "records_updated", "records_failed"))
