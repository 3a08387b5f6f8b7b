"""The ingest as Structured Streaming (M1-M4).

Landed files are the stream source; the checkpoint replaces the cursor table (a file is read
once per checkpoint). Each micro-batch goes through the load path of `operators.load` inside
`foreachBatch`: re-delivery of a batch after a failure, or of a file landed twice, is absorbed by
the keyed upsert, so the sink is effectively exactly-once. `trigger(availableNow=True)` drains what
has landed and stops (the nightly-sync shape).

Checkpoints and outputs live under the shared folder named by `spark.checkpoint.dir`.
"""

from __future__ import annotations

from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import load
from ..operators import upsert as U
from ..operators.runs import status_col
from ..session import scratch_path
from ..sources import landing as L
from ..sources import storage

AUDIT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("records_fetched", T.LongType()),
    T.StructField("records_inserted", T.LongType()), T.StructField("records_updated", T.LongType()),
    T.StructField("records_failed", T.LongType()), T.StructField("status", T.StringType())])


def page_stream(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    """Landed text files (one page a line) as a stream of (payload, arrival)."""
    s = (spark.readStream.schema("value string").option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", files_per_trigger).text(path))
    return s.select(F.col("value").alias("payload"), F.col("_metadata"))


def write_audit(spark: SparkSession, audit_root: str, batch_id: int, c: load.Counts) -> None:
    """One audit row per batch, once: a replay finds the row of the first attempt and leaves it
    (its own counts would call every row an update)."""
    path = f"{audit_root.rstrip('/')}/batch={batch_id}"
    if storage.exists(spark, f"{path}/_SUCCESS"):
        return
    row = spark.createDataFrame([(batch_id, c.fetched, c.inserted, c.updated, c.failed)],
                                "batch_id long, records_fetched long, records_inserted long, "
                                "records_updated long, records_failed long")
    row.withColumn("status", status_col(F.col("records_failed"))).coalesce(1).write.mode("overwrite").parquet(path)


def stream_upsert(
    stream: DataFrame,
    feed: load.Feed,
    target_root: str,
    checkpoint: str,
    now: str,
    audit_root: str | None = None,
    quarantine_root: str | None = None,
    partitioned: bool = True,
) -> None:
    """M1 (+ M4): stream of pages (`page_stream`) -> load path per micro-batch, one audit row and the
    rejects of each batch. Runs until the landed files are drained.

    `partitioned`: one Parquet table in key buckets, of which a batch reads and rewrites only its
    own; otherwise a snapshot chain (each batch publishes the whole table atomically).
    """
    def per_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        pages = L.with_arrival(df).drop("_metadata")

        def audit(c: load.Counts) -> None:
            if audit_root is not None:
                write_audit(spark, audit_root, batch_id, c)

        load.apply_batch(pages, feed, target_root, now, batch_id=batch_id, quarantine=quarantine_root,
                         scratch=scratch_path(spark, f"stage-{feed.table}"), partitioned=partitioned,
                         on_counts=audit)

    q = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_partitioned(spark: SparkSession, target_root: str, table: str,
                     schema: T.StructType) -> DataFrame:
    """The table written by a `partitioned=True` sink, in its declared schema."""
    return spark.read.parquet(f"{target_root.rstrip('/')}/{table}").select(*schema.fieldNames())


def read_audit(spark: SparkSession, audit_root: str) -> DataFrame:
    """Audit rows, one per batch id."""
    return spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").parquet(audit_root)


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """M2: drop re-read records by natural key within the watermark delay. The event time
    must be TIMESTAMP (not NTZ) for a watermark. Rows more than the delay behind the newest one are
    dropped here; `keep_late` brings them into the late table."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_daily(stream: DataFrame, ts: str, delay: str, purchase_type: str = "purchase") -> DataFrame:
    """M3: per-day counts kept up to date (window + watermark); counts and sums only, since
    distinct counts are not supported in a streaming aggregate."""
    return (stream.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.count(F.when(F.col("event_type") == purchase_type, 1)).alias("purchases")))


def stream_day_activity(commits: DataFrame, meetings: DataFrame, delay: str) -> DataFrame:
    """M3 as the whole of J1, append mode: a day's row comes once the watermark has passed its end.

    Commits (committed_at, repository_source_id) are counted per (day, repository), and these counts per
    day, so the distinct repositories are exact and no state holds a list of them; meetings (start_at,
    duration_minutes) are folded per day. The two meet in a stream-stream full outer join on the day.
    Rows without a time have no day here. Times must be TIMESTAMP (not NTZ).
    """
    day = F.window("committed_at", "1 day").alias("day")
    each = commits.withWatermark("committed_at", delay).groupBy(day, "repository_source_id").agg(F.count(F.lit(1)).alias("n"))
    c = each.groupBy(F.window("day", "1 day").alias("day")).agg(
        F.sum("n").alias("commit_count"), F.count("repository_source_id").alias("active_repositories"))
    m = meetings.withWatermark("start_at", delay).groupBy(F.window("start_at", "1 day").alias("day")).agg(
        F.sum("duration_minutes").alias("meeting_minutes"), F.count(F.lit(1)).alias("meeting_count"))
    counts = ("commit_count", "active_repositories", "meeting_minutes", "meeting_count")
    return c.join(m, "day", "full_outer").select(
        F.to_date("day.start").alias("activity_date"), *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in counts])


def run_to_parquet(df: DataFrame, out: str, checkpoint: str) -> int:
    """Append-mode sink of a streaming frame to Parquet, draining what has landed. Returns how many rows its
    stateful operators dropped as late, as the progress of its batches says."""
    with _Dropped(df.sparkSession) as late:
        q = (df.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return late.of(q)


class _Dropped(StreamingQueryListener):
    """Rows that stateful operators dropped behind the watermark, by query run (all batches, however many)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows, self.ended = spark, {}, {}

    def __enter__(self) -> _Dropped:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def of(self, q: StreamingQuery) -> int:
        """The rows of a query that has ended; its events come on a thread of their own."""
        self.ended.setdefault(str(q.runId), Event()).wait(60)
        return self.rows.get(str(q.runId), 0)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event())

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        self.rows[run] = self.rows.get(run, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()


LATE_AUDIT = T.StructType([
    T.StructField("run", T.StringType()), T.StructField("records_landed", T.LongType()),
    T.StructField("records_passed", T.LongType()), T.StructField("records_late", T.LongType()),
    T.StructField("rows_dropped", T.LongType())])


def keep_late(spark: SparkSession, landed: DataFrame, out: str, late: str, keys: Sequence[str], run: str, dropped: int,
              audit: str) -> None:
    """What the watermark dropped isn't lost: records that have landed but are neither in the output nor in the
    late table are added to the late table (one a key), and counted in the audit row of the run. `dropped`
    also counts re-deliveries of records that had passed before."""
    keys = list(keys)
    passed = spark.read.schema(landed.schema).parquet(out)
    known = passed.select(*keys)
    if storage.exists(spark, late):
        known = known.unionByName(spark.read.schema(landed.schema).parquet(late).select(*keys))
    lost = landed.join(known, keys, "left_anti").dropDuplicates(keys)
    lost.write.mode("append").parquet(late)
    n_late = spark.read.schema(landed.schema).parquet(late).count()
    row = spark.createDataFrame([(run, landed.count(), passed.count(), n_late, dropped)], LATE_AUDIT)
    row.coalesce(1).write.mode("overwrite").parquet(f"{audit.rstrip('/')}/run={run}")


def read_late_audit(spark: SparkSession, audit: str) -> DataFrame:
    """Totals after each run (rows dropped: in that run)."""
    return spark.read.schema(LATE_AUDIT).option("recursiveFileLookup", "true").parquet(audit)


def run_update_upsert(df: DataFrame, keys: Sequence[str], root: str, table: str,
                      schema: T.StructType, checkpoint: str, now: str) -> None:
    """Update-mode sink: each batch's changed rows (one a key) replace their keys in `table`."""
    def per_batch(b: DataFrame, _batch_id: int) -> None:
        spark = b.sparkSession
        try:
            existing = L.read_table(spark, root, table, schema)
        except FileNotFoundError:
            existing = spark.createDataFrame([], schema)
        L.write_table(U.upsert(existing, b, keys, now), root, table)
        L.vacuum(spark, root, table)

    q = (df.writeStream.outputMode("update").foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
