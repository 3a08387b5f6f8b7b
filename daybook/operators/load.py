"""The load path of one raw table, the same for batch runs and micro-batches:

pages -> records with their arrival -> normalised rows -> rejects to a stored quarantine
(unreadable pages, malformed records, null keys) -> last delivered row of each key -> upsert, with
`updated_at` left to the source where it is the source's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_BYTES, size_of, staged
from ..sources import landing as L
from ..sources.schemas import KEYS, RAW, SOURCE_UPDATED_AT
from . import upsert as U
from .normalize import split_malformed, to_raw

QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("raw_table", "kind", "reason", "payload")])


@dataclass(frozen=True)
class Feed:
    """How one raw table's pages are read: the list's key in a page (None: the page is the list) and
    the normaliser of its records."""

    table: str
    normalize: Callable[[DataFrame], DataFrame]
    list_key: str | None = None
    #: Of feeds that share their pages: the condition on the records (JSON text) that are this one's.
    takes: Callable[[], Column] | None = None

    @property
    def keys(self) -> list[str]:
        return list(KEYS[self.table])

    @property
    def touch(self) -> tuple[str, ...]:
        return () if self.table in SOURCE_UPDATED_AT else ("updated_at",)


@dataclass(frozen=True)
class Counts:
    fetched: int      # records on readable pages
    inserted: int
    updated: int
    failed: int       # rejected records and unreadable pages


@dataclass
class Batch:
    """A batch that has been read: rows in raw shape (with their sequence), the unreadable pages and
    malformed records as they came (with their context columns), and all that was rejected."""

    rows: DataFrame
    broken: DataFrame
    bad: DataFrame
    rejected: DataFrame
    fetched: int
    failed: int
    release: Callable[[], None]


def read_batch(pages: DataFrame, feed: Feed, now: str, payload_col: str = "payload") -> Batch:
    """Parse a batch of pages once (kept for the few jobs over it, until `release`)."""
    readable, broken = L.split_pages(pages, payload_col, feed.list_key)
    return _parsed(L.flatten_pages(readable, payload_col, feed.list_key), broken, feed, now, payload_col)


def read_batches(pages: DataFrame, feeds: Sequence[Feed], now: str, payload_col: str = "payload") -> list[Batch]:
    """Feeds over the same pages, a batch each. Pages are split and cut into records once, and a record goes
    to the first feed that takes it. An unreadable page is rejected once, in the first feed's batch. What is
    parsed is staged: a run asks for it so often that planning over its lineage would take longest."""
    readable, broken = L.split_pages(pages, payload_col, feeds[0].list_key)
    broken = staged(broken, "broken")
    records = L.flatten_pages(readable, payload_col, feeds[0].list_key)
    if len(feeds) == 1:
        return [_parsed(records, broken, feeds[0], now, payload_col, stage=True)]
    route = F.coalesce(*[F.when(f.takes(), k) for k, f in enumerate(feeds)])
    records = staged(records.withColumn("_route", route), "records")
    out = []
    for k, f in enumerate(feeds):
        batch = _parsed(records.where(F.col("_route") == k).drop("_route"), broken if k == 0 else broken.where(F.lit(False)), f, now, payload_col,
                        stage=True)
        out.append(batch)
    return out


def _parsed(records: DataFrame, broken: DataFrame, feed: Feed, now: str, payload_col: str, stage: bool = False) -> Batch:
    normal = feed.normalize(records)
    normal = staged(normal, feed.table) if stage else normal.persist(StorageLevel.MEMORY_AND_DISK)
    good, bad = split_malformed(normal)
    rows, keyless = U.split_null_keys(to_raw(good, feed.table, now), feed.keys)

    def rejects(df: DataFrame, kind: str, reason, payload: str) -> DataFrame:
        return df.select(F.lit(feed.table).alias("raw_table"), F.lit(kind).alias("kind"), reason.alias("reason"),
                         F.col(payload).alias("payload"))

    rejected = (rejects(broken, "page", F.col("_error"), payload_col)
                .unionByName(rejects(bad, "record", F.col("_error"), "raw_payload"))
                .unionByName(rejects(keyless, "key", F.lit("null key"), "raw_payload")))
    # One job over the parsed batch, each branch read once. Its results are exact: what Observation counts
    # is counted again where a lost executor's stage is run again.
    keys = [F.col(k).cast(RAW[feed.table][k].dataType) for k in feed.keys]
    failed = F.col("_error").isNotNull() | F.greatest(*[k.isNull() for k in keys], F.lit(False))
    n = (normal.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(failed).alias("failed"))
         .unionAll(broken.agg(F.lit(0).cast("long"), F.count(F.lit(1)))).agg(F.sum("fetched"), F.sum("failed")).first())
    return Batch(rows, broken, bad, rejected, int(n[0]), int(n[1]), lambda: None if stage else normal.unpersist())


def store_rejected(batch: Batch, root: str, batch_id: object) -> None:
    """The batch's rejects, in a folder of their own: a replay writes the same again."""
    batch.rejected.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch={batch_id}")


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).option("recursiveFileLookup", "true").parquet(root)


def fold(rows: DataFrame, feed: Feed) -> DataFrame:
    """C4 by arrival: of a key's rows the one delivered last."""
    if L.SEQUENCE not in rows.columns:
        return rows
    return U.dedup_last(rows, feed.keys, [L.SEQUENCE]).drop(L.SEQUENCE)


def apply_rows(existing: DataFrame, rows: DataFrame, feed: Feed, now: str) -> tuple[DataFrame, int, int]:
    """(the table after the batch, inserted, updated), nothing written. The batch is measured once."""
    small = size_of(rows.select(*feed.keys))[1] <= BROADCAST_BYTES
    c = U.upsert_counts(existing, rows, feed.keys, small=small).first()
    table = U.upsert(existing, fold(rows, feed), feed.keys, now, touch=feed.touch, strategy="broadcast" if small else "shuffle")
    return table, int(c["inserted"]), int(c["updated"])


def apply_batch(pages: DataFrame, feed: Feed, path_root: str, now: str, *, batch_id: object, scratch: str,
                quarantine: str | None = None, partitioned: bool = True, payload_col: str = "payload",
                on_counts: Callable[[Counts], None] | None = None) -> Counts:
    """Read a batch of landed pages and load it into `path_root/<table>`.

    `partitioned`: the bucketed Parquet table of `upsert_partitioned`; otherwise the snapshot chain.
    Rejects are stored under `quarantine` before the table changes, and `on_counts` gets the counts
    then, so what is recorded is the first attempt's even if the batch is replayed.
    """
    spark = pages.sparkSession
    batch = read_batch(pages, feed, now, payload_col)
    counted: list[Counts] = []

    def tell(inserted: int, updated: int) -> None:
        counted.append(Counts(batch.fetched, inserted, updated, batch.failed))
        if quarantine is not None:
            store_rejected(batch, quarantine, batch_id)
        if on_counts is not None:
            on_counts(counted[0])

    try:
        if partitioned:
            U.upsert_partitioned(batch.rows, f"{path_root.rstrip('/')}/{feed.table}", scratch, feed.keys, now,
                                 touch=feed.touch, order=[L.SEQUENCE], on_counts=tell)
        else:
            try:
                existing = L.read_table(spark, path_root, feed.table)
            except FileNotFoundError:
                existing = spark.createDataFrame([], RAW[feed.table])
            table, inserted, updated = apply_rows(existing, batch.rows, feed, now)
            tell(inserted, updated)
            L.write_table(table, path_root, feed.table)
            L.vacuum(spark, path_root, feed.table)
    finally:
        batch.release()
    return counted[0]
