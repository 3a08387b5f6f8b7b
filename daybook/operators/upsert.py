"""Keyed, idempotent upsert (C1-C6) and raw-table maintenance.

Set-wise replacement of an insert-or-update loop: every incoming row replaces the existing
row with the same natural key, column values taken from the incoming row *even when null*
(row-level choice, never a per-column coalesce). `ingested_at` survives from the first
insert; `updated_at` is set to the run time, except for tables where it is the source's value.

Plan choice (`strategy='auto'`): the bytes of the batch keys are summed in the tasks (one row a
task comes back); when they fit the bound, the existing table is streamed once against a broadcast
hash of the batch keys (no shuffle of the big side). Otherwise a full outer join on the keys,
which shuffles both sides; keys are unique per side after dedup, so no key can be hot. A caller
that has measured the batch passes the strategy in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_BYTES, fits_broadcast, row_bytes
from ..sources import storage

_MARK = "__incoming"


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with any null key part are rejected (returned as the second frame)."""
    ok: Column = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return df.where(ok), df.where(~ok)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """C4: one row per key, the row with the greatest `order` (the "later" row) wins.

    An aggregate (`max_by` over a struct), not a window: partial aggregation folds each
    task's rows before the shuffle, so a key holding a third of the batch never reaches a
    single task whole. `order` is the arrival order (a few small columns, unique in the batch); a
    single column is compared as it is.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    ordering = by[0] if len(by) == 1 else F.struct(*by)
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("__row"))
    return g.select(*keys, *[F.col("__row")[c].alias(c) for c in rest]).select(*df.columns)


def _ts(now: datetime | str) -> Column:
    return F.lit(str(now)).cast("timestamp_ntz")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    now: datetime | str,
    keep: Sequence[str] = ("ingested_at",),
    touch: Sequence[str] = ("updated_at",),
    strategy: str = "auto",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The table after applying `incoming` (already deduplicated, non-null keys).

    `keep` columns take the existing value for updated rows and `now` for new rows;
    `touch` columns are set to `now` on every applied row.
    """
    keys = list(keys)
    cols = existing.columns
    keep = [c for c in keep if c in cols]
    touch = [c for c in touch if c in cols]
    inc = incoming.select(*cols)
    for c in touch:
        inc = inc.withColumn(c, _ts(now))
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(inc.select(*keys), max_bytes) else "shuffle"

    if strategy == "broadcast":
        bkeys = F.broadcast(inc.select(*keys))
        untouched = existing.join(bkeys, keys, "left_anti")
        if keep:
            # existing values of the kept columns for the matched keys; the planner sees that this
            # side is one row a key of the batch at most and chooses the join
            kept = existing.join(bkeys, keys, "left_semi").select(
                *keys, *[F.col(c).alias(f"__old_{c}") for c in keep])
            applied = inc.join(kept, keys, "left")
            for c in keep:
                applied = applied.withColumn(c, F.coalesce(F.col(f"__old_{c}"), _ts(now)))
            applied = applied.select(*cols)
        else:
            applied = inc
        return untouched.unionByName(applied)

    if strategy != "shuffle":
        raise ValueError(f"unknown strategy {strategy}")
    o = existing.alias("o")
    i = inc.withColumn(_MARK, F.lit(True)).alias("i")
    cond = None
    for k in keys:
        e = F.col(f"o.{k}") == F.col(f"i.{k}")
        cond = e if cond is None else cond & e
    j = o.join(i, cond, "full_outer")
    hit = F.col(f"i.{_MARK}").isNotNull()
    out = []
    for c in cols:
        if c in keep:
            v = F.when(hit, F.coalesce(F.col(f"o.{c}"), _ts(now))).otherwise(F.col(f"o.{c}"))
        else:
            v = F.when(hit, F.col(f"i.{c}")).otherwise(F.col(f"o.{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def upsert_counts(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  max_bytes: int = BROADCAST_BYTES, small: bool | None = None) -> DataFrame:
    """One row `(inserted, updated)`: inserted = new distinct keys, updated = rows - inserted.

    The batch is folded per key first. When its keys pass the broadcast size check, the
    existing table's key columns stream once against a broadcast of them (semi-join, no
    shuffle of the big side) and only the matched keys are deduplicated. Beyond the bound,
    the folded batch is anti-joined against the existing keys with a shuffle on both sides. A caller
    that has measured the batch says whether it is `small`.
    """
    keys = list(keys)
    g = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    tot = g.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("nkeys"))
    bkeys = g.select(*keys)
    if fits_broadcast(bkeys, max_bytes) if small is None else small:
        matched = (existing.select(*keys).join(F.broadcast(bkeys), keys, "left_semi")
                   .distinct().agg(F.count(F.lit(1)).alias("m")).scalar())
        inserted = F.col("nkeys") - F.lit(matched)
    else:
        new = g.join(existing.select(*keys), keys, "left_anti")
        inserted = F.lit(new.agg(F.count(F.lit(1))).scalar())
    return tot.select(inserted.cast("bigint").alias("inserted"),
                      (F.col("rows") - inserted).cast("bigint").alias("updated"))


def purge(df: DataFrame, source: str | None = None) -> DataFrame:
    """A5: drop imported rows of one source (all rows when `source` is None)."""
    if source is None:
        return df.where(F.lit(False))
    return df.where(F.col("source").isNull() | (F.col("source") != source))


# ------------------------------------------------------------------ large raw tables

BUCKET = "key_bucket"
BUCKETS = 64
SWAP_MARK = "_swap_pending"   # under the table path; Parquet readers skip names starting with "_"
#: What becomes of a staged bucket: it replaces the table's, or its files are added to it.
STEP = "bucket_step"
REWRITE, APPEND = "rewrite", "append"
#: A bucket of so many files is rewritten by the next batch that adds to it, and is then one file.
MAX_FILES = 32
#: File-system calls that wait for the store at the same time.
CALLS = 16


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _pending_swap(spark, path: str) -> str | None:
    """The staging folder of a swap that began but never finished (left only by a crash)."""
    text = storage.read_text(spark, f"{path.rstrip('/')}/{SWAP_MARK}")
    return (text.strip() or None) if text else None


def _at_once(spark, calls: Sequence[Callable[[], None]]) -> None:
    """Independent file-system calls, `CALLS` at a time; the first error is raised."""
    with ThreadPoolExecutor(CALLS) as pool:
        for f in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]:
            f.result()


def _staged(spark, staging: str, step: str) -> list[str]:
    return [e.name for e in storage.entries(spark, f"{staging}/{STEP}={step}") if e.is_dir and e.name.startswith(f"{BUCKET}=")]


def _finish_swap(spark, staging: str, path: str) -> None:
    """Move staged buckets into the table, several at a time: `rewrite` replaces a bucket, `append` adds
    files to it (a bucket that isn't there is moved whole). Every step can be repeated: what has been moved
    is gone from the staging folder."""
    def rewrite(name: str) -> None:
        storage.delete(spark, f"{path}/{name}")
        storage.move(spark, f"{staging}/{STEP}={REWRITE}/{name}", f"{path}/{name}")

    def append(name: str) -> None:
        source = f"{staging}/{STEP}={APPEND}/{name}"
        if name not in there:
            storage.move(spark, source, f"{path}/{name}")
            return
        for f in storage.entries(spark, source):
            if f.name.startswith("part-"):  # unique names: every write has its own
                storage.delete(spark, f"{path}/{name}/{f.name}")  # what a lost driver left half moved
                storage.move(spark, f"{source}/{f.name}", f"{path}/{name}/{f.name}")

    _at_once(spark, [partial(rewrite, n) for n in _staged(spark, staging, REWRITE)])
    there = {e.name for e in storage.entries(spark, path)}
    _at_once(spark, [partial(append, n) for n in _staged(spark, staging, APPEND)])


def _swap(spark, staging: str, path: str) -> None:
    """Put a complete, committed staging folder into the table. The intent is marked first, so a
    swap cut short (driver lost) is redone by the next call."""
    mark = f"{path.rstrip('/')}/{SWAP_MARK}"
    storage.write_text(spark, mark, staging)
    _finish_swap(spark, staging, path)
    storage.delete(spark, mark)
    storage.delete(spark, staging)


def _full_buckets(spark, path: str, buckets: Sequence[int], max_files: int) -> set[int]:
    """The buckets that hold `max_files` files or more."""
    full: set[int] = set()

    def look(b: int) -> None:
        if sum(e.name.startswith("part-") for e in storage.entries(spark, f"{path}/{BUCKET}={b}")) >= max_files:
            full.add(b)

    _at_once(spark, [partial(look, b) for b in buckets])
    return full


def matched_by_bucket(existing: DataFrame, batch_keys: DataFrame, keys: Sequence[str],
                      broadcast: bool = True) -> DataFrame:
    """Per bucket of `existing`, the number of its keys present in `batch_keys` (buckets with a hit
    only). Reads the key columns alone; with `broadcast` (the batch keys' bytes were counted) the
    existing side streams without a shuffle. Existing keys are unique: hits = matched keys."""
    keys = list(keys)
    b = F.broadcast(batch_keys) if broadcast else batch_keys
    return (existing.select(*keys, BUCKET).join(b, keys, "left_semi")
            .groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")))


def upsert_partitioned(
    incoming: DataFrame,
    path: str,
    staging: str,
    keys: Sequence[str],
    now: datetime | str,
    keep: Sequence[str] = ("ingested_at",),
    touch: Sequence[str] = ("updated_at",),
    order: Sequence[str | Column] | None = None,
    buckets: int = BUCKETS,
    max_bytes: int = BROADCAST_BYTES,
    on_counts: Callable[[int, int], None] | None = None,
    max_files: int = MAX_FILES,
) -> tuple[int, int]:
    """C1 (+ C3) for large raw tables: a batch reads and writes only the buckets of its keys.

    The table at `path` is Parquet partitioned by a hash bucket of its natural key, so a key never
    moves, whatever its times; `buckets` is fixed when the table is made (a cluster takes
    thousands, so that one is a task's worth). The batch's buckets are listed (`buckets` rows at
    most, counted and measured by one job); of these the key columns are read and meet the batch keys.
    Buckets with a matched key, or of `max_files` files, are read, upserted and replaced; into the others
    the new rows are appended as new files. What is written is written once and by one job: staged, then moved.

    Rows with duplicate keys in `incoming` are folded by `order` (last wins) when given.
    `on_counts` is called with the counts before the table changes. Re-running a batch after a
    crash is idempotent, and an unfinished swap is completed first. Returns `(inserted, updated)`
    as C3.
    """
    spark = incoming.sparkSession
    keys = list(keys)
    path = path.rstrip("/")
    pending = _pending_swap(spark, path)
    if pending is not None:
        _swap(spark, pending, path)
    inc = incoming.withColumn(BUCKET, bucket_of(keys, buckets))
    folded = inc.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    per = {r[BUCKET]: r for r in folded.groupBy(BUCKET).agg(
        F.sum("__n").alias("rows"), F.count(F.lit(1)).alias("nkeys"), F.sum(row_bytes(folded.select(*keys))).alias("size")).collect()}
    rows, nkeys = sum(r["rows"] for r in per.values()), sum(r["nkeys"] for r in per.values())
    small = sum(r["size"] for r in per.values()) <= max_bytes
    strategy = "broadcast" if small else "shuffle"
    cols = [c for c in incoming.columns if c not in (order or ()) or not c.startswith("__")]
    inc = (dedup_last(incoming, keys, order) if order else incoming).select(*cols)

    there = {int(e.name.split("=", 1)[1]) for e in storage.entries(spark, path) if e.name.startswith(f"{BUCKET}=")}
    touched = sorted(there & set(per))
    hit: dict[int, int] = {}
    if touched:
        existing = spark.read.parquet(path)
        old = existing.where(F.col(BUCKET).isin(touched))
        hit = {r[BUCKET]: r["n"] for r in matched_by_bucket(old, folded.select(*keys), keys, small).collect()}
    inserted = nkeys - sum(hit.values())
    if on_counts is not None:
        on_counts(int(inserted), int(rows - inserted))
    again = sorted(set(hit) | _full_buckets(spark, path, touched, max_files))
    replaced = bucket_of(keys, buckets).isin(again)
    fresh = inc.where(~replaced) if again else inc
    staged = upsert(inc.where(F.lit(False)), fresh, keys, now, keep, touch, strategy=strategy).withColumn(STEP, F.lit(APPEND))
    if again:
        old = existing.where(F.col(BUCKET).isin(again)).select(*cols)
        merged = upsert(old, inc.where(replaced), keys, now, keep, touch, strategy=strategy)
        staged = staged.unionByName(merged.withColumn(STEP, F.lit(REWRITE)))
    (staged.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET)
     .write.mode("overwrite").partitionBy(STEP, BUCKET).parquet(staging))
    _swap(spark, staging, path)
    return int(inserted), int(rows - inserted)
