"""Landed API pages (A1) and raw/mart storage (A2-A4).

Landing: one file per API page, JSON text. A page is a bare array (code hosting) or an
envelope with the list under `items` (calendar, listening history) or `messages` (mail).
Pages are bounded by the service's page size, so reading a page whole is safe; records
are exploded into rows and stay JSON text until normalised.

Storage: raw tables and marts are Parquet. A write never replaces the path being read:
each publish goes to a new snapshot directory, then a small pointer file names the current
one (readers resolve the pointer). A crash before the pointer moves leaves the old snapshot
current, so the run can simply be repeated.
"""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage
from .schemas import RAW

POINTER = "_pointers"
#: Its pointers name the snapshots of a whole set of tables.
RELEASE = "_releases"


#: Where a landed line stands: file time, file, block in the file, line in the block.
ARRIVAL = "__arrival"
#: Where a record stands: its page's arrival and its position on the page. Unique, and later
#: delivered records are greater.
SEQUENCE = "__sequence"


def with_arrival(df: DataFrame) -> DataFrame:
    """Rows of a file source (batch or stream, with its `_metadata`) with their arrival. Row
    numbers of a task follow the file's order within a block."""
    m = F.col("_metadata")
    return df.select("*", F.struct(
        m["file_modification_time"].alias("time"), m["file_path"].alias("file"),
        m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line")).alias(ARRIVAL))


def _list_of(payload: str, list_key: str | None):
    """The page's list as JSON text; the whole page if it is a bare list."""
    return F.col(payload) if list_key is None else F.get_json_object(payload, f"$.{list_key}")


def page_error(payload: str = "payload", list_key: str | None = None):
    """Why a page can't be read; null if it can. A page is its list, or an object whose list may be
    missing or null (no records). Cut text, an HTML error page or an error object in place of a
    list are errors, never an empty page."""
    text = F.trim(F.col(payload))
    if list_key is None:
        broken = F.json_array_length(payload).isNull()
        message = F.when(F.json_object_keys(payload).isNotNull(), "not a list").otherwise("not JSON")
    else:
        found = _list_of(payload, list_key)
        whole = F.json_object_keys(payload).isNotNull() & F.try_parse_json(payload).isNotNull()
        broken = ~whole | (found.isNotNull() & (found != "null") & F.json_array_length(found).isNull())
        message = F.when(whole, f"{list_key} is not a list").when(
            F.json_array_length(payload).isNotNull(), "not an object").otherwise("not JSON")
    return F.when(F.col(payload).isNotNull() & ((text == "") | broken), F.when(text == "", "empty page").otherwise(message))


def split_pages(df: DataFrame, payload_col: str = "payload", list_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(readable pages, pages that can't be read with their `_error`)."""
    e = df.withColumn("_error", page_error(payload_col, list_key))
    return e.where(F.col("_error").isNull()).drop("_error"), e.where(F.col("_error").isNotNull())


def flatten_pages(df: DataFrame, payload_col: str = "payload", list_key: str | None = None,
                  record_col: str = "record") -> DataFrame:
    """A1: one row per record (JSON text) of readable pages (see `split_pages`). Missing list, null
    page or `[]` -> no rows. Pages with an arrival give their records a sequence."""
    if list_key is None:
        arr = F.from_json(F.col(payload_col), T.ArrayType(T.StringType()))
    else:
        env = T.StructType([T.StructField(list_key, T.ArrayType(T.StringType()))])
        arr = F.from_json(F.col(payload_col), env)[list_key]
    keep = [c for c in df.columns if c not in (payload_col, ARRIVAL)]
    if ARRIVAL not in df.columns:
        return df.select(*keep, F.explode(arr).alias(record_col))
    out = df.select(*keep, ARRIVAL, F.posexplode(arr).alias("__pos", record_col))
    return out.select(*keep, record_col, F.struct(f"{ARRIVAL}.*", F.col("__pos").alias("position")).alias(SEQUENCE))


def read_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed pages -> (payload, arrival): one page per line, or one per file."""
    r = spark.read.option("wholetext", str(whole_files).lower()).option("recursiveFileLookup", "true").text(path)
    return with_arrival(r.withColumnRenamed("value", "payload")).select("payload", ARRIVAL)


def build_pages(records: DataFrame, record_col: str, page_key, list_key: str | None = None) -> DataFrame:
    """Group JSON records into page documents (fixture builder for landing data).

    `page_key` must bound the page size (e.g. id div 100 over unique ids), so no page group
    can grow with the data.
    """
    g = records.groupBy(page_key.alias("page")).agg(F.collect_list(record_col).alias("__r"))
    body = F.concat(F.lit("["), F.array_join("__r", ","), F.lit("]"))
    if list_key is not None:
        body = F.concat(F.lit('{"' + list_key + '":'), body, F.lit("}"))
    return g.select("page", body.alias("payload"))


# ------------------------------------------------------------------ storage

def _pointer_dir(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/{POINTER}"


def _write_pointer(spark: SparkSession, root: str, table: str, snapshot: str) -> None:
    """Append one pointer record `<time-ordered seq>\t<snapshot>` (never overwrites)."""
    seq = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    (spark.createDataFrame([(f"{seq}\t{snapshot}",)], "value string").coalesce(1)
     .write.mode("append").text(_pointer_dir(root, table)))


def current_snapshot(spark: SparkSession, root: str, table: str) -> str | None:
    """The snapshot named by the newest pointer record (one tiny job; None if never written). Any
    other failure to read the pointers is an error: taking it for "never written" would make the
    next batch start from an empty table."""
    try:
        p = spark.read.text(_pointer_dir(root, table))
    except AnalysisException as e:
        if storage.is_missing_path(e):
            return None
        raise
    v = p.agg(F.max("value")).first()[0]
    return v.split("\t", 1)[1] if v else None


def write_table(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> str:
    """A3/A4: write a new snapshot of `table` under `root`, then move the pointer to it.

    The data write commits first; only then is the pointer appended, so readers never see
    a half-written snapshot and the snapshot being read is never overwritten.
    """
    snap = write_snapshot(df, root, table, partition_by)
    _write_pointer(df.sparkSession, root, table, snap)
    return snap


def write_snapshot(df: DataFrame, root: str, table: str, partition_by: list[str] | None = None) -> str:
    """The data of a new snapshot; no reader sees it until a pointer names it."""
    snap = f"snap-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{root.rstrip('/')}/{table}/{snap}")
    return snap


#: Superseded snapshots stay this long for readers that still use them.
KEEP_SECONDS = 24 * 3600


def vacuum(spark: SparkSession, root: str, table: str, older_than: float = KEEP_SECONDS) -> list[str]:
    """Delete snapshots of `table` that were superseded at least `older_than` seconds ago (the next
    snapshot's name tells when; the current one always stays), and pointer files of that age except
    the newest. A reader has that long to finish. Returns the removed snapshots. File-system calls
    and one pointer read, no other Spark job."""
    base = f"{root.rstrip('/')}/{table}"
    snaps = [e.name for e in storage.entries(spark, base) if e.is_dir and e.name.startswith("snap-")]
    current = current_snapshot(spark, root, table)
    limit = time.time_ns() - int(older_than * 1e9)
    superseded = {a: int(b.split("-")[1]) for a, b in zip(snaps, snaps[1:], strict=False)}
    drop = [n for n in snaps if n != current and n in superseded and superseded[n] <= limit]
    for n in drop:
        storage.delete(spark, f"{base}/{n}")
    pointers = [e for e in storage.entries(spark, _pointer_dir(root, table)) if e.name.startswith("part-")]
    newest = max((e.modified_ms for e in pointers), default=0)
    for e in pointers:
        if e.modified_ms < newest and e.modified_ms * 1_000_000 <= limit:
            storage.delete(spark, f"{_pointer_dir(root, table)}/{e.name}")
    return drop


def read_table(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A2: the current snapshot of `table`; raw tables are read with their declared schema."""
    snap = current_snapshot(spark, root, table)
    if snap is None:
        raise FileNotFoundError(f"no snapshot of {table} under {root}")
    schema = schema if schema is not None else RAW.get(table)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/{table}/{snap}")


def stage(models: dict[str, DataFrame], root: str, threads: int = 1) -> dict[str, str]:
    """Write a snapshot of each model, `threads` at a time; returns their names. Nothing is visible yet."""
    with ThreadPoolExecutor(threads) as pool:
        snaps = pool.map(inheritable_thread_target(lambda name: write_snapshot(models[name], root, name)), models)
        return dict(zip(models, snaps, strict=True))


def staged(spark: SparkSession, root: str, snaps: dict[str, str], schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The tables of the named snapshots."""
    out = {}
    for name, snap in snaps.items():
        r = spark.read.schema(schemas[name]) if schemas else spark.read
        out[name] = r.parquet(f"{root.rstrip('/')}/{name}/{snap}")
    return out


def release(spark: SparkSession, root: str, snaps: dict[str, str]) -> None:
    """Make staged snapshots the current release: one pointer names all of them, so a reader of
    `read_release` never sees tables of two builds."""
    _write_pointer(spark, root, RELEASE, json.dumps(snaps, sort_keys=True))


def read_release(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """A2 of a whole set: the tables of the current release, by one look at its pointer."""
    found = current_snapshot(spark, root, RELEASE)
    if found is None:
        raise FileNotFoundError(f"no release under {root}")
    return staged(spark, root, json.loads(found))


def vacuum_releases(spark: SparkSession, root: str, older_than: float = KEEP_SECONDS) -> list[str]:
    """Delete snapshots that the current release doesn't name and that are older than it by `older_than`
    seconds; returns `table/snapshot`. What a build has staged but not released yet is newer, and stays."""
    current = json.loads(current_snapshot(spark, root, RELEASE) or "{}")
    drop = []
    for table, snap in current.items():
        limit = int(snap.split("-")[1]) - int(older_than * 1e9)
        drop += [f"{table}/{e.name}" for e in storage.entries(spark, f"{root.rstrip('/')}/{table}")
                 if e.is_dir and e.name.startswith("snap-") and e.name != snap and int(e.name.split("-")[1]) < limit]
    for name in drop:
        storage.delete(spark, f"{root.rstrip('/')}/{name}")
    return drop
