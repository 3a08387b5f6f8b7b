"""Session helpers: configuration the library relies on, lineage cuts, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound (bytes, as counted by `size_of`) of a data-dependent side that may be broadcast.
BROADCAST_BYTES = 64 << 20


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[*]", partitions: int = 8, app: str = "daybook") -> SparkSession:
    """Session used by tests and the bench. A cluster passes its own session instead."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin what the models need on a session we may not own.

    Timestamps are kept as TIMESTAMP_NTZ holding UTC wall time; the only zone-dependent
    steps (ISO-8601 with offsets, local time + zone) are computed under a UTC session zone.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # keys of a streaming dedup stay on disk, not on the heap
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stream checkpoints.

    The cluster names it in `spark.checkpoint.dir`; only when unset (local tests) a fresh
    scratch directory is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint root. Nothing is made here: the writer
    makes it, through the filesystem that the root's scheme names."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written under the checkpoint root and read back: several jobs start from it, and none plans or
    runs what came before again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of `df`: those of the text columns, 8 for each other one, and 16 a row."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t in ("string", "binary")]
    fixed = 16 + 8 * (len(df.columns) - len(wide))
    return sum(wide, F.lit(fixed)).cast("long")


def size_of(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of `df`: one aggregate, summed in the tasks."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when `df` takes at most `max_bytes`."""
    return size_of(df)[1] <= max_bytes
