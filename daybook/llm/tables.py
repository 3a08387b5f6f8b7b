"""Reading the given tables, and tables written once so that later jobs start from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Text bytes an operator works on at once inside a task; bounds its numpy arrays.
CHUNK_BYTES = 1 << 21
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator uses, as `doc_id` long and `text` string."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that `docs` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    name = f"_{name}"
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read back: computed once, lineage cut. The shuffle
    files of the write go when it ends, not when the driver next collects garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Chunk:
    """Some whole texts of an Arrow batch: their UTF-8 bytes (8 bytes padding) and offsets."""

    def __init__(self, first: int, last: int, buf: np.ndarray, offs: np.ndarray):
        self.first, self.last, self.buf, self.offs = first, last, buf, offs
        self.n = last - first

    def raw(self, i: int) -> bytes:
        return self.buf[self.offs[i]:self.offs[i + 1]].tobytes()

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offs)


def chunks(texts: pa.Array, target: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a text column (null: empty) into chunks of about `target` bytes; texts stay whole."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    n = len(texts)
    if n == 0:
        return
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, dtype=np.int32, count=n + 1 + texts.offset)[texts.offset:].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + target, side="right")) - 1)
        j = min(j, n)
        size = int(offs[j] - offs[i])
        buf = np.zeros(size + 8, np.uint8)
        buf[:size] = body[offs[i]:offs[j]]
        yield Chunk(i, j, buf, offs[i:j + 1] - offs[i])
        i = j
