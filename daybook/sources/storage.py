"""File-system calls on the shared store (any Hadoop-compatible one), through the session's
Hadoop configuration. The only place that touches the JVM: a session without one (Spark Connect)
would replace this module alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_dir: bool
    modified_ms: int


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What a folder holds, by name; nothing if it isn't there."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted((Entry(s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in fs.listStatus(p)),
                  key=lambda e: e.name)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the target must not exist, its parent is made."""
    fs, a = _open(spark, source)
    _, b = _open(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"can't move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _open(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it isn't there."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    ins = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(ins, "UTF-8")
    finally:
        ins.close()


def is_missing_path(error: Exception) -> bool:
    """Whether reading failed because the path isn't there (any other error must surface)."""
    condition = getattr(error, "getCondition", getattr(error, "getErrorClass", lambda: None))()
    return condition == "PATH_NOT_FOUND"
