"""Properties of the load path over a whole driver table."""

from pyspark.sql import functions as F

from daybook.operators import upsert as U
from daybook.sources import bindings as B

K = ["source", "source_id"]
NOW = "2024-06-01 00:00:00"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_batches_equal_one_full_load(spark, sf):
    raw = B.raw_commits(spark, sf)
    empty = raw.where(F.lit(False))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    first, second = raw.where(F.col("committed_at") < cut), raw.where(F.col("committed_at") >= cut)
    stepwise = U.upsert(U.upsert(empty, first, K, NOW), second, K, NOW)
    full = U.upsert(empty, raw, K, NOW)
    assert rows(stepwise) == rows(full)
    assert full.count() == raw.count()


def test_batch_order_irrelevant_across_disjoint_keys(spark, sf):
    raw = B.raw_commits(spark, sf)
    base = raw.where(F.lit(False))
    a = raw.where(F.col("author_name") == "1-URGENT")
    b = raw.where(F.col("author_name") != "1-URGENT")
    ab = U.upsert(U.upsert(base, a, K, NOW), b, K, NOW)
    ba = U.upsert(U.upsert(base, b, K, NOW), a, K, NOW)
    assert rows(ab) == rows(ba)


def test_replaying_a_batch_changes_nothing(spark, sf):
    raw = B.raw_commits(spark, sf)
    once = U.upsert(raw.where(F.lit(False)), raw, K, NOW, strategy="shuffle")
    twice = U.upsert(once, raw, K, NOW, strategy="shuffle")
    assert rows(once) == rows(twice)
    c = U.upsert_counts(once, raw, K).first()
    assert (c["inserted"], c["updated"]) == (0, raw.count())
