import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import upsert as U

SCHEMA = "source string, source_id string, v string, n int, ingested_at timestamp_ntz, updated_at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)
NOW = "2024-06-01 00:00:00"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_upsert_replaces_rows_even_with_null(spark, strategy):
    ex = frame(spark, [("g", "a", "old", 1, T0, T0), ("g", "b", "keep", 2, T0, T0)])
    inc = frame(spark, [("g", "a", None, 5, None, None), ("g", "c", "new", 3, None, None)])
    out = {r["source_id"]: r for r in U.upsert(ex, inc, ["source", "source_id"], NOW, strategy=strategy).collect()}
    now = dt.datetime(2024, 6, 1)
    assert out["a"]["v"] is None and out["a"]["n"] == 5          # null overwrites
    assert out["a"]["ingested_at"] == T0 and out["a"]["updated_at"] == now
    assert out["b"]["v"] == "keep" and out["b"]["updated_at"] == T0
    assert out["c"]["ingested_at"] == now
    assert len(out) == 3


def test_strategies_agree_and_upsert_is_idempotent(spark):
    ex = frame(spark, [("g", str(i), f"v{i}", i, T0, T0) for i in range(50)])
    inc = frame(spark, [("g", str(i), f"w{i}", -i, None, None) for i in range(40, 70)])
    k = ["source", "source_id"]
    b = U.upsert(ex, inc, k, NOW, strategy="broadcast")
    s = U.upsert(ex, inc, k, NOW, strategy="shuffle")
    assert table(b) == table(s)
    twice = U.upsert(b, inc, k, NOW, strategy="broadcast")
    assert table(twice) == table(b)


def test_counts_replay_and_in_batch_duplicates(spark):
    k = ["source", "source_id"]
    ex = frame(spark, [("g", "a", "x", 1, T0, T0)])
    inc = frame(spark, [("g", "a", "y", 1, None, None), ("g", "b", "y", 1, None, None)])
    c = U.upsert_counts(ex, inc, k).first()
    assert (c["inserted"], c["updated"]) == (1, 1)
    c = U.upsert_counts(ex, inc, k, max_bytes=0).first()      # shuffle form
    assert (c["inserted"], c["updated"]) == (1, 1)
    dup = frame(spark, [("g", "z", "first", 1, None, None), ("g", "z", "second", 2, None, None)])
    c = U.upsert_counts(ex, dup, k).first()
    assert (c["inserted"], c["updated"]) == (1, 1)
    last = U.dedup_last(dup, k, ["n"]).collect()
    assert [r["v"] for r in last] == ["second"]


def test_replay_second_run_updates_only(spark):
    k = ["source", "source_id"]
    batch = frame(spark, [("g", "a", "x", 1, None, None), ("g", "b", "y", 2, None, None)])
    empty = batch.where(F.lit(False))
    first = U.upsert(empty, batch, k, NOW)
    c = U.upsert_counts(first, batch, k).first()
    assert (c["inserted"], c["updated"]) == (0, 2)
    assert U.upsert(first, batch, k, NOW).count() == 2


def test_null_keys_rejected(spark):
    df = frame(spark, [("g", None, "x", 1, None, None), ("g", "a", "y", 1, None, None)])
    good, bad = U.split_null_keys(df, ["source", "source_id"])
    assert good.count() == 1 and bad.count() == 1


def test_purge(spark):
    df = spark.createDataFrame([("gmail", "1"), ("spotify", "2")], "source string, source_id string")
    assert [r["source"] for r in U.purge(df, "gmail").collect()] == ["spotify"]
    assert U.purge(df).count() == 0


def bucket_files(path):
    """Bucket -> its data files (name, modification time)."""
    import os

    return {d: sorted((f, os.path.getmtime(f"{path}/{d}/{f}")) for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith(f"{U.BUCKET}=")}


K = ["source", "source_id"]


def seeded(spark, tmp_path, n=40, buckets=16):
    path = str(tmp_path / "t")
    base = frame(spark, [("g", f"k{i}", f"v{i}", i, T0, T0) for i in range(n)])
    assert U.upsert_partitioned(base, path, str(tmp_path / "s0"), K, NOW, keep=(), touch=(), buckets=buckets) == (n, 0)
    return path, {r["source_id"]: f"{U.BUCKET}={r[U.BUCKET]}" for r in spark.read.parquet(path).collect()}


def test_batch_rewrites_only_its_buckets_and_appends_pure_inserts(spark, tmp_path):
    path, bucket = seeded(spark, tmp_path)
    before = bucket_files(path)
    new = next(f"n{i}" for i in range(500) if bucket["k3"] != (
        b := f"{U.BUCKET}={spark.range(1).select(U.bucket_of([F.lit('g'), F.lit(f'n{i}')], 16)).first()[0]}") and b in before)
    inc = frame(spark, [("g", "k3", "w", -3, None, None), ("g", new, "z", 3, None, None)])
    assert U.upsert_partitioned(inc, path, str(tmp_path / "s1"), K, NOW, buckets=16) == (1, 1)
    out = {r["source_id"]: r for r in spark.read.parquet(path).collect()}
    assert len(out) == 41 and out["k3"]["v"] == "w" and out["k3"]["ingested_at"] == T0
    assert out[new]["ingested_at"] == dt.datetime(2024, 6, 1)
    after, home = bucket_files(path), f"{U.BUCKET}={out[new][U.BUCKET]}"
    assert not set(before[bucket["k3"]]) & set(after[bucket["k3"]])             # replaced
    assert set(before[home]) < set(after[home])                                  # appended to
    assert all(after[b] == before[b] for b in before if b not in (bucket["k3"], home))


def test_partitioned_agrees_with_the_plain_upsert(spark, tmp_path):
    path, _ = seeded(spark, tmp_path)
    inc = frame(spark, [("g", f"k{i}", None, -i, None, None) for i in range(30, 60)])
    plain = U.upsert(frame(spark, [("g", f"k{i}", f"v{i}", i, T0, T0) for i in range(40)]), inc, K, NOW)
    assert U.upsert_partitioned(inc, path, str(tmp_path / "s1"), K, NOW, buckets=16, max_bytes=0) == (20, 10)
    assert table(spark.read.parquet(path).drop(U.BUCKET)) == table(plain)


def test_partitioned_upsert_folds_duplicates_and_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = frame(spark, [("g", "a", "first", 1, None, None), ("g", "a", "second", 2, None, None),
                          ("g", "b", "y", 1, None, None)])
    told = []
    assert U.upsert_partitioned(batch, path, str(tmp_path / "s1"), K, NOW, order=["n"],
                                on_counts=lambda *c: told.append(c)) == (2, 1)
    once = table(spark.read.parquet(path))
    assert U.upsert_partitioned(batch, path, str(tmp_path / "s2"), K, NOW, order=["n"]) == (0, 3)
    assert table(spark.read.parquet(path)) == once and told == [(2, 1)]         # idempotent
    assert {r["v"] for r in spark.read.parquet(path).collect()} == {"second", "y"}


def test_buckets_of_many_files_are_merged(spark, tmp_path):
    """Batches of new keys append files, until a bucket holds `max_files`: then it is one file again."""
    path = str(tmp_path / "t")
    most = 0
    for i in range(7):
        batch = frame(spark, [("g", f"{i}-{j}", "v", j, None, None) for j in range(6)])
        assert U.upsert_partitioned(batch, path, str(tmp_path / f"s{i}"), K, NOW, buckets=2, max_files=3) == (6, 0)
        files = [len(x) for x in bucket_files(path).values()]
        most = max(most, *files)
        assert all(1 <= n <= 3 for n in files)
    assert most == 3
    out = spark.read.parquet(path).collect()
    assert len(out) == 42 and len({r["source_id"] for r in out}) == 42
    assert all(r["ingested_at"] == dt.datetime(2024, 6, 1) for r in out)


def test_half_moved_append_is_finished(spark, tmp_path):
    """A store that copies on rename can leave a file in both places when the driver is lost."""
    import os
    import shutil

    path, _ = seeded(spark, tmp_path, buckets=1)
    stage = str(tmp_path / "s1")
    new = frame(spark, [("g", "n1", "z", 3, None, None)])
    new.withColumn(U.STEP, F.lit(U.APPEND)).withColumn(U.BUCKET, F.lit(0)).write.partitionBy(U.STEP, U.BUCKET).parquet(stage)
    source = f"{stage}/{U.STEP}={U.APPEND}/{U.BUCKET}=0"
    part = next(f for f in os.listdir(source) if f.startswith("part-"))
    shutil.copy(f"{source}/{part}", f"{path}/{U.BUCKET}=0/{part}")
    U.storage.write_text(spark, f"{path}/{U.SWAP_MARK}", stage)
    assert U.upsert_partitioned(new, path, str(tmp_path / "s2"), K, NOW, buckets=1) == (0, 1)
    out = spark.read.parquet(path)
    assert out.count() == 41 and out.where("source_id = 'n1'").count() == 1


@pytest.mark.parametrize("moved", [0, 1])
def test_interrupted_swap_is_finished_by_the_next_call(spark, tmp_path, monkeypatch, moved):
    """The driver is lost before any, or after one of the staged buckets was moved."""
    import os

    path, _ = seeded(spark, tmp_path)
    stage = str(tmp_path / "s1")
    inc = frame(spark, [("g", f"k{i}", "w", -i, None, None) for i in range(10)])
    done, real = [], U.storage.move

    def cut(*a):
        if len(done) == moved:
            raise RuntimeError("driver lost")
        done.append(real(*a))

    with monkeypatch.context() as m:
        m.setattr(U.storage, "move", cut)
        m.setattr(U, "CALLS", 1)  # one after another, so that the cut comes after so many
        with pytest.raises(RuntimeError):
            U.upsert_partitioned(inc, path, stage, K, NOW, buckets=16)
    assert U._pending_swap(spark, path) == stage
    assert U.upsert_partitioned(inc, path, str(tmp_path / "s2"), K, NOW, buckets=16) == (0, 10)
    assert U._pending_swap(spark, path) is None and not os.path.exists(stage)
    out = {r["source_id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert out == {f"k{i}": "w" if i < 10 else f"v{i}" for i in range(40)}


def test_vacuum_goes_by_age(spark, tmp_path):
    from daybook.sources import landing as L

    root = str(tmp_path)
    df = frame(spark, [("g", "a", "x", 1, T0, T0)])
    snaps = [L.write_table(df, root, "t") for _ in range(4)]
    assert L.vacuum(spark, root, "t") == []                                      # a reader may still be on them
    assert L.vacuum(spark, root, "t", older_than=0) == snaps[:3]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("snap-")) == snaps[3:]
    assert table(L.read_table(spark, root, "t", df.schema)) == table(df)     # current still readable
    assert L.vacuum(spark, root, "t", older_than=0) == []


def test_unreadable_pointer_is_an_error(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from daybook.sources import landing as L

    assert L.current_snapshot(spark, str(tmp_path), "never") is None
    df = frame(spark, [("g", "a", "x", 1, T0, T0)])
    L.write_table(df, str(tmp_path), "t")

    class Denied(AnalysisException):
        def __init__(self):
            pass

        def getCondition(self):
            return "FAILED_READ_FILE"

    def refuse(*_):
        raise Denied()

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark.read), "text", refuse)
        with pytest.raises(AnalysisException):
            L.current_snapshot(spark, str(tmp_path), "t")
