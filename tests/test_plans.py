"""Plan checks: pruning reaches the scan, small batches broadcast, no Python in plans."""

import contextlib
import io

import __spark_entry__ as E
from daybook.operators import upsert as U


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scans(p: str, name: str) -> int:
    return sum(f"{name}.parquet" in line for line in p.splitlines() if line.startswith("Location"))


def test_mart_scan_is_pruned(spark, sf):
    """The per-day commits read 2 of the 6 columns of orders, once."""
    from daybook.plans.build import Warehouse
    p = plan(Warehouse.from_driver(spark, sf).commits_daily)
    orders = [line for line in p.splitlines() if "ReadSchema" in line and "o_orderdate" in line]
    assert len(orders) == 1, p
    assert all("o_totalprice" not in line and "o_orderstatus" not in line for line in orders)


def test_daily_models_read_the_shared_results(spark, sf):
    for name in ("mart_daily_activity", "weekly_activity", "activity_between", "meeting_stats", "weekday_distribution", "mart_sink"):
        p = plan(E.queries()[name](spark, sf))
        assert "orders.parquet" not in p and "lineitem.parquet" not in p, name
    for name in ("mart_monthly_summary", "month_over_month"):
        p = plan(E.queries()[name](spark, sf))
        assert scans(p, "orders") == 1 and scans(p, "lineitem") == 0, name


def test_commits_are_folded_before_they_meet_repositories(spark, sf):
    for name in ("mart_project_activity", "language_mix", "first_last_activity", "project_share"):
        df = E.queries()[name](spark, sf)
        join, below = False, df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        for line in below:
            join |= "Join" in line
            if join and "Aggregate" in line:
                break
            assert not (join and "orders.parquet" in line), name


def test_cursor_bound_reaches_the_scan(spark, sf):
    p = plan(E.queries()["incremental_by_entity"](spark, sf))
    assert any("PushedFilters" in line and "GreaterThanOrEqual(o_orderdate" in line or
               "PartitionFilters" in line and "subquery" in line or "DataFilters" in line and "scalar-subquery" in line
               for line in p.splitlines()) or "o_orderdate" in p and "Subquery" in p


def test_size_check_sends_no_keys_to_one_task(spark, sf):
    """Sizes are summed in the tasks: what meets in one task is one row each."""
    from daybook import session
    from daybook.queries_load import commits_incoming

    import pytest

    seen, keys = [], commits_incoming(spark, sf).select("source", "source_id")
    real = type(keys).agg

    def watch(self, *a):
        out = real(self, *a)
        seen.append(plan(out))
        return out

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(keys), "agg", watch)
        n, size = session.size_of(keys)
    assert n > 0 and size > n * 16
    assert all("partial_count" in p and "LocalLimit" not in p for p in seen)


def test_filter_is_pushed_to_scan(spark, sf):
    p = plan(E.queries()["window_backfill"](spark, sf))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p, p


def test_small_batch_upsert_broadcasts(spark, sf):
    from daybook.queries_load import commits_existing, commits_incoming
    p = plan(U.upsert(commits_existing(spark, sf), commits_incoming(spark, sf),
                      ["source", "source_id"], "2001-09-01 00:00:00"))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_dedup_is_an_aggregate_not_a_window(spark, sf):
    p = plan(E.queries()["last_wins_dedup"](spark, sf))
    assert "Window " not in p and "Window(" not in p
    assert "partial_max_by" in p          # map-side combine before the exchange


def test_models_have_no_python_udfs(spark, sf):
    from daybook.queries import _MODEL_QUERIES
    for name in _MODEL_QUERIES:
        p = plan(E.queries()[name](spark, sf))
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_partitioned_upsert_reads_only_the_batchs_buckets(spark, tmp_path):
    """The scan of a bucketed raw table reads the key columns of the touched buckets and meets the
    broadcast batch keys without shuffling the existing side."""
    import datetime as dt

    from pyspark.sql import functions as F

    jan = dt.datetime(2024, 1, 5)
    rows = [("g", str(i), "v", i, jan, jan) for i in range(60)]
    schema = "source string, source_id string, v string, n int, ingested_at timestamp_ntz, updated_at timestamp_ntz"
    path, keys = str(tmp_path / "t"), ["source", "source_id"]
    U.upsert_partitioned(spark.createDataFrame(rows, schema), path, str(tmp_path / "s"), keys,
                         "2024-01-10 00:00:00", keep=(), touch=(), buckets=16)
    batch = spark.createDataFrame([("g", "3")], "source string, source_id string")
    b = batch.select(U.bucket_of(keys, 16).alias("b")).first()["b"]
    t = U.matched_by_bucket(spark.read.parquet(path).where(F.col(U.BUCKET).isin([b])), batch, keys)
    p = plan(t)
    assert "BroadcastHashJoin LeftSemi BuildRight" in p, p
    assert f"PartitionFilters: [isnotnull({U.BUCKET}" in p and f"= {b})" in p, p
    assert "ReadSchema: struct<source:string,source_id:string>" in [line for line in p.splitlines() if line.startswith("ReadSchema")]
    assert [tuple(r) for r in t.collect()] == [(b, 1)]
