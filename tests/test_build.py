"""The whole warehouse built, checked and published by one pointer; one parse for feeds that share pages."""

import pytest
from pyspark.sql import functions as F

from daybook.operators import load
from daybook.operators import normalize as N
from daybook.plans.build import MART_MODELS, VIEW_MODELS, FailedChecks, Warehouse
from daybook.sources import landing as L


def _report(failures):
    return lambda w: w.mart_daily_activity.limit(1).select(
        F.lit("unique").alias("check"), F.lit("mart_daily_activity").alias("model"), F.lit("date").alias("column"), F.lit(failures).alias("failures"))


def test_a_failed_build_leaves_the_release_before(spark, sf, tmp_path):
    root = str(tmp_path / "marts")
    with pytest.raises(FileNotFoundError):
        L.read_release(spark, root)
    with pytest.raises(FailedChecks):
        Warehouse.from_driver(spark, sf).build(root, _report(3))
    with pytest.raises(FileNotFoundError):
        L.read_release(spark, root)
    Warehouse.from_driver(spark, sf).build(root, _report(0))
    first = {name: df.inputFiles() for name, df in L.read_release(spark, root).items()}
    assert set(first) == set(MART_MODELS)
    with pytest.raises(FailedChecks) as e:
        Warehouse.from_driver(spark, sf).build(root, _report(3))
    assert e.value.failures == [("unique", "mart_daily_activity", "date", 3)]
    assert {name: df.inputFiles() for name, df in L.read_release(spark, root).items()} == first
    assert all(spark.table(name).columns for name in VIEW_MODELS)
    again = Warehouse.from_driver(spark, sf).build(root)
    now = {name: df.inputFiles() for name, df in L.read_release(spark, root).items()}
    assert all(not set(now[x]) & set(first[x]) for x in MART_MODELS)  # no table of the build before
    assert {x: sorted(df.inputFiles()) for x, df in again.items()} == {x: sorted(v) for x, v in now.items()}
    assert L.vacuum_releases(spark, root) == [] and len(L.vacuum_releases(spark, root, 0)) == 3 * len(MART_MODELS)
    assert L.read_release(spark, root)["mart_daily_activity"].count() == again["mart_daily_activity"].count()


ISSUE = '{"node_id":"%s","number":1,"title":"t","state":"open","created_at":"2024-01-01T00:00:00Z","updated_at":"2024-01-02T00:00:00Z"%s}'


def test_feeds_that_share_pages_are_parsed_once(spark):
    pages = spark.createDataFrame([
        (1, "[" + ISSUE % ("a", "") + "," + ISSUE % ("b", ',"pull_request":{"merged_at":null}') + "]"),
        (2, '{"message": "Not Found"}'), (3, "[" + ISSUE % ("c", "") + ",17]"), (4, "[]")], "page int, payload string")
    pages = pages.select("payload", F.lit("o/r").alias("repo"), F.struct("page").alias(L.ARRIVAL))
    feeds = [load.Feed("raw_github_issues", lambda d: N.normalize_issues(d, "repo"), takes=lambda: ~N.is_pull_request("record")),
             load.Feed("raw_github_pull_requests", lambda d: N.normalize_prs(d, "repo"), takes=lambda: N.is_pull_request("record"))]
    issues, prs = load.read_batches(pages, feeds, "2024-02-01 00:00:00")
    assert sorted(r["source_id"] for r in issues.rows.collect()) == ["a", "c"]
    assert [r["source_id"] for r in prs.rows.collect()] == ["b"]
    rejected = issues.rejected.unionByName(prs.rejected).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in rejected} == {"page": 1, "record": 1}
    assert (issues.fetched, issues.failed, prs.fetched, prs.failed) == (3, 2, 1, 0)
    for b in (issues, prs):
        b.release()


def test_the_feed_is_scanned_once(spark, sf):
    from daybook.queries import queries

    plan = queries()["split_issue_pr"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
