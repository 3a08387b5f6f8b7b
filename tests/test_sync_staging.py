from daybook.operators import load
from daybook.operators import normalize as N


def test_batches_of_shared_pages_do_not_keep_the_parse(spark):
    pages = spark.createDataFrame([("[]", "1", (1,)), ("{}", "2", (2,))], "payload string, repo_source_id string, __arrival struct<page:int>")
    feeds = [load.Feed("raw_github_issues", lambda d: N.normalize_issues(d, "repo_source_id"), takes=lambda: ~N.is_pull_request("record")),
             load.Feed("raw_github_pull_requests", lambda d: N.normalize_prs(d, "repo_source_id"), takes=lambda: N.is_pull_request("record"))]
    for batch in load.read_batches(pages, feeds, "2024-01-01 00:00:00"):
        for part in (batch.rows, batch.bad, batch.broken):
            assert "from_json" not in part._jdf.queryExecution().analyzed().toString()
        batch.release()
