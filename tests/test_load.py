"""The load path: arrival order, source-owned times, rejects and replays."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daybook.operators import load
from daybook.operators import normalize as N
from daybook.operators import runs as E
from daybook.operators import sync as SY
from daybook.operators import upsert as U
from daybook.sources import landing as L
from daybook.sources.schemas import RAW, SYNC_STATE
from daybook.streaming import ingest as S

NOW = "2024-03-01 00:00:00"
CALENDAR = load.Feed("raw_calendar_events", lambda d: N.normalize_calendar(d, "primary"), "items")
ISSUES = load.Feed("raw_github_issues", lambda d: N.normalize_issues(d.withColumn("r", F.lit("o/r")), "r"))
MAIL = load.Feed("raw_gmail_messages", N.normalize_emails, "messages")
COMMITS = load.Feed("raw_github_commits", lambda d: N.normalize_commits(d, "repo_full_name", "repo_source_id"))


def land(path, *pages):
    """One file per page, in the order given."""
    import os
    import time

    os.makedirs(path, exist_ok=True)
    for k, p in enumerate(pages):
        name = f"{path}/page-{time.time_ns()}-{k}.json"
        with open(name, "w") as f:
            f.write(p if isinstance(p, str) else json.dumps(p))
        os.utime(name, (1_700_000_000 + 60 * len(os.listdir(path)),) * 2)
    return str(path)


def loaded(spark, tmp_path, feed, *pages, name="t", **kw):
    src = land(tmp_path / f"land-{name}", *pages)
    c = load.apply_batch(L.read_pages(spark, src), feed, str(tmp_path / "raw"), NOW, batch_id=name,
                         scratch=str(tmp_path / f"stage-{name}"), quarantine=str(tmp_path / "bad"), **kw)
    if kw.get("partitioned", True):
        out = S.read_partitioned(spark, str(tmp_path / "raw"), feed.table, RAW[feed.table])
    else:
        out = L.read_table(spark, str(tmp_path / "raw"), feed.table)
    return c, {r["source_id"]: r for r in out.collect()}


def issue(state, updated, node="n1", **kw):
    return {"node_id": node, "number": 1, "title": "t", "state": state, "created_at": "2024-01-01T00:00:00Z", "updated_at": updated, **kw}


EVENT = {"id": "e1", "status": "confirmed", "summary": "walk", "start": {"dateTime": "2024-02-03T07:00:00Z"},
         "end": {"dateTime": "2024-02-03T08:00:00Z"}}


@pytest.mark.parametrize("partitioned", [True, False])
def test_later_delivery_wins_within_a_batch(spark, tmp_path, partitioned):
    c, rows = loaded(spark, tmp_path, CALENDAR, {"items": [EVENT, {"id": "e1", "status": "cancelled"}]}, partitioned=partitioned)
    assert rows["e1"]["status"] == "cancelled" and rows["e1"]["start_at"] is None
    assert (c.fetched, c.inserted, c.updated, c.failed) == (2, 1, 1, 0)
    c, rows = loaded(spark, tmp_path, ISSUES, [issue("open", "2024-02-02T00:00:00Z"), issue("closed", "2024-02-01T00:00:00Z")],
                     name="i", partitioned=partitioned)
    assert rows["n1"]["state"] == "closed" and rows["n1"]["updated_at"] == dt.datetime(2024, 2, 1)


def test_later_file_wins(spark, tmp_path):
    _, rows = loaded(spark, tmp_path, CALENDAR, {"items": [{"id": "e1", "status": "cancelled"}]}, {"items": [EVENT]})
    assert rows["e1"]["status"] == "confirmed" and rows["e1"]["title"] == "walk"


def test_source_time_stays_and_run_time_is_set_elsewhere(spark, tmp_path):
    _, rows = loaded(spark, tmp_path, ISSUES, [issue("open", "2024-01-20T05:00:00Z")])
    assert rows["n1"]["updated_at"] == dt.datetime(2024, 1, 20, 5) and rows["n1"]["ingested_at"] == dt.datetime(2024, 3, 1)
    _, rows = loaded(spark, tmp_path, CALENDAR, {"items": [EVENT]}, name="c")
    assert rows["e1"]["updated_at"] == dt.datetime(2024, 3, 1)


def test_null_keys_never_reach_the_table(spark, tmp_path):
    mail = [{"id": None, "internalDate": "1700000000000"}, {"id": "m", "internalDate": "1700000000000"}]
    for k in range(3):
        c, rows = loaded(spark, tmp_path, MAIL, {"messages": mail}, name=f"d{k}")
        assert list(rows) == ["m"] and c.failed == 1
    bad = load.read_rejected(spark, str(tmp_path / "bad")).collect()
    assert [(r["kind"], r["reason"]) for r in bad] == [("key", "null key")] * 3


def test_rejects_are_stored_with_their_reason(spark, tmp_path):
    header = {"id": "h", "internalDate": "1700000000000", "payload": {"headers": [{"name": "From"}]}}
    pages = ['{"messages": [{"id": "x", "inter', "<html>504</html>", '{"error": {"code": 500}}',
             {"messages": [header, {"id": "t", "internalDate": "noon"}, {"id": "ok", "internalDate": "1700000000000"}]}]
    c, rows = loaded(spark, tmp_path, MAIL, *pages)
    assert list(rows) == ["ok"] and (c.fetched, c.failed) == (3, 4)
    got = sorted((r["kind"], r["reason"]) for r in load.read_rejected(spark, str(tmp_path / "bad")).collect())
    assert got == [("page", "not JSON"), ("page", "not JSON"), ("record", "bad internalDate"), ("record", "header without value")]


@pytest.mark.parametrize("text", ["10:30:00", "2024", "2024-06", "24-06-01T00:00:00Z", "2024-06-01T00:00:00Zulu"])
def test_half_a_timestamp_is_no_timestamp(spark, text):
    rec = json.dumps({"played_at": text, "track": {"id": "t"}})
    out = N.normalize_plays(spark.createDataFrame([(rec,)], "record string")).first()
    assert out["_error"] == "bad played_at"


def test_replayed_batch_keeps_its_first_audit_row(spark, tmp_path):
    root = str(tmp_path / "audit")

    def tell(c):
        S.write_audit(spark, root, 7, c)

    for k in range(2):
        loaded(spark, tmp_path, CALENDAR, {"items": [EVENT]}, name=f"r{k}", on_counts=tell)
    row = S.read_audit(spark, root).collect()
    assert [(r["batch_id"], r["records_inserted"], r["records_updated"], r["status"]) for r in row] == [(7, 1, 0, "success")]


def commit(sha, when):
    return {"sha": sha, "commit": {"author": {"name": "a", "email": None, "date": when}, "message": "m"}}


def github(spark, pages, state=None, full=False):
    repos = spark.createDataFrame([("github", r, r) for r in ("o/a", "o/b", "o/c")], "source string, source_id string, name string")
    p = spark.createDataFrame([(r, r, json.dumps(x) if not isinstance(x, str) else x, k) for k, (r, x) in enumerate(pages)],
                              "repo_full_name string, repo_source_id string, payload string, n long")
    p = p.withColumn(L.ARRIVAL, F.struct("n")).drop("n")
    return SY.sync_entities("github", p, [COMMITS], "committed_at",
                            {COMMITS.table: spark.createDataFrame([], RAW[COMMITS.table])},
                            state or spark.createDataFrame([], SYNC_STATE), repos, repos.where("source_id <> 'o/c'"), NOW,
                            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), full)


def test_repository_sync_skips_failed_entities(spark):
    run = github(spark, [("o/a", [commit("1", "2024-02-01T00:00:00Z"), commit("2", "2023-01-01T00:00:00Z")]),
                         ("o/b", [commit("3", "2024-02-02T00:00:00Z"), commit("4", "noon")]), ("o/c", "<html>")])
    a = run.audit.first()
    # three repositories (one new) and the one commit that is new enough; two repositories failed
    assert (a["status"], a["records_fetched"], a["records_inserted"], a["records_updated"], a["records_failed"]) == ("partial", 4, 2, 2, 2)
    assert [r["source_id"] for r in run.tables[COMMITS.table].collect()] == ["o/a:1"]
    assert [(r["entity_key"], r["last_cursor"]) for r in run.state.collect()] == [("o/a", "2024-02-01T00:00:00+00:00")]
    again = github(spark, [("o/a", [commit("1", "2024-02-01T00:00:00Z"), commit("5", "2024-01-20T00:00:00Z")])], run.state)
    assert [r["source_id"] for r in again.tables[COMMITS.table].collect()] == ["o/a:1"]      # at the cursor, not before it
    everything = github(spark, [("o/a", [commit("1", "2024-02-01T00:00:00Z"), commit("5", "2020-01-20T00:00:00Z")])], run.state, full=True)
    assert everything.tables[COMMITS.table].count() == 2


def test_aborted_run_is_recorded(spark):
    r = SY.aborted(spark, "gmail", NOW, RuntimeError("rate limit")).first()
    assert (r["status"], r["error_message"], r["records_fetched"]) == ("failed", "rate limit", 0)


def test_an_error_that_ends_a_sync_leaves_its_audit_row(spark, tmp_path, monkeypatch):
    from daybook import queries_sync as Q

    real, runs = SY.sync_single, []

    def limited(*args, **kw):
        runs.append(args)
        if len(runs) == 2:
            raise RuntimeError("rate limit")
        return real(*args, **kw)

    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(SY, "sync_single", limited)
    pages = spark.createDataFrame([('{"messages": []}', (0,))], f"payload string, {L.ARRIVAL} struct<page: long>")
    with pytest.raises(RuntimeError, match="rate limit"):
        Q._two_runs(spark, "gmail", MAIL, pages, pages, F.lit(True), lambda last: F.lit(True), ts="date")
    rows = spark.read.parquet(str(tmp_path / "audit")).orderBy("started_at").collect()
    assert [(r["source"], r["status"], r["error_message"]) for r in rows] == [("gmail", "success", None), ("gmail", "failed", "rate limit")]


def test_the_error_is_raised_when_no_audit_row_can_be_written(spark, tmp_path):
    (tmp_path / "file").write_text("")
    with pytest.raises(ValueError, match="bad page"):
        with SY.recorded(spark, "gmail", NOW, str(tmp_path / "file" / "audit")):
            raise ValueError("bad page")


def test_recent_runs_and_status(spark):
    rows = SY.aborted(spark, "a", NOW, ValueError("x")).unionByName(SY._audit("b", "2024-04-01 00:00:00", 3, 2, 1, 0, spark))
    assert [(r["source"], r["status"]) for r in E.recent_runs(rows, 1).collect()] == [("b", "success")]


def test_upsert_of_nothing(spark):
    empty = spark.createDataFrame([], RAW["raw_spotify_plays"])
    assert U.upsert(empty, empty, ["source", "source_id"], NOW).count() == 0
