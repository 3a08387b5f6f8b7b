import datetime as dt
import json

from pyspark.sql import functions as F

from daybook.operators import normalize as N
from daybook.sources import landing as L


def records(spark, *objs, extra=None):
    rows = [(o if isinstance(o, str) else json.dumps(o),) for o in objs]
    return spark.createDataFrame(rows, "record string")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def event(id_, start=None, end=None, **kw):
    return {"id": id_} | ({"start": start, "end": end} if start else {}) | kw


def test_calendar_times(spark):
    """Hand-computed: Kolkata is +05:30 all year, Auckland +13:00 in January, Lima -05:00."""
    out = N.normalize_calendar(records(
        spark,
        event("offset", {"dateTime": "2023-01-20T18:45:00+05:30"}, {"dateTime": "2023-01-20T20:00:00+05:30"},
              summary="Budget triage", attendees=[{"email": str(k)} for k in range(3)]),
        event("zone", {"dateTime": "2023-01-20T08:15:00", "timeZone": "Pacific/Auckland"},
              {"dateTime": "2023-01-20T09:15:00", "timeZone": "America/Lima"}),
        event("nowhere", {"dateTime": "2023-01-20T08:15:00", "timeZone": "Moon/Base"},
              {"dateTime": "2023-01-20T09:15:00", "timeZone": "Moon/Base"}),
        event("days", {"date": "2023-01-20", "timeZone": "Asia/Kolkata"}, {"date": "2023-01-22", "timeZone": "Asia/Kolkata"}),
        event("gone", status="cancelled")), "primary")
    r = {x["source_id"]: x for x in rows_of(out)}
    assert all(x["_error"] is None for x in r.values())
    assert (r["offset"]["start_at"], r["offset"]["end_at"]) == (dt.datetime(2023, 1, 20, 13, 15), dt.datetime(2023, 1, 20, 14, 30))
    assert (r["offset"]["category"], r["offset"]["attendees_count"], r["offset"]["status"]) == ("meeting", 3, "confirmed")
    # each end has its own zone
    assert (r["zone"]["start_at"], r["zone"]["end_at"]) == (dt.datetime(2023, 1, 19, 19, 15), dt.datetime(2023, 1, 20, 14, 15))
    assert r["nowhere"]["start_at"] == dt.datetime(2023, 1, 20, 8, 15)
    # whole days: local midnights; the end date counts (a day is added), in the start's zone
    assert (r["days"]["start_at"], r["days"]["end_at"]) == (dt.datetime(2023, 1, 19, 18, 30), dt.datetime(2023, 1, 22, 18, 30))
    assert r["days"]["timezone"] == "Asia/Kolkata"
    g = r["gone"]
    assert [g[k] for k in ("start_at", "end_at", "title", "attendees_count", "category", "timezone")] == [None, None, "", 0, "other", "UTC"]


def test_calendar_missing_end_is_quarantined(spark):
    bad = {"id": "x", "start": {"dateTime": "2024-06-01T09:00:00Z"}, "end": {}}
    good, quarantined = N.split_malformed(N.normalize_calendar(records(spark, bad), "primary"))
    assert good.count() == 0
    assert quarantined.first()["_error"] == "missing end.dateTime"


EPOCH_MS, EPOCH = "1673000000500", dt.datetime(2023, 1, 6, 10, 13, 20, 500000)


def test_email_headers_and_defaults(spark):
    heads = [("Subject", "draft title"), ("From", "kim@example.org"), ("X-Spam", "no"), ("Subject", "final title")]
    out = N.normalize_emails(records(
        spark,
        {"id": "all", "threadId": "th", "internalDate": EPOCH_MS, "snippet": "see below",
         "payload": {"headers": [{"name": k, "value": v} for k, v in heads], "body": {"data": "private words"}}},
        {"id": "least", "internalDate": EPOCH_MS}, {"id": "empty", "internalDate": EPOCH_MS, "payload": {}},
        {"id": "when", "internalDate": "last week"}, {"id": "half", "internalDate": EPOCH_MS, "payload": {"headers": [{"name": "To"}]}},
        "<mail/>"))
    good, bad = N.split_malformed(out)
    r = {x["source_id"]: x for x in rows_of(good)}
    assert set(r) == {"all", "least", "empty"} and r["all"]["date"] == EPOCH
    assert (r["all"]["sender"], r["all"]["subject"], r["all"]["recipients"]) == ("kim@example.org", "final title", "")
    assert (r["least"]["thread_id"], r["least"]["sender"], r["least"]["snippet"], r["empty"]["subject"]) == ("", "", "", "")
    assert "private" not in str([v for x in r.values() for k, v in x.items() if k != "raw_payload"])
    assert sorted(x["_error"] for x in rows_of(bad)) == ["bad internalDate", "header without value", "not a JSON object"]


def test_plays_artists_and_keys(spark):
    def play(minute, **track):
        return {"played_at": f"2023-01-06T10:{minute:02}:00.250Z", "track": track}

    r = rows_of(N.normalize_plays(records(spark, play(5, id="k9", name="Tide", artists=[{"name": "Oru"}, {"name": "Bel Canto"}]),
                                          play(6, id="k9"), play(7, id=None))))
    assert [x["artists"] for x in r] == ["Oru, Bel Canto", "", ""]
    # a null part of the key leaves no key, so that such rows can't meet each other
    assert [x["source_id"] for x in r] == ["k9:2023-01-06T10:05:00.250Z", "k9:2023-01-06T10:06:00.250Z", None]
    assert r[1]["track_name"] == ""


def test_repo_absent_vs_null_defaults(spark):
    base = {"id": 1, "name": "r", "owner": {"login": "o"}, "full_name": "o/r",
            "created_at": "2024-01-15T10:30:00Z"}
    absent = dict(base)
    explicit = dict(base, id=2, full_name="o/s", archived=None, language=None)
    r = {x["source_id"]: x for x in rows_of(N.normalize_repos(records(spark, absent, explicit)))}
    assert r["o/r"]["archived"] is False
    assert r["o/s"]["archived"] is None and r["o/s"]["language"] is None
    assert r["o/r"]["created_at"] == dt.datetime(2024, 1, 15, 10, 30)


def test_commit_email_default_and_key(spark):
    c = {"sha": "abc", "commit": {"author": {"name": "A", "email": None, "date": "2024-06-01T00:00:00Z"},
                                   "message": "m"}}
    df = records(spark, c).selectExpr("'o/r' AS repo", "record")
    r = rows_of(N.normalize_commits(df, "repo", "repo"))[0]
    assert (r["source_id"], r["author_email"], r["additions"], r["_error"]) == ("o/r:abc", "", None, None)


def test_issue_pr_split_mixed_page(spark):
    base = {"number": 1, "title": "t", "state": "open", "created_at": "2024-06-01T00:00:00Z",
            "updated_at": "2024-06-02T00:00:00Z"}
    items = [dict(base, node_id="i1"), dict(base, node_id="p1", pull_request={"url": "u", "merged_at": None}),
             dict(base, node_id="i2", user=None, comments=None)]
    df = records(spark, *items).selectExpr("'o/r' AS repo", "record")
    issues, prs = N.split_issues_prs(df)
    ri = {x["source_id"]: x for x in rows_of(N.normalize_issues(issues, "repo"))}
    rp = rows_of(N.normalize_prs(prs, "repo"))
    assert set(ri) == {"i1", "i2"} and [x["source_id"] for x in rp] == ["p1"]
    assert ri["i1"]["comments_count"] == 0 and ri["i2"]["comments_count"] is None
    assert ri["i2"]["author"] is None and ri["i1"]["closed_at"] is None
    assert rp[0]["is_draft"] is False and rp[0]["merged_at"] is None


def test_flatten_pages_shapes(spark):
    pages = spark.createDataFrame(
        [('[{"a": 1}, {"a": 2}]',), ("[]",), ('{"items": [{"a": 3}], "nextPageToken": "x"}',),
         ('{"nextPageToken": null}',)], "payload string")
    arrays = spark.createDataFrame([('[{"a": 1}, {"a": 2}]',), ("[]",)], "payload string")
    assert L.flatten_pages(arrays, "payload").count() == 2
    env = L.flatten_pages(pages, "payload", "items")
    assert [r["record"] for r in env.collect()] == ['{"a":3}']


def test_a_filter_on_the_error_does_not_parse_again(spark):
    """The filter of the well-formed rows stays above the one parse of a record."""
    d = spark.range(3).select(F.concat(F.lit('{"id":"'), F.col("id").cast("string"), F.lit('"}')).alias("record"))
    good, bad = N.split_malformed(N.normalize_calendar(d, "primary"))
    for part in (good, bad):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
        assert all("from_json" not in line and "JsonExpression" not in line for line in plan.split("\n") if "Filter" in line)
    assert good.count() + bad.count() == 3
