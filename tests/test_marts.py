import datetime as dt

from daybook.plans.build import Warehouse
from daybook.sources.schemas import RAW

D = dt.datetime


def warehouse(spark, commits=(), events=(), repos=()):
    def raw(name, rows):
        return spark.createDataFrame(list(rows), RAW[name])

    t = D(2024, 1, 1)
    rs = [("github", r, 1, r, "o", f"o/{r}", "py", t, False, t, t, "{}") for r in repos]
    cs = [("github", f"{r}:{i}", r, str(i), "a", "", ts, None, None, "m", t, t, "{}")
          for i, (r, ts) in enumerate(commits)]
    es = [("calendar", f"e{i}", "primary", "x", s, e, "UTC", 0, "confirmed", cat, t, t, "{}")
          for i, (s, e, cat) in enumerate(events)]
    return Warehouse({
        "raw_github_repositories": raw("raw_github_repositories", rs),
        "raw_github_commits": raw("raw_github_commits", cs),
        "raw_calendar_events": raw("raw_calendar_events", es),
    })


def test_dim_date_spine_and_attributes(spark):
    w = warehouse(spark, commits=[("r", D(2024, 12, 28)), ("r", D(2025, 1, 2))])
    rows = {r["date"]: r for r in w.dim_date.collect()}
    assert len(rows) == 6
    d30 = rows[dt.date(2024, 12, 30)]
    assert (d30["week"], d30["month"], d30["quarter"], d30["is_weekend"]) == ("2025-01", "2024-12", 4, False)
    assert rows[dt.date(2024, 12, 28)]["is_weekend"] and rows[dt.date(2024, 12, 29)]["is_weekend"]


def test_daily_activity_full_outer_and_gap_day(spark):
    w = warehouse(spark, commits=[("r", D(2024, 1, 1, 10))],
                  events=[(D(2024, 1, 2, 9), D(2024, 1, 2, 9, 30, 30), "meeting"),
                          (D(2024, 1, 4, 9), D(2024, 1, 4, 10), "work")])
    daily = {r["activity_date"]: tuple(r)[1:] for r in w.int_daily_activity.collect()}
    assert daily == {dt.date(2024, 1, 1): (1, 1, 0, 0), dt.date(2024, 1, 2): (0, 0, 31, 1)}
    mart = {r["date"]: tuple(r)[1:] for r in w.mart_daily_activity.collect()}
    assert len(mart) == 4 and mart[dt.date(2024, 1, 3)] == (0, 0, 0, 0)


def test_project_status(spark):
    mx = D(2024, 3, 1)
    w = warehouse(spark, repos=["a", "b", "c", "d"],
                  commits=[("a", mx), ("b", mx - dt.timedelta(days=14)), ("c", mx - dt.timedelta(days=15))])
    st = {r["name"]: (r["status"], r["commit_count"]) for r in w.mart_project_activity.collect()}
    assert st == {"a": ("active", 1), "b": ("active", 1), "c": ("stale", 1), "d": ("inactive", 0)}


def test_monthly_orphan_counts_commit_not_repo(spark):
    w = warehouse(spark, repos=["a"], commits=[("a", D(2024, 1, 5)), ("ghost", D(2024, 1, 6))])
    m = w.mart_monthly_summary.collect()
    assert [(r["month"], r["commits"], r["active_repos"], r["active_days"]) for r in m] == [("2024-01", 2, 1, 2)]
