"""Analytics over the marts (N1-N9), as the warehouse's own spec describes them.

Most read per-day or per-month marts, whose size is the number of calendar days or months,
not the data volume. Those over commits take them folded per repository (partial aggregation at
the scan) before anything is joined; totals come from scalar subqueries instead of
unpartitioned windows, except the month-over-month lag, whose input is one row per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .marts import resolve_fk


def _between(c: str, start: str, end: str):
    return F.col(c).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def weekly_activity(mart_daily: DataFrame, dim: DataFrame) -> DataFrame:
    """The daily mart rolled up to ISO weeks."""
    j = mart_daily.join(dim.select("date", "week"), "date")
    return j.groupBy("week").agg(
        F.sum("commit_count").alias("commit_count"),
        F.sum("meeting_minutes").alias("meeting_minutes"),
        F.sum("meeting_count").alias("meeting_count"),
        F.count(F.when(F.col("commit_count") > 0, 1)).alias("active_days"))


def activity_between(mart_daily: DataFrame, start: str, end: str) -> DataFrame:
    """Daily activity within [start, end]."""
    return mart_daily.where(_between("date", start, end))


def project_activity_between(fct_commits: DataFrame, start: str, end: str,
                             repository_key: str | None = None) -> DataFrame:
    """Commits per project and day within [start, end] (one project when a key is given)."""
    day = F.to_date("committed_at")
    c = fct_commits.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if repository_key is not None:
        c = c.where(F.col("repository_key") == repository_key)
    return c.groupBy("repository_key", F.to_date("committed_at").alias("date")).agg(
        F.count(F.lit(1)).alias("commit_count"))


def meeting_stats(mart_daily: DataFrame, start: str, end: str) -> DataFrame:
    """Meetings, minutes, days and average minutes per day within [start, end]."""
    m = mart_daily.where(_between("date", start, end))
    g = m.agg(F.sum("meeting_count").alias("meeting_count"),
              F.sum("meeting_minutes").alias("meeting_minutes"),
              F.count(F.lit(1)).alias("days"))
    return g.select("meeting_count", "meeting_minutes", "days",
                    (F.col("meeting_minutes").cast("double") / F.col("days").cast("double"))
                    .alias("avg_minutes_per_day"))


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Change against the previous month in percent (null for the first month or a zero
    base). The window spans one row per month, so a single ordered partition is bounded."""
    w = Window.orderBy("month")
    out = monthly.select("month", "commits", "meeting_minutes",
                         F.lag("commits").over(w).alias("prev_commits"),
                         F.lag("meeting_minutes").over(w).alias("prev_meeting_minutes"))

    def pct(cur, prev):
        return F.when(F.col(prev) != 0, (F.col(cur) - F.col(prev)).cast("double") * F.lit(100.0)
                      / F.col(prev).cast("double"))

    return out.select("month", "commits", "meeting_minutes",
                      pct("commits", "prev_commits").alias("commits_change_pct"),
                      pct("meeting_minutes", "prev_meeting_minutes").alias("meeting_minutes_change_pct"))


def language_mix(per_repo: DataFrame, stg_repos: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """Commits per repository language and its share of all commits (orphans: null). `per_repo`
    holds commits folded by repository_source_id; keys are resolved after the fold."""
    keyed = resolve_fk(per_repo, stg_repos, "repository_source_id", "source_id", "repository_key")
    d = dim_repo.select(F.col("repository_key").alias("__k"), "language")
    j = keyed.join(d, keyed["repository_key"] == d["__k"], "left")
    g = j.groupBy("language").agg(F.sum("n").alias("commits"))
    total = keyed.agg(F.sum("n")).scalar()
    return g.select("language", "commits",
                    (F.col("commits").cast("double") / total.cast("double")).alias("share"))


def weekday_distribution(mart_daily: DataFrame, dim: DataFrame) -> DataFrame:
    """Activity by weekday with the busiest and quietest day (by commits; ties flag all)."""
    j = mart_daily.join(dim.select("date", "day_of_week"), "date")
    g = j.groupBy("day_of_week").agg(
        F.sum("commit_count").alias("commit_count"),
        F.sum("meeting_minutes").alias("meeting_minutes"),
        F.count(F.lit(1)).alias("days"))
    hi = g.agg(F.max("commit_count")).scalar()
    lo = g.agg(F.min("commit_count")).scalar()
    return g.select("*", (F.col("commit_count") == hi).alias("is_busiest"),
                    (F.col("commit_count") == lo).alias("is_quietest"))


def first_last_activity(per_repo: DataFrame, stg_repos: DataFrame) -> DataFrame:
    """First and last commit and commit count per repository (folded before the key join)."""
    keyed = resolve_fk(per_repo, stg_repos, "repository_source_id", "source_id", "repository_key")
    return keyed.groupBy("repository_key").agg(
        F.min("first_ts").alias("first_active"), F.max("last_ts").alias("last_active"),
        F.sum("n").alias("commit_count"))


def project_share(per_month: DataFrame, stg_repos: DataFrame) -> DataFrame:
    """Each project's share of the month's commits. Commits come folded to (month, repository);
    month totals are one row per month (bounded by the calendar), joined back instead of a window
    over all projects of a month."""
    keyed = resolve_fk(per_month, stg_repos, "repository_source_id", "source_id", "repository_key")
    pm = keyed.groupBy("month", "repository_key").agg(F.sum("n").alias("commits"))
    tot = pm.groupBy("month").agg(F.sum("commits").alias("__total"))
    j = pm.join(F.broadcast(tot), "month")
    return j.select("month", "repository_key", "commits",
                    (F.col("commits").cast("double") / F.col("__total").cast("double")).alias("share"))
