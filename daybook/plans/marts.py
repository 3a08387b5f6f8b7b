"""Intermediate models, dimensions, facts and marts.

Plan shape. Facts are folded to the grain a model needs straight from the scan: commits per day,
per repository or per (month, repository), calendar events per (day, category). Only the two
per-day results, whose size is the calendar's, are written and shared between models. A fold that
hardly reduces (day by repository) is never written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_name, iso_week, is_weekend, month_str


# --------------------------------------------------------------------------- joins (G1)

def resolve_fk(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, take: str) -> DataFrame:
    """fact LEFT JOIN dim ON fact.fact_col = dim.dim_col, adding dim.take.

    The dimension grows with the data (one row per repository), so no broadcast hint: the
    planner broadcasts it only under `autoBroadcastJoinThreshold` (static file sizes, then
    AQE's measured sizes); beyond that a shuffle join, where AQE splits a hot key's
    partition on the fact side.
    """
    d = dim.select(F.col(dim_col).alias("__fk"), F.col(take).alias("__take"))
    out = fact.join(d, fact[fact_col] == d["__fk"], "left")
    return out.drop("__fk").withColumnRenamed("__take", take)


# --------------------------------------------------------------------------- reductions

def commits_daily(stg_commits: DataFrame) -> DataFrame:
    """Per day: commits and distinct repositories. The distinct count shuffles (day, repository)
    after a map-side fold, so a repository with a third of the commits is folded in the tasks."""
    return stg_commits.groupBy(F.to_date("committed_at").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("commit_count"),
        F.countDistinct("repository_source_id").alias("active_repositories"))


def commits_by_repository(stg_commits: DataFrame) -> DataFrame:
    """Per repository: rows, non-null commit ids, first and newest commit (map-side fold)."""
    return stg_commits.groupBy("repository_source_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("commit_id").alias("n_ids"),
        F.min("committed_at").alias("first_ts"), F.max("committed_at").alias("last_ts"))


def commits_monthly(stg_commits: DataFrame) -> DataFrame:
    """Per (month, repository): commits."""
    return stg_commits.groupBy(month_str("committed_at").alias("month"), "repository_source_id").agg(
        F.count(F.lit(1)).alias("n"))


def int_calendar_activity(stg_calendar: DataFrame) -> DataFrame:
    """Per (day, category): minutes and events."""
    return stg_calendar.groupBy(
        F.to_date("start_at").alias("activity_date"), "category"
    ).agg(F.sum("duration_minutes").alias("minutes"),
          F.count(F.lit(1)).alias("event_count"))


def meetings_daily(cal_activity: DataFrame, category: str = "meeting") -> DataFrame:
    return cal_activity.where(F.col("category") == category).select(
        "activity_date",
        F.col("minutes").alias("meeting_minutes"),
        F.col("event_count").alias("meeting_count"))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)


# --------------------------------------------------------------------------- J1

def int_daily_activity(daily_commits: DataFrame, daily_meetings: DataFrame) -> DataFrame:
    """Full outer join of the two daily aggregates, null -> 0.

    A join (not union + group) keeps the reference's NULL semantics: a null commit day
    and a null meeting day stay two rows.
    """
    c, m = daily_commits.alias("c"), daily_meetings.alias("m")
    j = c.join(m, F.col("c.activity_date") == F.col("m.activity_date"), "full_outer")
    return j.select(
        F.coalesce(F.col("c.activity_date"), F.col("m.activity_date")).alias("activity_date"),
        _zero("commit_count"), _zero("active_repositories"),
        _zero("meeting_minutes"), _zero("meeting_count"))


# --------------------------------------------------------------------------- K1 / I1 / I2

def date_bounds(*date_frames: DataFrame) -> DataFrame:
    """H6 over I1: min/max of the union of activity dates; one row even on empty input."""
    u = None
    for df in date_frames:
        d = df.select(F.col("activity_date"))
        u = d if u is None else u.unionByName(d)
    return u.agg(F.min("activity_date").alias("min_date"), F.max("activity_date").alias("max_date"))


def date_series(bounds: DataFrame) -> DataFrame:
    """One row per day between the bounds; null bounds -> no rows.

    The spine is generated from one row, so its size is the number of calendar days
    between the bounds (thousands), independent of the data volume.
    """
    return bounds.select(
        F.explode(F.sequence("min_date", "max_date", F.expr("INTERVAL 1 DAY"))).alias("date"))


def date_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("date")
    return spine.select(
        d,
        day_name(d).alias("day_of_week"),
        iso_week(d).alias("week"),
        month_str(d).alias("month"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_date(daily_commits: DataFrame, cal_activity: DataFrame) -> DataFrame:
    """K1: day spine over commit days and calendar days (all categories)."""
    return date_attributes(date_series(date_bounds(daily_commits, cal_activity)))


# --------------------------------------------------------------------------- K4

def mart_daily_activity(dim: DataFrame, daily: DataFrame) -> DataFrame:
    """Spine LEFT JOIN daily activity, zero filled. Both sides are per-day."""
    j = dim.select("date").join(daily, F.col("date") == F.col("activity_date"), "left")
    return j.select("date", _zero("commit_count"), _zero("active_repositories"),
                    _zero("meeting_minutes"), _zero("meeting_count"))


# --------------------------------------------------------------------------- J3 / K5

def int_project_activity(stg_repos: DataFrame, per_repo: DataFrame, days: int = 14) -> DataFrame:
    """Per repository: newest commit, commits, active/stale/inactive.

    Commits are folded per repository before they meet the repository table (G2). "As of" is the
    newest commit in the data, a scalar subquery (G6) over the per-repository result.
    """
    r = stg_repos.select("repository_key", "name", "source_id")
    j = r.join(per_repo, r["source_id"] == per_repo["repository_source_id"], "left")
    g = j.groupBy("repository_key", "name").agg(
        F.max("last_ts").alias("last_active"),
        F.coalesce(F.sum("n_ids"), F.lit(0)).cast("bigint").alias("commit_count"))
    as_of = per_repo.agg(F.max("last_ts").alias("as_of")).scalar()
    status = (F.when(F.col("last_active").isNull(), "inactive")
              .when(F.col("last_active") >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"), "active")
              .otherwise("stale"))
    return g.select("repository_key", "name", "last_active", "commit_count", status.alias("status"))


def mart_project_activity(project: DataFrame) -> DataFrame:
    return project.select("repository_key", "name", "last_active", "commit_count", "status")


# --------------------------------------------------------------------------- K2, K3, K7-K11

def dim_repository(stg_repos: DataFrame) -> DataFrame:
    return stg_repos.select("repository_key", "github_repository_id", "name", "owner",
                            "language", "created_at", "archived")


def fct_commits(stg_commits: DataFrame, stg_repos: DataFrame) -> DataFrame:
    j = resolve_fk(stg_commits, stg_repos, "repository_source_id", "source_id", "repository_key")
    return j.select("commit_key", "repository_key", "commit_id", "author", "committed_at",
                    "additions", "deletions")


def fct_calendar_events(stg_calendar: DataFrame) -> DataFrame:
    return stg_calendar.select("event_key", "calendar_event_id", "start_at", "end_at",
                               "duration_minutes", "category")


def fct_pull_requests(stg_prs: DataFrame, stg_repos: DataFrame) -> DataFrame:
    j = resolve_fk(stg_prs, stg_repos, "repository_source_id", "source_id", "repository_key")
    return j.select("pr_key", "repository_key", "number", "title", "state", "author",
                    "created_at", "updated_at", "closed_at", "merged_at", "is_draft",
                    "comments_count")


def fct_issues(stg_issues: DataFrame, stg_repos: DataFrame) -> DataFrame:
    j = resolve_fk(stg_issues, stg_repos, "repository_source_id", "source_id", "repository_key")
    return j.select("issue_key", "repository_key", "number", "title", "state", "state_reason",
                    "author", "created_at", "updated_at", "closed_at", "comments_count")


def fct_email_messages(stg_emails: DataFrame) -> DataFrame:
    return stg_emails.select("message_key", "thread_id", "sender", "recipients", "subject",
                             "date", "snippet")


def fct_plays(stg_plays: DataFrame) -> DataFrame:
    return stg_plays.select("play_key", "played_at", "track_id", "track_name", "artists")


# --------------------------------------------------------------------------- K6

def monthly_commits(per_month: DataFrame, stg_repos: DataFrame) -> DataFrame:
    """Per month over fct_commits: rows and distinct repository_key (orphans not counted).

    Commits come folded to (month, repository), then are resolved against the repository table:
    the join fans out as the commit-level join would.
    """
    j = resolve_fk(per_month, stg_repos, "repository_source_id", "source_id", "repository_key")
    return j.groupBy("month").agg(F.sum("n").alias("commits"),
                                  F.countDistinct("repository_key").alias("active_repos"))


def monthly_meetings(cal_activity: DataFrame, category: str = "meeting") -> DataFrame:
    return (cal_activity.where(F.col("category") == category)
            .groupBy(month_str("activity_date").alias("month"))
            .agg(F.sum("minutes").alias("meeting_minutes"),
                 F.sum("event_count").alias("meeting_count")))


def monthly_active_days(mart_daily: DataFrame) -> DataFrame:
    """H4: distinct days with at least one commit, per month."""
    return mart_daily.groupBy(month_str("date").alias("month")).agg(
        F.countDistinct(F.when(F.col("commit_count") > 0, F.col("date"))).alias("active_days"))


def mart_monthly_summary(m_commits: DataFrame, m_meetings: DataFrame, m_days: DataFrame) -> DataFrame:
    """Chained full outer joins, third key = coalesce(c.month, m.month)."""
    c, m, d = m_commits.alias("c"), m_meetings.alias("m"), m_days.alias("d")
    cm = c.join(m, F.col("c.month") == F.col("m.month"), "full_outer")
    cmd = cm.join(d, F.coalesce(F.col("c.month"), F.col("m.month")) == F.col("d.month"), "full_outer")
    return cmd.select(
        F.coalesce(F.col("c.month"), F.col("m.month"), F.col("d.month")).alias("month"),
        _zero("commits"), _zero("active_repos"), _zero("meeting_minutes"),
        _zero("meeting_count"), _zero("active_days"))
