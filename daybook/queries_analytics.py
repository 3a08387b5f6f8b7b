"""Registered analytics queries (N1-N9) over the marts."""

from __future__ import annotations

from . import oracle as O
from .plans import analytics as A
from .queries import register, shared, wh

W = O.with_models
RANGE = ("1997-01-01", "1997-03-31")


@register("weekly_activity", W("""
    SELECT d.week, sum(m.commit_count) AS commit_count,
           CAST(sum(m.meeting_minutes) AS BIGINT) AS meeting_minutes,
           CAST(sum(m.meeting_count) AS BIGINT) AS meeting_count,
           count(CASE WHEN m.commit_count > 0 THEN 1 END) AS active_days
    FROM mart_daily_activity m JOIN dim_date d ON m.date = d.date GROUP BY 1"""))
def weekly_activity(spark, sf):
    w = shared(spark, sf)
    return A.weekly_activity(w.mart_daily_activity, w.dim_date)


@register("activity_between", W(f"""
    SELECT * FROM mart_daily_activity WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"""))
def activity_between(spark, sf):
    return A.activity_between(shared(spark, sf).mart_daily_activity, *RANGE)


@register("project_activity_between", W(f"""
    SELECT repository_key, CAST(committed_at AS DATE) AS date, count(*) AS commit_count
    FROM fct_commits
    WHERE CAST(committed_at AS DATE) BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
    GROUP BY 1, 2"""))
def project_activity_between(spark, sf):
    return A.project_activity_between(wh(spark, sf).fct_commits, *RANGE)


@register("meeting_stats", W(f"""
    SELECT CAST(sum(meeting_count) AS BIGINT) AS meeting_count,
           CAST(sum(meeting_minutes) AS BIGINT) AS meeting_minutes, count(*) AS days,
           CAST(sum(meeting_minutes) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_minutes_per_day
    FROM mart_daily_activity WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'"""))
def meeting_stats(spark, sf):
    return A.meeting_stats(shared(spark, sf).mart_daily_activity, *RANGE)


@register("month_over_month", W("""
    SELECT month, commits, meeting_minutes,
           CASE WHEN pc <> 0 THEN CAST(commits - pc AS DOUBLE) * 100.0 / CAST(pc AS DOUBLE) END
             AS commits_change_pct,
           CASE WHEN pm <> 0 THEN CAST(meeting_minutes - pm AS DOUBLE) * 100.0 / CAST(pm AS DOUBLE) END
             AS meeting_minutes_change_pct
    FROM (SELECT *, lag(commits) OVER (ORDER BY month) AS pc,
                 lag(meeting_minutes) OVER (ORDER BY month) AS pm FROM mart_monthly_summary) x"""))
def month_over_month(spark, sf):
    return A.month_over_month(shared(spark, sf).mart_monthly_summary)


@register("language_mix", W("""
    SELECT r.language, count(*) AS commits,
           CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM fct_commits) AS DOUBLE) AS share
    FROM fct_commits c LEFT JOIN dim_repository r ON c.repository_key = r.repository_key
    GROUP BY 1"""))
def language_mix(spark, sf):
    w = wh(spark, sf)
    return A.language_mix(w.commits_by_repository, w.stg_repositories, w.dim_repository)


@register("weekday_distribution", W("""
    WITH g AS (SELECT d.day_of_week, sum(m.commit_count) AS commit_count,
                      CAST(sum(m.meeting_minutes) AS BIGINT) AS meeting_minutes, count(*) AS days
               FROM mart_daily_activity m JOIN dim_date d ON m.date = d.date GROUP BY 1)
    SELECT *, commit_count = (SELECT max(commit_count) FROM g) AS is_busiest,
              commit_count = (SELECT min(commit_count) FROM g) AS is_quietest
    FROM g"""))
def weekday_distribution(spark, sf):
    w = shared(spark, sf)
    return A.weekday_distribution(w.mart_daily_activity, w.dim_date)


@register("first_last_activity", W("""
    SELECT repository_key, min(committed_at) AS first_active, max(committed_at) AS last_active,
           count(*) AS commit_count
    FROM fct_commits GROUP BY 1"""))
def first_last_activity(spark, sf):
    w = wh(spark, sf)
    return A.first_last_activity(w.commits_by_repository, w.stg_repositories)


@register("project_share", W("""
    WITH pm AS (SELECT strftime(committed_at, '%Y-%m') AS month, repository_key, count(*) AS commits
                FROM fct_commits GROUP BY 1, 2)
    SELECT month, repository_key, commits,
           CAST(commits AS DOUBLE) / CAST(sum(commits) OVER (PARTITION BY month) AS DOUBLE) AS share
    FROM pm"""))
def project_share(spark, sf):
    w = wh(spark, sf)
    return A.project_share(w.commits_monthly, w.stg_repositories)
