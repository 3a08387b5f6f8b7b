"""

Each query runs an operator of the library over whole driver tables (through the raw
bindings); the paired SQL states the same semantics plainly for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from . import oracle as O
from .operators import incremental as D
from .operators import quality as Q
from .operators import runs as E
from .operators import upsert as U
from .plans import marts as M
from .plans.build import Warehouse
from .queries import register, wh
from .sources import bindings as B

W = O.with_models

# Scenario parameters (fixed so that results are repeatable).
RUN_NOW = "2001-09-01 00:00:00"          # run time of the upsert / cursor scenarios
EXISTING_BEFORE = "1999-01-01 00:00:00"  # rows already loaded by the previous run
INCOMING_FROM = "1998-01-01 00:00:00"    # the new batch (overlaps one year -> updates)
DQ_AS_OF = "2024-01-01 00:00:00"         # "now" of the data-quality run
RECENT_AS_OF = "2001-01-01 00:00:00"     # "now" of the range/or filter example
LOOKBACK_DAYS = 90


# =============================================================== F8, F9 filters

@register("filter_eq", W("""
    SELECT event_key, start_at, duration_minutes FROM stg_calendar_events
    WHERE category = 'meeting'"""))
def filter_eq(spark, sf):
    s = wh(spark, sf).stg_calendar_events
    return s.where(F.col("category") == "meeting").select("event_key", "start_at", "duration_minutes")


@register("filter_range_or", W(f"""
    SELECT commit_key, committed_at FROM fct_commits
    WHERE committed_at > TIMESTAMP '{RECENT_AS_OF}' OR committed_at < TIMESTAMP '2000-01-01'"""))
def filter_range_or(spark, sf):
    return Q.plausible_ts(wh(spark, sf).fct_commits, "committed_at", RECENT_AS_OF).select(
        "commit_key", "committed_at")


# =============================================================== G joins

@register("left_join_fk", W("""
    SELECT commit_key, (SELECT r.repository_key FROM stg_github_repositories r
                        WHERE r.source_id = c.repository_source_id) AS repository_key
    FROM stg_github_commits c"""))
def left_join_fk(spark, sf):
    """G1: commits with their repository's key; orphans keep a null."""
    w = wh(spark, sf)
    return M.resolve_fk(w.stg_commits, w.stg_repositories, "repository_source_id", "source_id",
                        "repository_key").select("commit_key", "repository_key")


@register("left_join_agg", W("""
    SELECT r.repository_key, max(c.committed_at) AS last_active, count(c.commit_id) AS commit_count
    FROM stg_github_repositories r
    LEFT JOIN stg_github_commits c ON c.repository_source_id = r.source_id
    GROUP BY 1"""))
def left_join_agg(spark, sf):
    p = wh(spark, sf).int_project_activity
    return p.select("repository_key", "last_active", "commit_count")


@register("full_outer_2", W("""
    WITH c AS (SELECT CAST(committed_at AS DATE) AS d, count(*) AS commit_count
               FROM stg_github_commits GROUP BY 1),
         m AS (SELECT CAST(start_at AS DATE) AS d, count(*) AS meeting_count
               FROM stg_calendar_events WHERE category = 'meeting' GROUP BY 1)
    SELECT coalesce(c.d, m.d) AS activity_date, c.commit_count, m.meeting_count
    FROM c FULL OUTER JOIN m ON c.d = m.d"""))
def full_outer_2(spark, sf):
    w = wh(spark, sf)
    c, m = w.commits_daily.alias("c"), w.meetings_daily.alias("m")
    j = c.join(m, F.col("c.activity_date") == F.col("m.activity_date"), "full_outer")
    return j.select(F.coalesce("c.activity_date", "m.activity_date").alias("activity_date"),
                    "commit_count", "meeting_count")


@register("full_outer_chain", W("""
    SELECT month, nullif(count(*) FILTER (WHERE k = 0), 0) AS commits,
           nullif(count(*) FILTER (WHERE k = 1), 0) AS meeting_count,
           CASE WHEN bool_or(k >= 2) THEN count(*) FILTER (WHERE k = 3) END AS active_days
    FROM (SELECT date_trunc('month', committed_at)::DATE AS m, 0 AS k FROM stg_github_commits
          UNION ALL SELECT date_trunc('month', start_at)::DATE, 1 FROM stg_calendar_events WHERE category = 'meeting'
          UNION ALL SELECT date_trunc('month', date)::DATE, 2 + CAST(commit_count > 0 AS INTEGER) FROM mart_daily_activity) x,
         LATERAL (SELECT left(CAST(m AS VARCHAR), 7) AS month) named
    GROUP BY month"""))
def full_outer_chain(spark, sf):
    w = wh(spark, sf)
    c = M.monthly_commits(w.commits_monthly, w.stg_repositories).select("month", "commits").alias("c")
    m = M.monthly_meetings(w.int_calendar_activity).select("month", "meeting_count").alias("m")
    d = M.monthly_active_days(w.mart_daily_activity).alias("d")
    cm = c.join(m, F.col("c.month") == F.col("m.month"), "full_outer")
    j = cm.join(d, F.coalesce("c.month", "m.month") == F.col("d.month"), "full_outer")
    return j.select(F.coalesce("c.month", "m.month", "d.month").alias("month"),
                    "commits", "meeting_count", "active_days")


@register("spine_left_join", W("""
    SELECT d.date, coalesce(m.meeting_minutes, 0) AS meeting_minutes
    FROM dim_date d LEFT JOIN (
        SELECT CAST(start_at AS DATE) AS activity_date,
               CAST(sum(duration_minutes) AS BIGINT) AS meeting_minutes
        FROM stg_calendar_events WHERE category = 'meeting' GROUP BY 1) m
    ON d.date = m.activity_date"""))
def spine_left_join(spark, sf):
    w = wh(spark, sf)
    j = w.dim_date.select("date").join(w.meetings_daily, F.col("date") == F.col("activity_date"), "left")
    return j.select("date", F.coalesce("meeting_minutes", F.lit(0)).cast("bigint").alias("meeting_minutes"))


@register("scalar_subquery", W("""
    SELECT commit_key,
           committed_at >= (SELECT max(committed_at) FROM stg_github_commits) - INTERVAL 14 DAY
             AS is_recent
    FROM stg_github_commits"""))
def scalar_subquery(spark, sf):
    c = wh(spark, sf).stg_commits
    as_of = c.agg(F.max("committed_at")).scalar()
    return c.select("commit_key", (F.col("committed_at") >= as_of - F.expr("INTERVAL 14 DAYS")).alias("is_recent"))


# =============================================================== H aggregations

@register("count_star", W("""
    SELECT category, count(*) AS event_count FROM stg_calendar_events GROUP BY 1"""))
def count_star(spark, sf):
    return wh(spark, sf).stg_calendar_events.groupBy("category").agg(
        F.count(F.lit(1)).alias("event_count"))


@register("count_col", W("""
    SELECT r.repository_key, count(i.closed_at) AS closed_issues
    FROM stg_github_repositories r
    LEFT JOIN stg_github_issues i ON i.repository_source_id = r.source_id
    GROUP BY 1"""))
def count_col(spark, sf):
    w = wh(spark, sf)
    per = w.stg_issues.groupBy("repository_source_id").agg(F.count("closed_at").alias("n"))
    r = w.stg_repositories.select("repository_key", "source_id")
    j = r.join(per, r["source_id"] == per["repository_source_id"], "left")
    return j.groupBy("repository_key").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("closed_issues"))


@register("count_distinct", W("""
    SELECT CAST(committed_at AS DATE) AS activity_date,
           count(DISTINCT repository_source_id) AS active_repositories
    FROM stg_github_commits GROUP BY 1"""))
def count_distinct(spark, sf):
    return wh(spark, sf).stg_commits.groupBy(F.to_date("committed_at").alias("activity_date")).agg(
        F.countDistinct("repository_source_id").alias("active_repositories"))


@register("count_distinct_if", W("""
    SELECT DISTINCT left(CAST(date AS VARCHAR), 7) AS month,
           CAST(sum(CASE WHEN commit_count > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY year(date), month(date)) AS BIGINT)
             AS active_days
    FROM mart_daily_activity"""))
def count_distinct_if(spark, sf):
    return M.monthly_active_days(wh(spark, sf).mart_daily_activity)


@register("sum_int", W("""
    SELECT CAST(start_at AS DATE) AS activity_date, CAST(sum(duration_minutes) AS BIGINT) AS minutes
    FROM stg_calendar_events GROUP BY 1"""))
def sum_int(spark, sf):
    return wh(spark, sf).int_calendar_activity.groupBy("activity_date").agg(
        F.sum("minutes").alias("minutes"))


@register("min_max_global", W("""
    SELECT least((SELECT min(committed_at) FROM stg_github_commits),
                 (SELECT min(start_at) FROM stg_calendar_events))::DATE AS min_date,
           greatest((SELECT max(committed_at) FROM stg_github_commits),
                    (SELECT max(start_at) FROM stg_calendar_events))::DATE AS max_date"""))
def min_max_global(spark, sf):
    w = wh(spark, sf)
    return M.date_bounds(w.commits_daily, w.int_calendar_activity)


@register("max_per_group", W("""
    SELECT repository_source_id, max(committed_at) AS last_active
    FROM stg_github_commits GROUP BY 1"""))
def max_per_group(spark, sf):
    return wh(spark, sf).stg_commits.groupBy("repository_source_id").agg(
        F.max("committed_at").alias("last_active"))


@register("group_by_expr", W("""
    SELECT strftime(committed_at, '%Y-%m') AS month, count(*) AS commits
    FROM stg_github_commits GROUP BY 1"""))
def group_by_expr(spark, sf):
    return wh(spark, sf).stg_commits.groupBy(fn.month_str("committed_at").alias("month")).agg(
        F.count(F.lit(1)).alias("commits"))


# =============================================================== I union / series

@register("union_all", W("""
    SELECT CAST(committed_at AS DATE) AS activity_date, 'commit' AS origin FROM stg_github_commits
    UNION ALL
    SELECT CAST(start_at AS DATE) AS activity_date, 'calendar' AS origin FROM stg_calendar_events"""))
def union_all(spark, sf):
    w = wh(spark, sf)
    a = w.stg_commits.select(F.to_date("committed_at").alias("activity_date"), F.lit("commit").alias("origin"))
    b = w.stg_calendar_events.select(F.to_date("start_at").alias("activity_date"), F.lit("calendar").alias("origin"))
    return a.unionByName(b)


@register("date_series", W("""
    WITH RECURSIVE upto(date, z) AS (
        SELECT least((SELECT min(committed_at) FROM stg_github_commits), (SELECT min(start_at) FROM stg_calendar_events))::DATE,
               greatest((SELECT max(committed_at) FROM stg_github_commits), (SELECT max(start_at) FROM stg_calendar_events))::DATE
        UNION ALL SELECT date + 1, z FROM upto WHERE date < z)
    SELECT date FROM upto"""))
def date_series(spark, sf):
    w = wh(spark, sf)
    return M.date_series(M.date_bounds(w.commits_daily, w.int_calendar_activity))


# =============================================================== O scalar functions

@register("scalar_functions", W("""
    SELECT source_id,
           md5(coalesce(CAST(source AS VARCHAR), '') || '|' || coalesce(CAST(thread_id AS VARCHAR), '')) AS skey,
           strftime(CAST(date AS DATE), '%G-%V') AS week,
           strftime(date, '%Y-%m') AS month,
           dayname(CAST(date AS DATE)) AS day_name,
           CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
           dayofweek(date) IN (0, 6) AS is_weekend,
           CAST(round(epoch(date - date_trunc('day', date)) / 60.0) AS INTEGER) AS minutes_of_day,
           date_trunc('second', date) AS started_second,
           epoch_us(date) // 1000 AS ms,
           strftime(date, '%Y/%m/%d') AS day_query
    FROM raw_gmail_messages"""))
def scalar_functions(spark, sf):
    e = B.raw_emails(spark, sf)
    d = F.col("date")
    return e.select(
        "source_id",
        fn.surrogate_key("source", "thread_id").alias("skey"),
        fn.iso_week(F.to_date(d)).alias("week"),
        fn.month_str(d).alias("month"),
        fn.day_name(F.to_date(d)).alias("day_name"),
        F.quarter(d).cast("int").alias("quarter"), F.year(d).cast("int").alias("year"),
        fn.is_weekend(d).alias("is_weekend"),
        fn.minutes_between(fn.floor_day(d), d).alias("minutes_of_day"),
        fn.trunc_second(d).alias("started_second"),
        fn.to_ms(d).alias("ms"),
        D.day_query(d).alias("day_query"))


# Titles of every category, by the part's number; the expected category is written out.
TITLES = (("Quarterly planning for", "meeting"), ("1:1 about", "meeting"), ("Out of office,", "other"),
          ("Deep work on", "other"), ("Evening course:", "learning"), ("PAIR PROGRAMMING the", "learning"),
          ("Dentist, then", "personal"), ("coffee with", "personal"), ("Ship the", "work"), ("Fix", "work"),
          ("Holiday planning for", "other"), ("Training review of", "meeting"))


@register("categorize", f"""
    SELECT p_partkey AS id, CASE p_partkey % {len(TITLES)}
           {" ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(TITLES))} END AS category
    FROM part
    UNION ALL SELECT -p_partkey, 'other' FROM part""")
def categorize(spark, sf):
    """Titles built from part names, in every category, by each rule and by none; blank titles."""
    p = B.table(spark, sf, "part")
    title = F.element_at(F.array(*[F.lit(t) for t, _ in TITLES]), (F.col("p_partkey") % len(TITLES) + 1).cast("int"))
    named = p.select(F.col("p_partkey").alias("id"), F.concat(title, F.lit(" "), "p_name").alias("title"))
    blank = p.select((-F.col("p_partkey")).alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.lit(" \t ")).alias("title"))
    return named.unionByName(blank).select("id", fn.categorize("title").alias("category"))


# A caller-supplied rule set (the categoriser is extensible): part names by kind.
PART_RULES = (
    ("fastener", ("bolt", "screw", "nut", "rivet")),
    ("mechanism", ("gear", "spring", "valve", "widget")),
)


@register("categorize_custom", f"""
    SELECT p_partkey AS id, {fn.categorize_sql('p_name', PART_RULES, 'misc')} AS category FROM part""")
def categorize_custom(spark, sf):
    return B.table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), fn.categorize("p_name", PART_RULES, "misc").alias("category"))


# =============================================================== L data quality

def _dq_models(spark, sf, w=None) -> dict[str, DataFrame]:
    w = w if w is not None else wh(spark, sf).materialize()
    models = dict(w.raw)
    alias = {"stg_github_repositories": "stg_repositories", "stg_github_commits": "stg_commits",
             "stg_github_pull_requests": "stg_pull_requests", "stg_github_issues": "stg_issues",
             "stg_gmail_messages": "stg_emails", "stg_spotify_plays": "stg_plays",
             "fct_spotify_plays": "fct_plays"}
    for name in ("stg_github_repositories", "stg_github_commits", "stg_github_pull_requests",
                 "stg_github_issues", "stg_calendar_events", "stg_gmail_messages",
                 "stg_spotify_plays", "dim_date", "dim_repository", "fct_commits",
                 "fct_calendar_events", "fct_pull_requests", "fct_issues", "fct_email_messages",
                 "fct_spotify_plays", "mart_daily_activity", "mart_project_activity",
                 "mart_monthly_summary"):
        models[name] = w.model(alias.get(name, name))
    return models


def check_sql(c: Q.Check) -> str:
    head = f"SELECT '{c.kind}' AS \"check\", '{c.model}' AS model, '{c.column}' AS \"column\", "
    cnt = "CAST(count(*) AS BIGINT) AS failures"
    col, m = c.column, c.model
    if c.kind == "not_null":
        return head + f"{cnt} FROM {m} WHERE {col} IS NULL"
    if c.kind == "unique":
        return head + f"{cnt} FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    if c.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in c.args["values"])
        return head + f"{cnt} FROM (SELECT {col} FROM {m} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY 1)"
    if c.kind == "relationships":
        to, fld = c.args["to"], c.args["field"]
        return head + (f"{cnt} FROM {m} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM {to} p WHERE p.{fld} = x.{col})")
    if c.kind == "no_negative":
        return head + f"{cnt} FROM {m} WHERE {col} < 0"
    if c.kind == "plausible_ts":
        return head + (f"{cnt} FROM {m} WHERE {col} > TIMESTAMP '{c.args['as_of']}' "
                       f"OR {col} < TIMESTAMP '2000-01-01'")
    raise ValueError(c.kind)


@register("dq_not_null", W("SELECT issue_key, state FROM stg_github_issues WHERE closed_at IS NULL"))
def dq_not_null(spark, sf):
    return Q.not_null(wh(spark, sf).stg_issues, "closed_at").select("issue_key", "state")


@register("dq_unique", W("""
    SELECT calendar_event_id AS unique_field, count(*) AS n_records FROM stg_calendar_events
    WHERE calendar_event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""))
def dq_unique(spark, sf):
    return Q.unique(wh(spark, sf).stg_calendar_events, "calendar_event_id")


ACCEPTED_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


@register("dq_accepted_values", W(f"""
    SELECT author AS value_field, count(*) AS n_records FROM stg_github_commits
    WHERE author IS NOT NULL AND author NOT IN ({", ".join(f"'{v}'" for v in ACCEPTED_PRIORITIES)})
    GROUP BY 1"""))
def dq_accepted_values(spark, sf):
    return Q.accepted_values(wh(spark, sf).stg_commits, "author", ACCEPTED_PRIORITIES)


@register("dq_relationships", W(f"""
    SELECT commit_key, {O.skey('source', 'repository_source_id')} AS repository_key FROM stg_github_commits
    WHERE repository_source_id NOT IN (SELECT source_id FROM stg_github_repositories)"""))
def dq_relationships(spark, sf):
    """L4: the key that a commit's repository would have, against the repositories there are."""
    w = wh(spark, sf)
    child = w.stg_commits.select("commit_key", fn.surrogate_key("source", "repository_source_id").alias("repository_key"))
    return Q.relationships(child, "repository_key", w.dim_repository, "repository_key")


@register("dq_no_negative_duration", W("""
    SELECT event_key FROM fct_calendar_events WHERE duration_minutes < 0"""))
def dq_no_negative_duration(spark, sf):
    return Q.no_negative(wh(spark, sf).fct_calendar_events, "duration_minutes").select("event_key")


@register("dq_plausible_ts", W(f"""
    SELECT commit_key FROM fct_commits
    WHERE committed_at > TIMESTAMP '{DQ_AS_OF}' OR committed_at < TIMESTAMP '2000-01-01'"""))
def dq_plausible_ts(spark, sf):
    return Q.plausible_ts(wh(spark, sf).fct_commits, "committed_at", DQ_AS_OF).select("commit_key")


@register("dq_report", W("\nUNION ALL\n".join(check_sql(c) for c in Q.declared_checks(DQ_AS_OF))))
def dq_report(spark, sf):
    """L7. What the marts share is written first; facts share their staging table's scan if the repository
    table's join key is unique, else they are joined and read for themselves."""
    w = wh(spark, sf).materialize(*Warehouse.SHARED, *Warehouse.BY_REPOSITORY)
    one_each = Q.unique(w.repository_keys, "source_id").isEmpty()
    folds = {"fct_commits": w.commits_by_repository.select("repository_source_id", "n")}
    for name, stg in (("fct_pull_requests", w.stg_pull_requests), ("fct_issues", w.stg_issues)):
        folds[name] = stg.groupBy("repository_source_id").agg(F.count(F.lit(1)).alias("n"))
    folded = {k: M.resolve_fk(x, w.repository_keys, "repository_source_id", "source_id", "repository_key").select(
        F.col("repository_key").alias("key"), "n") for k, x in folds.items()}
    same = Q.SAME_ROWS | (Q.FACT_ROWS if one_each else {})
    return Q.run_checks(_dq_models(spark, sf, w), Q.declared_checks(DQ_AS_OF), same, folded)
