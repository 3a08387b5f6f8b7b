"""Oracle SQL for DuckDB: the warehouse models written as straightforward SQL.

Written from the models' output contracts in another form than the Spark plans, which fold and
join: here outer joins are unions that are grouped, lookups are scalar subqueries, per-group
results are windows. The driver runs both and compares. The driver tables are pre-registered as
DuckDB views.
"""

from __future__ import annotations

from .functions.categorize import categorize_sql
from .sources.bindings import LOAD_TS, REPO_CREATED_TS


def skey(*parts: str) -> str:
    inner = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"md5({inner})"


_TAIL = f"TIMESTAMP '{LOAD_TS}' AS ingested_at, TIMESTAMP '{LOAD_TS}' AS updated_at, '{{}}' AS raw_payload"
_CLOSED = "event_type IN ('purchase', 'error')"

RAW = {
    "raw_github_repositories": f"""
        SELECT 'github' AS source, CAST(c_custkey AS VARCHAR) AS source_id,
               CASE WHEN c_custkey % 50 <> 0 THEN CAST(c_custkey AS BIGINT) END AS github_repository_id, c_name AS name,
               CAST(c_nationkey AS VARCHAR) AS owner,
               CAST(c_nationkey AS VARCHAR) || '/' || c_name AS full_name,
               c_mktsegment AS language, TIMESTAMP '{REPO_CREATED_TS}' AS created_at,
               c_acctbal < 0 AS archived, {_TAIL}
        FROM customer""",
    "raw_github_commits": f"""
        SELECT 'github' AS source, CAST(o_orderkey AS VARCHAR) AS source_id,
               CAST(o_custkey * 2 AS VARCHAR) AS repository_source_id,
               CASE WHEN o_orderkey % 40 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS commit_sha, o_orderpriority AS author_name,
               '' AS author_email, o_orderdate AS committed_at,
               CAST(NULL AS INTEGER) AS additions, CAST(NULL AS INTEGER) AS deletions,
               o_orderstatus AS message, {_TAIL}
        FROM orders""",
    "raw_calendar_events": f"""
        SELECT 'calendar' AS source,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_id,
               'primary' AS calendar_id,
               CASE l_returnflag WHEN 'R' THEN 'Weekly sync' WHEN 'A' THEN 'Write design doc'
                    ELSE 'Focus block' END AS title,
               l_shipdate AS start_at,
               l_shipdate + to_minutes(CAST(l_quantity AS INTEGER) - CASE WHEN l_linenumber = 7 THEN 60 ELSE 0 END) AS end_at,
               'UTC' AS timezone, l_linenumber AS attendees_count, 'confirmed' AS status,
               CASE l_returnflag WHEN 'R' THEN 'meeting' WHEN 'A' THEN 'work'
                    ELSE 'other' END AS category, {_TAIL}
        FROM lineitem""",
    "raw_github_issues": f"""
        SELECT 'github' AS source, CAST(event_id AS VARCHAR) AS source_id,
               CAST(user_id AS VARCHAR) AS repository_source_id,
               CAST(event_id AS INTEGER) AS number, event_type AS title,
               CASE WHEN {_CLOSED} THEN 'closed' ELSE 'open' END AS state,
               CASE WHEN {_CLOSED} THEN 'completed' END AS state_reason,
               'user' || CAST(user_id AS VARCHAR) AS author,
               ts AS created_at, ts AS updated_at,
               CASE WHEN {_CLOSED} THEN ts END AS closed_at,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS comments_count,
               TIMESTAMP '{LOAD_TS}' AS ingested_at, props AS raw_payload
        FROM events WHERE event_type NOT IN ('error', 'signup')""",
    "raw_github_pull_requests": f"""
        SELECT 'github' AS source, CAST(event_id AS VARCHAR) AS source_id,
               CAST(user_id AS VARCHAR) AS repository_source_id,
               CAST(event_id AS INTEGER) AS number, event_type AS title,
               CASE WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90 THEN 'merged'
                    WHEN {_CLOSED} THEN 'closed' ELSE 'open' END AS state,
               'user' || CAST(user_id AS VARCHAR) AS author,
               ts AS created_at, ts AS updated_at,
               CASE WHEN {_CLOSED} THEN ts END AS closed_at,
               CASE WHEN event_type = 'error' THEN ts END AS merged_at,
               event_type = 'signup' AS is_draft,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS comments_count,
               TIMESTAMP '{LOAD_TS}' AS ingested_at, props AS raw_payload
        FROM events WHERE event_type IN ('error', 'signup')""",
    "raw_gmail_messages": f"""
        SELECT 'gmail' AS source, CAST(event_id AS VARCHAR) AS source_id,
               CAST(user_id AS VARCHAR) AS thread_id,
               'user' || CAST(user_id AS VARCHAR) || '@example.com' AS sender,
               'me@example.com' AS recipients, event_type AS subject, ts AS date,
               props AS snippet, {_TAIL}
        FROM events""",
    "pipeline_runs": """
        SELECT md5(source || '|' || CAST(d AS VARCHAR)) AS run_id, source, started_at, finished_at,
               CASE WHEN fetched % 7 = 0 THEN 'failed' WHEN failed > 0 THEN 'partial'
                    ELSE 'success' END AS status,
               CAST(fetched AS INTEGER) AS records_fetched,
               CAST(inserted AS INTEGER) AS records_inserted,
               CAST(fetched - inserted AS INTEGER) AS records_updated,
               CAST(failed AS INTEGER) AS records_failed,
               CASE WHEN fetched % 7 = 0 THEN 'rate limit' END AS error_message
        FROM (SELECT event_type AS source, CAST(ts AS DATE) AS d, min(ts) AS started_at,
                     max(ts) AS finished_at, count(*) AS fetched,
                     count(DISTINCT user_id) AS inserted,
                     count(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95
                                THEN 1 END) AS failed
              FROM events GROUP BY 1, 2) g""",
    "raw_spotify_plays": f"""
        SELECT 'spotify' AS source,
               CAST(event_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS source_id,
               ts AS played_at, CAST(event_id AS VARCHAR) AS track_id, event_type AS track_name,
               'artist ' || CAST(user_id AS VARCHAR) AS artists, {_TAIL}
        FROM events""",
}

MODELS = {
    "stg_github_repositories": f"""
        SELECT {skey('source', 'source_id')} AS repository_key, source, source_id,
               github_repository_id, name, owner, full_name, language, created_at, archived,
               ingested_at, updated_at
        FROM raw_github_repositories""",
    "stg_github_commits": f"""
        SELECT {skey('source', 'source_id')} AS commit_key, source, source_id,
               repository_source_id, commit_sha AS commit_id, author_name AS author,
               author_email, committed_at, additions, deletions, message
        FROM raw_github_commits""",
    "stg_github_pull_requests": f"""
        SELECT {skey('source', 'source_id')} AS pr_key, source, source_id,
               repository_source_id, number, title, state, author, created_at, updated_at,
               closed_at, merged_at, is_draft, comments_count
        FROM raw_github_pull_requests""",
    "stg_github_issues": f"""
        SELECT {skey('source', 'source_id')} AS issue_key, source, source_id,
               repository_source_id, number, title, state, state_reason, author, created_at,
               updated_at, closed_at, comments_count
        FROM raw_github_issues""",
    "stg_calendar_events": f"""
        SELECT {skey('source', 'calendar_id', 'source_id')} AS event_key, source, calendar_id,
               source_id AS calendar_event_id, title, start_at, end_at, timezone,
               attendees_count, status, category,
               CAST(round(epoch(end_at - start_at) / 60.0) AS INTEGER) AS duration_minutes
        FROM raw_calendar_events""",
    "stg_gmail_messages": f"""
        SELECT {skey('source', 'source_id')} AS message_key, source, source_id, thread_id,
               sender, recipients, subject, date, snippet
        FROM raw_gmail_messages""",
    "stg_spotify_plays": f"""
        SELECT {skey('source', 'source_id')} AS play_key, source, source_id, played_at,
               track_id, track_name, artists
        FROM raw_spotify_plays""",
    "int_daily_activity": """
        SELECT day AS activity_date, CAST(sum(is_commit) AS BIGINT) AS commit_count,
               count(DISTINCT repo) AS active_repositories, CAST(sum(minutes) AS BIGINT) AS meeting_minutes,
               CAST(sum(1 - is_commit) AS BIGINT) AS meeting_count
        FROM (SELECT committed_at::DATE AS day, 1 AS is_commit, repository_source_id AS repo, 0 AS minutes
              FROM stg_github_commits
              UNION ALL
              SELECT start_at::DATE, 0, NULL, coalesce(duration_minutes, 0) FROM stg_calendar_events
              WHERE category = 'meeting') happened
        GROUP BY day""",
    "int_calendar_activity": """
        SELECT DISTINCT start_at::DATE AS activity_date, category,
               CAST(sum(duration_minutes) OVER per AS BIGINT) AS minutes, count(*) OVER per AS event_count
        FROM stg_calendar_events WINDOW per AS (PARTITION BY start_at::DATE, category)""",
    "int_project_activity": """
        WITH ranked AS (
            SELECT repository_source_id AS sid, committed_at, count(commit_id) OVER all_of AS n,
                   row_number() OVER (PARTITION BY repository_source_id ORDER BY committed_at DESC) AS place
            FROM stg_github_commits WINDOW all_of AS (PARTITION BY repository_source_id)),
        newest AS (SELECT sid, committed_at, n FROM ranked WHERE place = 1),
        known AS (SELECT repository_key, name, (SELECT committed_at FROM newest WHERE sid = source_id) AS last_active,
                         (SELECT n FROM newest WHERE sid = source_id) AS n
                  FROM stg_github_repositories)
        SELECT repository_key, name, last_active, coalesce(n, 0) AS commit_count,
               CASE WHEN last_active IS NULL THEN 'inactive'
                    WHEN date_diff('microsecond', last_active, (SELECT max(committed_at) FROM newest))
                         <= 14 * 86400000000 THEN 'active' ELSE 'stale' END AS status
        FROM known""",
    "dim_date": """
        WITH days AS (SELECT committed_at::DATE AS d FROM stg_github_commits
                      UNION SELECT start_at::DATE FROM stg_calendar_events),
        ends AS (SELECT min(d) AS a, max(d) AS z FROM days),
        every AS (SELECT a + CAST(k AS INTEGER) AS date FROM ends, range(0, 100000) t(k) WHERE k <= z - a)
        SELECT date, strftime(date, '%A') AS day_of_week,
               CAST(isoyear(date) AS VARCHAR) || '-' || lpad(CAST(weekofyear(date) AS VARCHAR), 2, '0') AS week,
               left(CAST(date AS VARCHAR), 7) AS month, CAST((month(date) + 2) // 3 AS INTEGER) AS quarter,
               CAST(year(date) AS INTEGER) AS year, isodow(date) > 5 AS is_weekend
        FROM every""",
    "dim_repository": """
        SELECT repository_key, github_repository_id, name, owner, language, created_at, archived
        FROM stg_github_repositories""",
    "fct_commits": """
        SELECT commit_key, (SELECT r.repository_key FROM stg_github_repositories r WHERE r.source_id = repository_source_id)
               AS repository_key, commit_id, author, committed_at, additions, deletions
        FROM stg_github_commits""",
    "fct_calendar_events": """
        SELECT event_key, calendar_event_id, start_at, end_at, duration_minutes, category
        FROM stg_calendar_events""",
    "fct_pull_requests": """
        SELECT pr_key, (SELECT r.repository_key FROM stg_github_repositories r WHERE r.source_id = repository_source_id)
               AS repository_key, number, title, state, author, created_at, updated_at, closed_at,
               merged_at, is_draft, comments_count
        FROM stg_github_pull_requests""",
    "fct_issues": """
        SELECT issue_key, (SELECT r.repository_key FROM stg_github_repositories r WHERE r.source_id = repository_source_id)
               AS repository_key, number, title, state, state_reason, author, created_at, updated_at,
               closed_at, comments_count
        FROM stg_github_issues""",
    "fct_email_messages": """
        SELECT message_key, thread_id, sender, recipients, subject, date, snippet
        FROM stg_gmail_messages""",
    "fct_spotify_plays": """
        SELECT play_key, played_at, track_id, track_name, artists FROM stg_spotify_plays""",
    "mart_daily_activity": """
        SELECT date, CAST(sum(a) AS BIGINT) AS commit_count, CAST(sum(b) AS BIGINT) AS active_repositories,
               CAST(sum(c) AS BIGINT) AS meeting_minutes, CAST(sum(d) AS BIGINT) AS meeting_count
        FROM (SELECT date, 0 AS a, 0 AS b, 0 AS c, 0 AS d FROM dim_date
              UNION ALL SELECT * FROM int_daily_activity WHERE activity_date IN (SELECT date FROM dim_date)) every
        GROUP BY date""",
    "mart_project_activity": """
        SELECT repository_key, name, last_active, commit_count, status FROM int_project_activity""",
    "mart_monthly_summary": """
        SELECT month, CAST(count(*) FILTER (WHERE kind = 'commit') AS BIGINT) AS commits,
               count(DISTINCT repo) AS active_repos, CAST(coalesce(sum(minutes), 0) AS BIGINT) AS meeting_minutes,
               CAST(count(*) FILTER (WHERE kind = 'meeting') AS BIGINT) AS meeting_count,
               CAST(count(*) FILTER (WHERE kind = 'busy day') AS BIGINT) AS active_days
        FROM (SELECT left(CAST(committed_at AS VARCHAR), 7) AS month, 'commit' AS kind, repository_key AS repo, NULL AS minutes
              FROM fct_commits
              UNION ALL SELECT left(CAST(start_at AS VARCHAR), 7), 'meeting', NULL, duration_minutes
              FROM fct_calendar_events WHERE category = 'meeting'
              UNION ALL SELECT left(CAST(date AS VARCHAR), 7), CASE WHEN commit_count > 0 THEN 'busy day' ELSE 'day' END,
                               NULL, NULL FROM mart_daily_activity) events_of
        GROUP BY month""",
}


def with_models(select: str) -> str:
    """Prefix `select` with every raw binding and model as CTEs (DuckDB skips unused ones)."""
    ctes = [f"{name} AS ({sql.strip()})" for name, sql in {**RAW, **MODELS}.items()]
    return "WITH " + ",\n".join(ctes) + "\nSELECT * FROM (\n" + select.strip() + "\n) AS q"


def model_sql(name: str) -> str:
    return with_models(f"SELECT * FROM {name}")


def categorize_case(expr: str, rules=None) -> str:
    return categorize_sql(expr) if rules is None else categorize_sql(expr, rules)
