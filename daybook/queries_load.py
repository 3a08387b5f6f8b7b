"""Registered queries for loading: upsert (C), cursors (D), run audit (E).

Scenario: a previous run loaded everything before EXISTING_BEFORE; the current run (at
RUN_NOW) brings the batch from INCOMING_FROM on, overlapping one year, so the batch holds
both updates and inserts. Both sides are whole slices of the bound tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import incremental as D
from .operators import runs as E
from .operators import sync as SY
from .operators import upsert as U
from .plans import marts as M
from .queries import register, wh
from .session import scratch_path
from .sources import bindings as B
from .sources.schemas import KEYS

W = O.with_models

RUN_NOW = "2001-09-01 00:00:00"
EXISTING_BEFORE = "1999-01-01 00:00:00"
INCOMING_FROM = "1998-01-01 00:00:00"
CAL_INCOMING_FROM = "1998-07-01 00:00:00"
FEED_PREV = "2024-01-20 00:00:00"       # previous run of the event-shaped feeds
FEED_FROM = "2024-01-15 00:00:00"       # their current batch (overlapping)
FEED_RUN = "2024-02-01 00:00:00"
LOOKBACK_DAYS = 90

COMMIT_KEYS = list(KEYS["raw_github_commits"])
CAL_KEYS = list(KEYS["raw_calendar_events"])
ISSUE_KEYS = list(KEYS["raw_github_issues"])
CAL_ORDER = ["start_at", "end_at", "title", "timezone", "attendees_count", "status",
             "category", "ingested_at", "updated_at", "raw_payload"]


def _iso(x: str) -> str:
    return (f"(strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({x}, '%f') <> '000000' "
            f"THEN '.' || strftime({x}, '%f') ELSE '' END || '+00:00')")


def _ts(x: str) -> str:
    return f"TIMESTAMP '{x}'"


def _rownum_dedup(src: str, keys: list[str], order: list[str]) -> str:
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {o}) AS __rn FROM {src}) WHERE __rn = 1")


def _upsert_sql(ex: str, inc: str, keys: list[str], cols: list[str], keep=("ingested_at",),
                touch=("updated_at",), now: str = RUN_NOW) -> str:
    on = " AND ".join(f"i.{k} = e.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in keep:
            sel.append(f"coalesce(e.{c}, {_ts(now)}) AS {c}")
        elif c in touch:
            sel.append(f"{_ts(now)} AS {c}")
        else:
            sel.append(f"i.{c} AS {c}")
    return (f"SELECT e.* FROM {ex} e WHERE NOT EXISTS (SELECT 1 FROM {inc} i WHERE {on}) "
            f"UNION ALL SELECT {', '.join(sel)} FROM {inc} i LEFT JOIN {ex} e ON {on}")


# ------------------------------------------------------------------ scenario inputs

def commits_existing(spark, sf) -> DataFrame:
    return B.raw_commits(spark, sf).where(F.col("committed_at") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz"))


def commits_incoming(spark, sf) -> DataFrame:
    r = B.raw_commits(spark, sf).where(F.col("committed_at") >= F.lit(INCOMING_FROM).cast("timestamp_ntz"))
    return r.withColumn("message", F.concat("message", F.lit("*")))


COMMIT_COLS = ["source", "source_id", "repository_source_id", "commit_sha", "author_name",
               "author_email", "committed_at", "additions", "deletions", "message",
               "ingested_at", "updated_at", "raw_payload"]
_SCEN = f"""
    ex_commits AS (SELECT * FROM raw_github_commits WHERE committed_at < {_ts(EXISTING_BEFORE)}),
    inc_commits AS (SELECT * REPLACE (message || '*' AS message) FROM raw_github_commits
                    WHERE committed_at >= {_ts(INCOMING_FROM)})"""


def WS(select: str) -> str:
    """Oracle SQL with the model CTEs plus the scenario CTEs."""
    return W(f"WITH {_SCEN} {select}")


def cal_existing(spark, sf) -> DataFrame:
    r = B.raw_calendar_events(spark, sf).where(F.col("start_at") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz"))
    return U.dedup_last(r, CAL_KEYS, CAL_ORDER)


def cal_incoming(spark, sf) -> DataFrame:
    """Meetings of the batch arrive cancelled: status set, times gone (null)."""
    r = B.raw_calendar_events(spark, sf).where(F.col("start_at") >= F.lit(CAL_INCOMING_FROM).cast("timestamp_ntz"))
    m = F.col("category") == "meeting"
    r = (r.withColumn("status", F.when(m, F.lit("cancelled")).otherwise(F.col("status")))
          .withColumn("start_at", F.when(~m, F.col("start_at")))
          .withColumn("end_at", F.when(~m, F.col("end_at"))))
    return U.dedup_last(r, CAL_KEYS, CAL_ORDER)


CAL_COLS = ["source", "source_id", "calendar_id", "title", "start_at", "end_at", "timezone",
            "attendees_count", "status", "category", "ingested_at", "updated_at", "raw_payload"]
_CAL_SCEN = f"""
    ex_cal AS ({_rownum_dedup(f"(SELECT * FROM raw_calendar_events WHERE start_at < {_ts(EXISTING_BEFORE)})", CAL_KEYS, CAL_ORDER)}),
    inc_cal0 AS (SELECT * REPLACE (
        CASE WHEN category = 'meeting' THEN 'cancelled' ELSE status END AS status,
        CASE WHEN category = 'meeting' THEN NULL ELSE start_at END AS start_at,
        CASE WHEN category = 'meeting' THEN NULL ELSE end_at END AS end_at)
        FROM raw_calendar_events WHERE start_at >= {_ts(CAL_INCOMING_FROM)}),
    inc_cal AS ({_rownum_dedup("inc_cal0", CAL_KEYS, CAL_ORDER)})"""


# ================================================================== C upsert

@register("upsert", WS(_upsert_sql("ex_commits", "inc_commits", COMMIT_KEYS, COMMIT_COLS)))
def upsert(spark, sf):
    return U.upsert(commits_existing(spark, sf), commits_incoming(spark, sf), COMMIT_KEYS, RUN_NOW)


@register("upsert_partitioned", WS(_upsert_sql("ex_commits", "inc_commits", COMMIT_KEYS, COMMIT_COLS)))
def upsert_partitioned(spark, sf):
    """C1 on a raw table partitioned by ingest month: the previous run's rows are loaded
    as they are, then the batch is applied; only the partitions holding batch keys and the
    run's month are read and rewritten."""
    path = f"{scratch_path(spark, 'raw_github_commits')}/table"
    U.upsert_partitioned(commits_existing(spark, sf), path, scratch_path(spark, "stage"),
                         COMMIT_KEYS, RUN_NOW, keep=(), touch=())
    U.upsert_partitioned(commits_incoming(spark, sf), path, scratch_path(spark, "stage"),
                         COMMIT_KEYS, RUN_NOW)
    return spark.read.parquet(path).select(*COMMIT_COLS)


@register("upsert_composite", W(f"WITH {_CAL_SCEN} " + _upsert_sql("ex_cal", "inc_cal", CAL_KEYS, CAL_COLS)))
def upsert_composite(spark, sf):
    return U.upsert(cal_existing(spark, sf), cal_incoming(spark, sf), CAL_KEYS, RUN_NOW)


@register("upsert_counts", WS("""
    , g AS (SELECT source, source_id, count(*) AS n FROM inc_commits GROUP BY 1, 2)
    SELECT CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ex_commits e
                  WHERE e.source = g.source AND e.source_id = g.source_id)) AS BIGINT) AS inserted,
           CAST(sum(n) - count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM ex_commits e
                  WHERE e.source = g.source AND e.source_id = g.source_id)) AS BIGINT) AS updated
    FROM g""".replace("\n    , g AS", ", g AS", 1)))
def upsert_counts(spark, sf):
    return U.upsert_counts(commits_existing(spark, sf), commits_incoming(spark, sf), COMMIT_KEYS)


@register("last_wins_dedup", W(_rownum_dedup("raw_calendar_events", CAL_KEYS, CAL_ORDER)))
def last_wins_dedup(spark, sf):
    return U.dedup_last(B.raw_calendar_events(spark, sf), CAL_KEYS, CAL_ORDER)


@register("last_wins_sequence", W("""
    SELECT source_id, CASE WHEN bool_or(category = 'meeting') THEN 'cancelled' ELSE 'confirmed' END AS status,
           CASE WHEN bool_or(category = 'meeting') THEN 'none' ELSE CAST(max(start_at) AS VARCHAR) END AS start_at
    FROM raw_calendar_events GROUP BY source_id"""))
def last_wins_sequence(spark, sf):
    """C4 by arrival: each event is delivered, and meetings once more as cancelled, without times.
    The later delivery wins though all its values are the smaller ones."""
    ev = B.raw_calendar_events(spark, sf).select(
        "source_id", "status", F.date_format("start_at", "yyyy-MM-dd HH:mm:ss").alias("start_at"), "category")
    gone = ev.where(F.col("category") == "meeting").select("source_id", F.lit("cancelled").alias("status"), F.lit(None).cast("string").alias("start_at"))
    both = ev.drop("category").withColumn("seq", F.lit(0)).unionByName(gone.withColumn("seq", F.lit(1)))
    last = U.dedup_last(both, ["source_id"], ["seq", "start_at"])  # some ids are in the data twice
    return last.select("source_id", "status", F.coalesce("start_at", F.lit("none")).alias("start_at"))


ISSUE_COLS = ["source", "source_id", "repository_source_id", "number", "title", "state",
              "state_reason", "author", "created_at", "updated_at", "closed_at",
              "comments_count", "ingested_at", "raw_payload"]


def issues_existing(spark, sf):
    return B.raw_issues(spark, sf).where(F.col("created_at") < F.lit(FEED_PREV).cast("timestamp_ntz"))


def issues_incoming(spark, sf):
    """Issues re-delivered later by the source: closed, with the source's new updated_at."""
    r = B.raw_issues(spark, sf).where(F.col("created_at") >= F.lit(FEED_FROM).cast("timestamp_ntz"))
    upd = F.col("updated_at") + F.expr("INTERVAL 1 DAY")
    return (r.withColumn("state", F.lit("closed"))
             .withColumn("closed_at", F.coalesce(F.col("closed_at"), upd))
             .withColumn("updated_at", upd))


@register("audit_columns", W(f"""
    WITH ex_i AS (SELECT * FROM raw_github_issues WHERE created_at < {_ts(FEED_PREV)}),
    inc_i AS (SELECT * REPLACE ('closed' AS state,
                               coalesce(closed_at, updated_at + INTERVAL 1 DAY) AS closed_at,
                               updated_at + INTERVAL 1 DAY AS updated_at)
              FROM raw_github_issues WHERE created_at >= {_ts(FEED_FROM)}),
    up AS ({_upsert_sql("ex_i", "inc_i", ISSUE_KEYS, ISSUE_COLS, touch=(), now=FEED_RUN)})
    SELECT source_id, state, closed_at, ingested_at, updated_at FROM up"""))
def audit_columns(spark, sf):
    """`ingested_at` kept from the first insert; `updated_at` is the source's value."""
    u = U.upsert(issues_existing(spark, sf), issues_incoming(spark, sf), ISSUE_KEYS, FEED_RUN,
                 keep=("ingested_at",), touch=())
    return u.select("source_id", "state", "closed_at", "ingested_at", "updated_at")


@register("not_null_keys", W("""
    SELECT commit_key, commit_id FROM fct_commits WHERE repository_key IS NULL OR commit_id IS NULL"""))
def not_null_keys(spark, sf):
    """Commits keyed by (repository_key, commit_id); rows whose key part is null are rejected
    (orphans, and commits without an id)."""
    w = wh(spark, sf)
    keyed = M.resolve_fk(w.stg_commits, w.stg_repositories, "repository_source_id", "source_id", "repository_key")
    _, bad = U.split_null_keys(keyed, ["repository_key", "commit_id"])
    return bad.select("commit_key", "commit_id")


# ================================================================== D cursors

def state0(spark, sf) -> DataFrame:
    """sync_state as the previous runs left it: per-repository commit cursors and
    per-repository issue/PR cursors."""
    c = B.raw_commits(spark, sf).where(F.col("committed_at") < F.lit(EXISTING_BEFORE).cast("timestamp_ntz"))
    s1 = D.state_rows("github", D.new_cursors(c, "repository_source_id", "committed_at"), EXISTING_BEFORE)
    feed = (B.raw_issues(spark, sf).select("repository_source_id", "updated_at")
            .unionByName(B.raw_pull_requests(spark, sf).select("repository_source_id", "updated_at"))
            .where(F.col("updated_at") < F.lit(FEED_PREV).cast("timestamp_ntz")))
    s2 = D.state_rows("github_issues", D.new_cursors(feed, "repository_source_id", "updated_at"), FEED_PREV)
    return s1.unionByName(s2)


_STATE_SQL = f"""
    state0 AS (
        SELECT 'github' AS connector, repository_source_id AS entity_key,
               {_ts(EXISTING_BEFORE)} AS last_successful_sync, {_iso('max(committed_at)')} AS last_cursor,
               {_ts(EXISTING_BEFORE)} AS source_updated_at, {_ts(EXISTING_BEFORE)} AS updated_at
        FROM raw_github_commits WHERE committed_at < {_ts(EXISTING_BEFORE)} GROUP BY 2
        UNION ALL
        SELECT 'github_issues', repository_source_id, {_ts(FEED_PREV)}, {_iso('max(updated_at)')},
               {_ts(FEED_PREV)}, {_ts(FEED_PREV)}
        FROM (SELECT repository_source_id, updated_at FROM raw_github_issues
              UNION ALL SELECT repository_source_id, updated_at FROM raw_github_pull_requests) f
        WHERE updated_at < {_ts(FEED_PREV)} GROUP BY 2),
    batch AS (
        SELECT c.* FROM raw_github_commits c LEFT JOIN (
            SELECT entity_key, CAST(replace(last_cursor, '+00:00', '') AS TIMESTAMP) AS since
            FROM state0 WHERE connector = 'github') s ON c.repository_source_id = s.entity_key
        WHERE c.committed_at >= coalesce(s.since, {_ts(RUN_NOW)} - INTERVAL {LOOKBACK_DAYS} DAY))"""


def WD(select: str) -> str:
    return W(f"WITH {_STATE_SQL} {select}")


def batch(spark, sf) -> DataFrame:
    since = F.lit(RUN_NOW).cast("timestamp_ntz") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    return D.select_since(B.raw_commits(spark, sf), state0(spark, sf), "github",
                          "repository_source_id", "committed_at", default_since=since)


@register("cursor_lookup", WD("SELECT entity_key, last_cursor FROM state0 WHERE connector = 'github'"))
def cursor_lookup(spark, sf):
    return D.get_cursors(state0(spark, sf), "github")


@register("incremental_by_entity", WD("SELECT source_id, repository_source_id, committed_at FROM batch"))
def incremental_by_entity(spark, sf):
    return batch(spark, sf).select("source_id", "repository_source_id", "committed_at")


_STATE_COLS = "connector, entity_key, last_successful_sync, last_cursor, source_updated_at, updated_at"


def _state_upsert_sql(new: str) -> str:
    return (f"SELECT s.* FROM state0 s WHERE NOT EXISTS (SELECT 1 FROM ({new}) n "
            f"WHERE n.connector = s.connector AND n.entity_key = s.entity_key) "
            f"UNION ALL SELECT {_STATE_COLS} FROM ({new}) n")


@register("cursor_advance", WD(_state_upsert_sql(
    f"SELECT 'github' AS connector, repository_source_id AS entity_key, {_ts(RUN_NOW)} AS last_successful_sync, "
    f"{_iso('max(committed_at)')} AS last_cursor, {_ts(RUN_NOW)} AS source_updated_at, "
    f"{_ts(RUN_NOW)} AS updated_at FROM batch GROUP BY 2")))
def cursor_advance(spark, sf):
    """D3: new cursor per repository = newest commit of the batch; others keep theirs."""
    return D.advance(state0(spark, sf), batch(spark, sf), "github", "repository_source_id",
                     "committed_at", RUN_NOW)


@register("state_upsert", WD(_state_upsert_sql(
    f"SELECT 'github_issues' AS connector, repository_source_id AS entity_key, "
    f"{_ts(FEED_RUN)} AS last_successful_sync, {_iso('max(updated_at)')} AS last_cursor, "
    f"{_ts(FEED_RUN)} AS source_updated_at, {_ts(FEED_RUN)} AS updated_at FROM ("
    f"SELECT repository_source_id, updated_at FROM raw_github_issues UNION ALL "
    f"SELECT repository_source_id, updated_at FROM raw_github_pull_requests) f "
    f"WHERE updated_at >= {_ts(FEED_FROM)} GROUP BY 2")))
def state_upsert(spark, sf):
    """issue/PR cursors (max updated_at over issues and PRs together) upserted into state."""
    feed = (B.raw_issues(spark, sf).select("repository_source_id", "updated_at")
            .unionByName(B.raw_pull_requests(spark, sf).select("repository_source_id", "updated_at"))
            .where(F.col("updated_at") >= F.lit(FEED_FROM).cast("timestamp_ntz")))
    rows = D.state_rows("github_issues", D.new_cursors(feed, "repository_source_id", "updated_at"), FEED_RUN)
    return D.upsert_state(state0(spark, sf), rows, FEED_RUN)


@register("partial_failure", WD("""
    SELECT b.source_id, b.repository_source_id FROM batch b WHERE NOT EXISTS (
        SELECT 1 FROM raw_github_repositories r WHERE r.archived AND r.source_id = b.repository_source_id)"""))
def partial_failure(spark, sf):
    """Feeds of archived repositories "failed": their rows are skipped, others load."""
    failed = B.raw_repositories(spark, sf).where(F.col("archived"))
    return D.drop_failed(batch(spark, sf), failed, "repository_source_id", "source_id").select(
        "source_id", "repository_source_id")


@register("cursor_primary", W(f"""
    SELECT 'gmail' AS connector, 'primary' AS entity_key,
           {_iso(f"coalesce(max(date), {_ts(FEED_RUN)})")} AS last_cursor
    FROM raw_gmail_messages WHERE date >= {_ts(FEED_PREV)}
    UNION ALL
    SELECT 'gmail_empty', 'primary', {_iso(f"coalesce(max(date), {_ts(FEED_RUN)})")}
    FROM raw_gmail_messages WHERE date >= {_ts(FEED_RUN)}
    UNION ALL
    SELECT 'calendar', 'primary', {_iso(_ts(FEED_RUN))}
    FROM (SELECT count(*) FROM raw_calendar_events) x"""))
def cursor_primary(spark, sf):
    """Single-entity cursors: mail = newest message or the run start when nothing new;
    calendar = always the run start."""
    m = B.raw_emails(spark, sf)
    t = F.lit(FEED_PREV).cast("timestamp_ntz")
    r = F.lit(FEED_RUN).cast("timestamp_ntz")
    a = D.primary_cursor(m.where(F.col("date") >= t), "date", FEED_RUN).select(
        F.lit("gmail").alias("connector"), "*")
    b = D.primary_cursor(m.where(F.col("date") >= r), "date", FEED_RUN).select(
        F.lit("gmail_empty").alias("connector"), "*")
    c = D.primary_cursor(B.raw_calendar_events(spark, sf), "start_at", FEED_RUN, empty="start").select(
        F.lit("calendar").alias("connector"), "*")
    return a.unionByName(b).unionByName(c)


@register("window_backfill", W(f"""
    SELECT source_id, start_at FROM raw_calendar_events
    WHERE start_at BETWEEN {_ts(RUN_NOW)} - INTERVAL {LOOKBACK_DAYS} DAY AND {_ts(RUN_NOW)}"""))
def window_backfill(spark, sf):
    """First calendar sync reads the look-back window [run - 90 days, run]."""
    lo = F.lit(RUN_NOW).cast("timestamp_ntz") - F.expr(f"INTERVAL {LOOKBACK_DAYS} DAYS")
    return D.select_window(B.raw_calendar_events(spark, sf), "start_at", lo, RUN_NOW).select(
        "source_id", "start_at")


DAY_CURSOR_BEFORE = "2024-01-15 12:00:00"


@register("cursor_day_granular", W(f"""
    WITH cur AS (SELECT max(date) AS c FROM raw_gmail_messages WHERE date < {_ts(DAY_CURSOR_BEFORE)})
    SELECT m.source_id, m.date, strftime(cur.c, '%Y/%m/%d') AS after_day
    FROM raw_gmail_messages m, cur WHERE m.date >= date_trunc('day', cur.c)"""))
def cursor_day_granular(spark, sf):
    """Mail cursor floored to its day; the cursor day is re-read (absorbed by upsert)."""
    m = B.raw_emails(spark, sf)
    prev = m.where(F.col("date") < F.lit(DAY_CURSOR_BEFORE).cast("timestamp_ntz"))
    cursor = D.primary_cursor(prev, "date", DAY_CURSOR_BEFORE)
    cur_ts = cursor.select(D.cursor_time("last_cursor").alias("c")).scalar()
    return D.select_from_day(m, "date", cur_ts).select(
        "source_id", "date", D.day_query(cur_ts).alias("after_day"))


@register("cursor_epoch_ms", W(f"""
    WITH cur AS (SELECT CAST(epoch_us(max(played_at)) // 1000 AS VARCHAR) AS c
                 FROM raw_spotify_plays WHERE played_at < {_ts(FEED_PREV)})
    SELECT p.source_id, p.played_at, cur.c AS after_ms FROM raw_spotify_plays p, cur
    WHERE p.played_at >= make_timestamp(CAST(cur.c AS BIGINT) * 1000)"""))
def cursor_epoch_ms(spark, sf):
    """Plays cursor = epoch milliseconds (truncated) as text; next read from it on."""
    p = B.raw_plays(spark, sf)
    prev = p.where(F.col("played_at") < F.lit(FEED_PREV).cast("timestamp_ntz"))
    cur = D.primary_cursor(prev, "played_at", FEED_RUN, kind="ms")
    c = cur.select("last_cursor").scalar()
    return p.where(F.col("played_at") >= D.cursor_time(c, "ms")).select(
        "source_id", "played_at", c.alias("after_ms"))


# ================================================================== E run audit

@register("record_run", WS(f"""
    , failed AS (SELECT DISTINCT r.source_id FROM raw_github_repositories r
                 JOIN inc_commits i ON i.repository_source_id = r.source_id WHERE r.archived),
    loaded AS (SELECT i.* FROM inc_commits i
               WHERE i.repository_source_id NOT IN (SELECT source_id FROM failed)),
    fresh AS (SELECT count(DISTINCT (l.source, l.source_id)) AS n FROM loaded l
              LEFT JOIN ex_commits e ON e.source = l.source AND e.source_id = l.source_id WHERE e.source_id IS NULL),
    repos AS (SELECT count(*) AS n, count(*) FILTER (WHERE CAST(source_id AS BIGINT) % 3 = 0) AS fresh
              FROM raw_github_repositories)
    SELECT md5('github|{RUN_NOW}') AS run_id, 'github' AS source,
           {_ts(RUN_NOW)} AS started_at, {_ts(RUN_NOW)} + INTERVAL 5 MINUTE AS finished_at,
           CASE WHEN (SELECT count(*) FROM failed) > 0 THEN 'partial' ELSE 'success' END AS status,
           CAST(repos.n + (SELECT count(*) FROM loaded) AS INTEGER) AS records_fetched,
           CAST(repos.fresh + fresh.n AS INTEGER) AS records_inserted,
           CAST(repos.n - repos.fresh + (SELECT count(*) FROM loaded) - fresh.n AS INTEGER) AS records_updated,
           CAST((SELECT count(*) FROM failed) AS INTEGER) AS records_failed,
           CAST(NULL AS VARCHAR) AS error_message
    FROM fresh, repos""".replace("\n    , failed AS", ", failed AS", 1)))
def record_run(spark, sf):
    """The audit row of the commit run. Repositories count like commits; rows of failed entities
    (archived repositories with rows in the batch) are in no count but `records_failed`, which is
    the number of entities. A third of the repositories is new."""
    repos = B.raw_repositories(spark, sf)
    before = repos.where(F.col("source_id").cast("long") % 3 != 0)
    inc = commits_incoming(spark, sf)
    archived = repos.where(F.col("archived")).select(F.col("source_id").alias("__r"))
    failed = inc.join(archived, inc["repository_source_id"] == archived["__r"], "left_semi").select(
        F.col("repository_source_id").alias("entity")).distinct()
    row = SY.github_run(repos, before, inc, commits_existing(spark, sf), failed, RUN_NOW,
                        run_id=F.md5(F.lit(f"github|{RUN_NOW}")))
    return row.withColumn("finished_at", F.lit(RUN_NOW).cast("timestamp_ntz") + F.expr("INTERVAL 5 MINUTES"))


@register("run_status_rule", W("""
    SELECT run_id, source, status, records_fetched, records_failed FROM pipeline_runs"""))
def run_status_rule(spark, sf):
    """Failed (all records failed) > partial (some) > success, per run of the log."""
    return B.pipeline_runs(spark, sf).select("run_id", "source", "status", "records_fetched",
                                             "records_failed")


@register("recent_runs", W("""
    SELECT run_id, source, status, date_trunc('second', started_at) AS started_at,
           records_fetched, records_inserted, records_updated, records_failed
    FROM pipeline_runs ORDER BY started_at DESC, run_id DESC LIMIT 10"""))
def recent_runs(spark, sf):
    """The 10 latest runs (top-k is the feature here)."""
    return E.recent_runs(B.pipeline_runs(spark, sf), 10)
