"""Registered queries for ingest: landing pages (A1), normalisers (B1-B10), storage (A2-A5).

Spark builds the services' JSON from the driver tables (`sources.service_json`) and
normalises it back; the oracle selects the expected values straight from the driver tables,
so each query is a lossless round trip over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle as O
from .operators import normalize as N
from .operators import upsert as U
from .operators import load
from .operators.quality import union_all
from .plans.build import MART_MODELS, VIEW_MODELS
from .queries import _MODEL_QUERIES, register, wh
from .session import scratch_path
from .sources import bindings as B
from .sources import landing as L
from .sources import service_json as J

W = O.with_models
RUN_NOW = "2024-02-01 00:00:00"
_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_MS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"


def _out(df: DataFrame, drop=("ref", "raw_payload", "_error", "repo_full_name", "repo_source_id", "day")) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in drop])


def _good(df: DataFrame) -> DataFrame:
    good, _ = N.split_malformed(df)
    return _out(good)


# ================================================================== A1

@register("page_flatten", """
    SELECT 'array' AS shape, CAST(o_orderkey AS VARCHAR) AS id FROM orders
    UNION ALL SELECT 'items', CAST(event_id AS VARCHAR) FROM events
    UNION ALL SELECT 'messages', CAST(event_id AS VARCHAR) FROM events""")
def page_flatten(spark, sf):
    """Bare-array pages (commits), `items` pages (plays), `messages` pages (mail stubs), plus
    pages without a list or with an empty list (no rows)."""
    page = lambda ref: F.floor(F.col(ref) / 100)  # noqa: E731 - ids are unique: <= 100 per page
    commits = L.build_pages(J.commit_records(spark, sf), "record", page("ref"))
    plays = L.build_pages(J.play_records(spark, sf), "record", page("ref"), "items")
    stubs = B.table(spark, sf, "events").select(
        F.col("event_id").alias("ref"),
        F.to_json(F.struct(F.col("event_id").cast("string").alias("id"),
                           F.col("user_id").cast("string").alias("threadId"))).alias("record"))
    mail = L.build_pages(stubs, "record", page("ref"), "messages")
    empty = B.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("page"), F.lit('{"nextPageToken": null}').alias("payload"))
    blank = B.table(spark, sf, "region").select(F.col("r_regionkey").alias("page"), F.lit("[]").alias("payload"))
    a = L.flatten_pages(commits.unionByName(blank), "payload").select(
        F.lit("array").alias("shape"), F.get_json_object("record", "$.sha").alias("id"))
    i = L.flatten_pages(plays.unionByName(empty), "payload", "items").select(
        F.lit("items").alias("shape"), F.get_json_object("record", "$.track.id").alias("id"))
    m = L.flatten_pages(mail.unionByName(empty), "payload", "messages").select(
        F.lit("messages").alias("shape"), F.get_json_object("record", "$.id").alias("id"))
    return a.unionByName(i).unionByName(m)


# ================================================================== B1-B8

@register("norm_repo", """
    SELECT 'github' AS source, CAST(c_nationkey AS VARCHAR) || '/' || c_name AS source_id,
           c_custkey AS github_repository_id, c_name AS name, CAST(c_nationkey AS VARCHAR) AS owner,
           CAST(c_nationkey AS VARCHAR) || '/' || c_name AS full_name, c_mktsegment AS language,
           TIMESTAMP '2020-01-01 00:00:00' AS created_at, c_acctbal < 0 AS archived
    FROM customer""")
def norm_repo(spark, sf):
    return _good(N.normalize_repos(J.repo_records(spark, sf)))


@register("norm_commit", """
    SELECT 'github' AS source,
           CAST(o_custkey AS VARCHAR) || '/repo:' || CAST(o_orderkey AS VARCHAR) AS source_id,
           CAST(o_custkey AS VARCHAR) || '/repo' AS repository_source_id,
           CAST(o_orderkey AS VARCHAR) AS commit_sha, o_orderpriority AS author_name,
           CASE WHEN o_orderstatus = 'F' THEN 'dev' || CAST(o_custkey AS VARCHAR) || '@example.com'
                ELSE '' END AS author_email,
           o_orderdate AS committed_at, CAST(NULL AS INTEGER) AS additions,
           CAST(NULL AS INTEGER) AS deletions, o_orderstatus AS message
    FROM orders""")
def norm_commit(spark, sf):
    return _good(N.normalize_commits(J.commit_records(spark, sf), "repo_full_name", "repo_source_id"))


@register("split_issue_pr", """
    SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'pr' ELSE 'issue' END AS kind,
           'N_' || CAST(event_id AS VARCHAR) AS source_id
    FROM events""")
def split_issue_pr(spark, sf):
    """One pass routes the feed; each record is looked at once."""
    routed = N.route_issues_prs(J.issue_feed_records(spark, sf))
    return routed.select("kind", F.get_json_object("record", "$.node_id").alias("source_id"))


_CLOSED = "event_type IN ('purchase', 'error')"
_ISSUE_SQL = f"""
    SELECT 'github' AS source, 'N_' || CAST(event_id AS VARCHAR) AS source_id,
           CAST(user_id AS VARCHAR) AS repository_source_id, CAST(event_id AS INTEGER) AS number,
           event_type AS title, CASE WHEN {_CLOSED} THEN 'closed' ELSE 'open' END AS state,
           {{extra}}
           CASE WHEN event_type <> 'view' THEN 'user' || CAST(user_id AS VARCHAR) END AS author,
           ts AS created_at, ts + INTERVAL 1 HOUR AS updated_at,
           CASE WHEN {_CLOSED} THEN ts + INTERVAL 2 HOUR END AS closed_at,
           CASE WHEN {_K} >= 10 THEN {_K} ELSE 0 END AS comments_count
    FROM events WHERE event_type {{op}} ('error', 'signup')"""


@register("norm_issue", _ISSUE_SQL.format(
    extra=f"CASE WHEN {_CLOSED} THEN 'completed' END AS state_reason,", op="NOT IN"))
def norm_issue(spark, sf):
    issues, _ = N.split_issues_prs(J.issue_feed_records(spark, sf))
    return _good(N.normalize_issues(issues, "repo_source_id"))


@register("norm_pr", _ISSUE_SQL.format(
    extra="CASE WHEN event_type = 'error' THEN ts + INTERVAL 3 HOUR END AS merged_at, "
          "event_type = 'signup' AS is_draft,", op="IN"))
def norm_pr(spark, sf):
    _, prs = N.split_issues_prs(J.issue_feed_records(spark, sf))
    return _good(N.normalize_prs(prs, "repo_source_id"))


_ZONE_SQL = " ".join(f"WHEN {n} THEN '{z}'" for n, z in J.ZONES.items())


@register("norm_calendar", f"""
    WITH li AS (SELECT *, CASE l_linenumber {_ZONE_SQL} END AS z FROM lineitem),
    li2 AS (SELECT *, CASE WHEN z IS NULL OR z = 'No/Such' THEN 'UTC' ELSE z END AS ez,
                   l_shipdate + INTERVAL 9 HOUR AS s9,
                   l_shipdate + INTERVAL 9 HOUR + to_minutes(CAST(l_quantity AS INTEGER)) AS e9
            FROM li)
    SELECT 'calendar' AS source,
           CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS source_id,
           'primary' AS calendar_id,
           CASE WHEN l_returnflag = 'R' THEN 'Weekly sync' WHEN l_returnflag = 'A' THEN 'Write design doc'
                WHEN l_linestatus = 'O' THEN 'Lunch break' ELSE '' END AS title,
           CASE WHEN l_returnflag = 'R' THEN s9 + INTERVAL 4 HOUR
                WHEN l_returnflag = 'A' THEN timezone('UTC', timezone(ez, s9))
                WHEN l_linestatus = 'O' THEN timezone('UTC', timezone(ez, l_shipdate)) END AS start_at,
           CASE WHEN l_returnflag = 'R' THEN e9 + INTERVAL 4 HOUR
                WHEN l_returnflag = 'A' THEN timezone('UTC', timezone(ez, e9))
                WHEN l_linestatus = 'O' THEN timezone('UTC', timezone(ez, l_shipdate + INTERVAL 2 DAY))
           END AS end_at,
           CASE WHEN l_returnflag <> 'R' AND (l_returnflag = 'A' OR l_linestatus = 'O')
                THEN coalesce(z, 'UTC') ELSE 'UTC' END AS timezone,
           CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS attendees_count,
           CASE WHEN l_returnflag IN ('R', 'A') THEN 'confirmed'
                WHEN l_linestatus = 'O' THEN 'tentative' ELSE 'cancelled' END AS status,
           CASE WHEN l_returnflag = 'R' THEN 'meeting' WHEN l_returnflag = 'A' THEN 'work'
                WHEN l_linestatus = 'O' THEN 'personal' ELSE 'other' END AS category
    FROM li2""")
def norm_calendar(spark, sf):
    return _good(N.normalize_calendar(J.calendar_records(spark, sf), "primary"))


_MAIL_BAD = f"(event_type = 'error' AND {_K} >= 95) OR (event_type = 'signup' AND {_K} >= 98)"


@register("norm_email", f"""
    SELECT 'gmail' AS source, CAST(event_id AS VARCHAR) AS source_id,
           CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) ELSE '' END AS thread_id,
           CASE WHEN event_type <> 'click' THEN 'user' || CAST(user_id AS VARCHAR) || '@example.com'
                ELSE '' END AS sender,
           CASE WHEN event_type <> 'click' THEN 'me@example.com' ELSE '' END AS recipients,
           CASE WHEN event_type <> 'click' THEN event_type ELSE '' END AS subject,
           {_MS} AS date, props AS snippet
    FROM events WHERE NOT ({_MAIL_BAD})""")
def norm_email(spark, sf):
    return _good(N.normalize_emails(J.email_records(spark, sf)))


_PLAY_SQL = f"""
    SELECT 'spotify' AS source,
           CAST(event_id AS VARCHAR) || ':' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS source_id,
           {_MS} AS played_at, CAST(event_id AS VARCHAR) AS track_id,
           CASE WHEN event_type <> 'view' THEN event_type ELSE '' END AS track_name,
           CASE WHEN event_type = 'purchase' THEN 'artist ' || CAST(user_id AS VARCHAR) || ', guest'
                WHEN event_type = 'view' THEN ''
                ELSE 'artist ' || CAST(user_id AS VARCHAR) END AS artists
    FROM events"""


@register("norm_play", _PLAY_SQL)
def norm_play(spark, sf):
    return _good(N.normalize_plays(J.play_records(spark, sf)))


@register("quarantine", f"""
    SELECT event_id AS ref,
           CASE WHEN event_type = 'signup' THEN 'not a JSON object' ELSE 'bad internalDate' END AS reason
    FROM events WHERE {_MAIL_BAD}""")
def quarantine(spark, sf):
    """Malformed mail records are set aside with a reason; the rest of the batch loads."""
    _, bad = N.split_malformed(N.normalize_emails(J.email_records(spark, sf)))
    return bad.select("ref", F.col("_error").alias("reason"))


# ================================================================== A2-A5

@register("raw_scan", W("SELECT * FROM raw_github_commits"))
def raw_scan(spark, sf):
    """A2: the current snapshot of a raw table, read with its declared schema."""
    root = scratch_path(spark, "raw")
    L.write_table(B.raw_commits(spark, sf), root, "raw_github_commits")
    return L.read_table(spark, root, "raw_github_commits")


@register("raw_sink", f"""
    SELECT p.*, TIMESTAMP '{RUN_NOW}' AS ingested_at,
           TIMESTAMP '{RUN_NOW}' AS updated_at FROM ({_PLAY_SQL}) p""")
def raw_sink(spark, sf):
    """A3: landed play pages (each twice, with some that can't be read) go through the load path: rejects
    are stored, the last delivered row of a key is stamped with the run time -> new snapshot + pointer; the
    query reads the published snapshot back."""
    pages = L.build_pages(J.play_records(spark, sf), "record", F.floor(F.col("ref") / 100), "items").select("payload")
    down = B.table(spark, sf, "nation").select(F.lit("<html>502 Bad Gateway</html>").alias("payload"))
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    for part in (pages.unionByName(down), pages):
        part.write.mode("append").text(landing)
    feed = load.Feed("raw_spotify_plays", N.normalize_plays, "items")
    load.apply_batch(L.read_pages(spark, landing), feed, root, RUN_NOW, batch_id=0, scratch=scratch_path(spark, "stage"),
                     quarantine=scratch_path(spark, "rejected"), partitioned=False)
    return L.read_table(spark, root, "raw_spotify_plays").drop("raw_payload")


@register("mart_sink", O.model_sql("mart_daily_activity"))
def mart_sink(spark, sf):
    """A4: all marts are built and published together (staging stays lazy views)."""
    root = scratch_path(spark, "marts")
    wh(spark, sf).build(root)
    return L.read_release(spark, root)["mart_daily_activity"]


def _model_rows() -> str:
    names = {attr: oracle for attr, oracle in _MODEL_QUERIES.values()}
    return W("\nUNION ALL\n".join(
        f"SELECT '{attr}' AS model, '{kind}' AS kind, CAST(count(*) AS BIGINT) AS \"rows\" FROM {names[attr]}"
        for kind, models in (("table", MART_MODELS), ("view", VIEW_MODELS)) for attr in models))


@register("warehouse_build", _model_rows())
def warehouse_build(spark, sf):
    """A4: the whole warehouse built and published by one pointer: rows of its 11 tables, as a reader of the
    release finds them, and of its 10 views."""
    root = scratch_path(spark, "marts")
    wh(spark, sf).build(root)
    found = L.read_release(spark, root)
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("model"), F.lit("table").alias("kind"), "rows")
             for name, df in sorted(found.items())]
    parts += [spark.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("model"), F.lit("view").alias("kind"), "rows")
              for name in VIEW_MODELS]
    return union_all(parts)


@register("purge_source", W("""
    SELECT source, source_id FROM (
        SELECT source, source_id FROM raw_gmail_messages
        UNION ALL SELECT source, source_id FROM raw_spotify_plays
        UNION ALL SELECT source, source_id FROM raw_github_commits) u
    WHERE source <> 'gmail'"""))
def purge_source(spark, sf):
    """A5: delete one source's imported rows (here: mail) from the raw data."""
    u = (B.raw_emails(spark, sf).select("source", "source_id")
         .unionByName(B.raw_plays(spark, sf).select("source", "source_id"))
         .unionByName(B.raw_commits(spark, sf).select("source", "source_id")))
    return U.purge(u, "gmail")

