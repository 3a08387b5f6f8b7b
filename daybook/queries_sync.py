"""Registered batch syncs: two runs of each service over landed pages, the second from the cursors
of the first. A query reports both audit rows and the greatest cursor after each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import parse_iso_ts
from .operators import incremental as D
from .operators import normalize as N
from .operators import sync as SY
from .operators.load import Feed
from .queries import register
from .session import scratch_path, staged
from .sources import bindings as B
from .sources import landing as L
from .sources import service_json as J
from .sources.schemas import RAW, SYNC_STATE

FIRST, SECOND = "2024-01-20 00:00:00", "2024-02-01 00:00:00"
GIT_FIRST, GIT_SECOND = "1999-01-01 00:00:00", "2001-09-01 00:00:00"
DAYS = 90


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _before(s: str):
    return _ts(s) - F.expr(f"INTERVAL {DAYS} DAYS")


def _logged(audit: DataFrame, log: str, now: str) -> DataFrame:
    """The audit row of the run that began at `now`, from the audit table that it is added to."""
    audit.write.mode("append").parquet(log)
    return audit.sparkSession.read.schema(audit.schema).parquet(log).where(F.col("started_at") == _ts(now))


def _pages(records: DataFrame, list_key: str | None, *by: str) -> DataFrame:
    """Pages of at most 100 records (ids are unique), of one entity each if `by` names it. They are landed:
    each job of a run reads them, and must not build them again."""
    g = records.groupBy(*by, F.floor(F.col("ref") / 100).alias("page")).agg(F.collect_list("record").alias("r"))
    body = F.concat(F.lit("["), F.array_join("r", ","), F.lit("]"))
    if list_key is not None:
        body = F.concat(F.lit(f'{{"{list_key}":'), body, F.lit("}"))
    return staged(g.select(*by, body.alias("payload"), F.struct(*by, "page").alias(L.ARRIVAL)), "pages")


def _report(connector: str, *runs: SY.Run) -> DataFrame:
    out = None
    for k, r in enumerate(runs, 1):
        cursor = D.get_cursors(r.state, connector).agg(F.max("last_cursor")).scalar()
        row = r.audit.select(F.lit(k).alias("run"), "status", "records_fetched", "records_inserted", "records_updated",
                             "records_failed", cursor.alias("cursor"))
        out = row if out is None else out.unionByName(row)
    return out


def _empty(spark, feed: Feed) -> DataFrame:
    return spark.createDataFrame([], RAW[feed.table])


def _two_runs(spark, connector: str, feed: Feed, pages1: DataFrame, pages2: DataFrame, first, since, **kw) -> DataFrame:
    none, log = spark.createDataFrame([], SYNC_STATE), scratch_path(spark, "audit")
    with SY.recorded(spark, connector, FIRST, log):
        one = SY.sync_single(connector, pages1, feed, _empty(spark, feed), none, FIRST, since=first, **kw)
        one.state = staged(one.state, "state")
        table = staged(one.tables[feed.table], feed.table)
        one.audit = _logged(one.audit, log, FIRST)
        one.release()
    with SY.recorded(spark, connector, SECOND, log):
        last = D.get_cursors(one.state, connector, "primary").select("last_cursor").scalar()
        two = SY.sync_single(connector, pages2, feed, table, one.state, SECOND, since=since(last), **kw)
        two.state = staged(two.state, "state")
        two.audit = _logged(two.audit, log, SECOND)
        two.release()
    return _report(connector, one, two)


def _sql(first: str, second: str, cursor1: str, cursor2: str, ctes: str) -> str:
    """Two audit rows from r1 (rows of the first run: id) and r2 (of the second: id)."""
    def row(k, fetched, old, cursor):
        return (f"SELECT {k} AS run, 'success' AS status, CAST(({fetched}) AS INTEGER) AS records_fetched, "
                f"CAST(({fetched}) - ({old}) AS INTEGER) AS records_inserted, CAST(({old}) AS INTEGER) AS records_updated, "
                f"0 AS records_failed, {cursor} AS cursor")

    return (f"WITH {ctes} " + row(1, "SELECT count(*) FROM r1", "SELECT 0", cursor1) + " UNION ALL "
            + row(2, "SELECT count(*) FROM r2", "SELECT count(*) FROM r2 WHERE id IN (SELECT id FROM r1)", cursor2))


def _iso(x: str) -> str:
    return (f"(strftime({x}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({x}, '%f') <> '000000' "
            f"THEN '.' || strftime({x}, '%f') ELSE '' END || '+00:00')")


# ------------------------------------------------------------------ single-entity services

@register("sync_calendar", _sql(FIRST, SECOND, _iso(f"TIMESTAMP '{FIRST}'"), _iso(f"TIMESTAMP '{SECOND}'"), f"""
    e AS (SELECT event_id AS id, ts, ts + to_days(CAST(event_id % 10 AS INTEGER)) AS changed FROM events),
    r1 AS (SELECT id FROM e WHERE ts BETWEEN TIMESTAMP '{FIRST}' - INTERVAL {DAYS} DAY AND TIMESTAMP '{FIRST}'),
    r2 AS (SELECT id FROM e WHERE changed >= TIMESTAMP '{FIRST}')"""))
def sync_calendar(spark, sf):
    """The first run reads a window of start times; the next one what the service changed since then
    (the payload's update time), cancelled events included."""
    e = B.table(spark, sf, "events")
    at = F.struct(F.concat(F.date_format("ts", J.ISO_US), F.lit("Z")).alias("dateTime"))
    days = F.make_dt_interval((F.col("event_id") % 10).cast("int"))
    rec = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), at.alias("start"), at.alias("end"),
                             F.concat(F.date_format(F.col("ts") + days, J.ISO_US), F.lit("Z")).alias("updated")))
    pages = _pages(e.select(F.col("event_id").alias("ref"), rec.alias("record")), "items")
    feed = Feed("raw_calendar_events", lambda d: N.normalize_calendar(d, "primary"), "items")
    changed = parse_iso_ts(F.get_json_object("raw_payload", "$.updated"))
    return _two_runs(spark, "calendar", feed, pages, pages, F.col("start_at").between(_before(FIRST), _ts(FIRST)),
                     lambda last: changed >= D.cursor_time(last), ts="start_at", empty="start")


_MS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"


@register("sync_gmail", _sql(FIRST, SECOND, "(SELECT " + _iso("c") + " FROM cur)", "(SELECT " + _iso("max(m)") + " FROM e)", f"""
    e AS (SELECT event_id AS id, {_MS} AS m FROM events),
    r1 AS (SELECT id, m FROM e WHERE m < TIMESTAMP '{FIRST}' AND m >= date_trunc('day', TIMESTAMP '{FIRST}' - INTERVAL {DAYS} DAY)),
    cur AS (SELECT max(m) AS c FROM r1),
    r2 AS (SELECT id FROM e WHERE m >= (SELECT date_trunc('day', c) FROM cur))"""))
def sync_gmail(spark, sf):
    """The cursor is the newest message; the next run reads from its day on (overlap: updates)."""
    def pages(until):
        e = B.table(spark, sf, "events").where(until)
        rec = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"),
                                 F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("internalDate")))
        return _pages(e.select(F.col("event_id").alias("ref"), rec.alias("record")), "messages")

    feed = Feed("raw_gmail_messages", N.normalize_emails, "messages")
    landed = F.date_trunc("millisecond", "ts").cast("timestamp_ntz") < _ts(FIRST)
    return _two_runs(spark, "gmail", feed, pages(landed), pages(F.lit(True)),
                     F.col("date") >= F.date_trunc("day", _before(FIRST)).cast("timestamp_ntz"),
                     lambda last: F.col("date") >= F.date_trunc("day", D.cursor_time(last)).cast("timestamp_ntz"), ts="date")


@register("sync_spotify", _sql(FIRST, SECOND, "(SELECT CAST(epoch_us(c) // 1000 AS VARCHAR) FROM cur)",
                               "(SELECT CAST(epoch_us(max(m)) // 1000 AS VARCHAR) FROM e)", f"""
    e AS (SELECT event_id AS id, {_MS} AS m FROM events),
    r1 AS (SELECT id, m FROM e WHERE m < TIMESTAMP '{FIRST}' AND m >= TIMESTAMP '{FIRST}' - INTERVAL {DAYS} DAY),
    cur AS (SELECT max(m) AS c FROM r1),
    r2 AS (SELECT id FROM e WHERE m >= (SELECT c FROM cur))"""))
def sync_spotify(spark, sf):
    """The cursor is the newest play in epoch milliseconds; the next run reads from it on."""
    def pages(until):
        rec = J.play_records(spark, sf).join(B.table(spark, sf, "events").where(until).select(F.col("event_id").alias("ref")), "ref")
        return _pages(rec, "items")

    feed = Feed("raw_spotify_plays", N.normalize_plays, "items")
    landed = F.date_trunc("millisecond", "ts").cast("timestamp_ntz") < _ts(FIRST)
    return _two_runs(spark, "spotify", feed, pages(landed), pages(F.lit(True)), F.col("played_at") >= _before(FIRST),
                     lambda last: F.col("played_at") >= D.cursor_time(last, "ms"), ts="played_at", kind="ms")


# ------------------------------------------------------------------ code hosting

def _git_runs(spark, sf, connector: str, feeds: list[Feed], ts: str, pages1, pages2, first: str, second: str) -> DataFrame:
    repos = B.table(spark, sf, "customer").select(
        F.lit("github").alias("source"), F.concat(F.col("c_custkey").cast("string"), F.lit("/repo")).alias("source_id"))
    none = repos.where(F.lit(False))
    log = scratch_path(spark, "audit")
    with SY.recorded(spark, "github", first, log):
        one = SY.sync_entities(connector, pages1, feeds, ts, {f.table: _empty(spark, f) for f in feeds},
                               spark.createDataFrame([], SYNC_STATE), repos, none, first, _before(first))
        one.state = staged(one.state, "state")
        tables = {k: staged(t, k) for k, t in one.tables.items()}
        one.audit = _logged(one.audit, log, first)
        one.release()
    with SY.recorded(spark, "github", second, log):
        two = SY.sync_entities(connector, pages2, feeds, ts, tables, one.state, repos, repos, second, _before(second))
        two.state = staged(two.state, "state")
        two.audit = _logged(two.audit, log, second)
        two.release()
    return _report(connector, one, two)


def _git_sql(ctes: str) -> str:
    """From o (id, entity, d), b1, b2 (rows loaded by each run), f1, f2 (failed entities)."""
    return f"""
    WITH {ctes},
    n AS (SELECT count(*) AS n FROM customer),
    again AS (SELECT count(*) AS n FROM b2 WHERE id IN (SELECT id FROM b1)),
    last AS (SELECT max(d) AS d FROM (SELECT d FROM b1 UNION ALL SELECT d FROM b2) x)
    SELECT 1 AS run, CASE WHEN (SELECT count(*) FROM f1) > 0 THEN 'partial' ELSE 'success' END AS status,
           CAST(n + (SELECT count(*) FROM b1) AS INTEGER) AS records_fetched,
           CAST(n + (SELECT count(*) FROM b1) AS INTEGER) AS records_inserted, 0 AS records_updated,
           CAST((SELECT count(*) FROM f1) AS INTEGER) AS records_failed, (SELECT {_iso('max(d)')} FROM b1) AS cursor
    FROM n
    UNION ALL
    SELECT 2, CASE WHEN (SELECT count(*) FROM f2) > 0 THEN 'partial' ELSE 'success' END,
           CAST(n.n + (SELECT count(*) FROM b2) AS INTEGER), CAST((SELECT count(*) FROM b2) - again.n AS INTEGER),
           CAST(n.n + again.n AS INTEGER), CAST((SELECT count(*) FROM f2) AS INTEGER), (SELECT {_iso('d')} FROM last)
    FROM n, again"""


@register("sync_github", _git_sql(f"""
    o AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderdate AS d FROM orders),
    f1 AS (SELECT DISTINCT c FROM o WHERE d < TIMESTAMP '{GIT_FIRST}' AND c % 9 = 0),
    b1 AS (SELECT * FROM o WHERE d < TIMESTAMP '{GIT_FIRST}' AND d >= TIMESTAMP '{GIT_FIRST}' - INTERVAL {DAYS} DAY AND c % 9 <> 0),
    cur AS (SELECT c, max(d) AS m FROM b1 GROUP BY c),
    f2 AS (SELECT DISTINCT c FROM o WHERE c % 7 = 0),
    b2 AS (SELECT o.* FROM o LEFT JOIN cur ON cur.c = o.c
           WHERE o.c % 7 <> 0 AND d >= coalesce(m, TIMESTAMP '{GIT_SECOND}' - INTERVAL {DAYS} DAY))"""))
def sync_github(spark, sf):
    """Commits since each repository's cursor. In the first run the pages of every ninth customer are
    cut short, in the second a commit of every seventh has no date: these repositories are skipped."""
    rec = staged(J.commit_records(spark, sf), "records")
    cust = F.split("repo_source_id", "/")[0].cast("int")
    early = rec.where(parse_iso_ts(F.get_json_object("record", "$.commit.author.date")) < _ts(GIT_FIRST))
    by = ("repo_full_name", "repo_source_id")
    pages1 = _pages(early, None, *by).withColumn("payload", F.when(cust % 9 == 0, F.expr("substring(payload, 1, length(payload) - 3)"))
                                                 .otherwise(F.col("payload")))
    undated = F.regexp_replace("record", '"date":"[^"]*"', '"date":"noon"')
    pages2 = _pages(rec.withColumn("record", F.when(cust % 7 == 0, undated).otherwise(F.col("record"))), None, *by)
    feed = Feed("raw_github_commits", lambda d: N.normalize_commits(d, "repo_full_name", "repo_source_id"))
    return _git_runs(spark, sf, "github", [feed], "committed_at", pages1, pages2, GIT_FIRST, GIT_SECOND)


@register("sync_github_issues", _git_sql(f"""
    o AS (SELECT event_id AS id, user_id AS c, ts, ts + INTERVAL 1 HOUR AS d FROM events),
    f1 AS (SELECT DISTINCT c FROM o WHERE ts < TIMESTAMP '{FIRST}' AND c % 5 = 0),
    b1 AS (SELECT * FROM o WHERE ts < TIMESTAMP '{FIRST}' AND c % 5 <> 0 AND d >= TIMESTAMP '{FIRST}' - INTERVAL {DAYS} DAY),
    cur AS (SELECT c, max(d) AS m FROM b1 GROUP BY c),
    f2 AS (SELECT c FROM o WHERE false),
    b2 AS (SELECT o.* FROM o LEFT JOIN cur ON cur.c = o.c
           WHERE d >= coalesce(m, TIMESTAMP '{SECOND}' - INTERVAL {DAYS} DAY))"""))
def sync_github_issues(spark, sf):
    """Issues and pull requests of one feed since each repository's newest update; in the first run
    every fifth repository answers with an error page."""
    rec = staged(J.issue_feed_records(spark, sf), "records")
    early = rec.where(parse_iso_ts(F.get_json_object("record", "$.created_at")) < _ts(FIRST))
    down = F.col("repo_source_id").cast("int") % 5 == 0
    pages1 = _pages(early, None, "repo_source_id").withColumn(
        "payload", F.when(down, F.lit('{"message": "Not Found"}')).otherwise(F.col("payload")))
    feeds = [Feed("raw_github_issues", lambda d: N.normalize_issues(d, "repo_source_id"), takes=lambda: ~N.is_pull_request("record")),
             Feed("raw_github_pull_requests", lambda d: N.normalize_prs(d, "repo_source_id"), takes=lambda: N.is_pull_request("record"))]
    return _git_runs(spark, sf, "github_issues", feeds, "updated_at", pages1, _pages(rec, None, "repo_source_id"), FIRST, SECOND)
