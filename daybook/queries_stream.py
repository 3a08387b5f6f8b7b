"""Registered streaming queries (M1-M4): landed files drained with `availableNow`.

Landing is written from the driver tables under the shared checkpoint folder, twice: the
second copy is a full re-delivery, so every record arrives twice and the sinks must absorb
it. The queries return the sink tables; results equal the batch semantics.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .operators import normalize as N
from .operators.load import Feed, read_rejected
from .queries import register, wh
from .queries_ingest import _PLAY_SQL
from .session import scratch_path
from .sources import bindings as B
from .sources import landing as L
from .sources import service_json as J
from .sources.schemas import RAW
from .streaming import ingest as S

RUN_NOW = "2024-02-01 00:00:00"
FILES_PER_TRIGGER = 64
WATERMARK_DELAY = "40 days"   # > the disorder between landed files (one month of events)


def _land_pages(spark, sf, landing: str, copies: int = 2) -> None:
    """Play pages (JSON lines, one page per line), landed `copies` times."""
    pages = L.build_pages(J.play_records(spark, sf), "record", F.floor(F.col("ref") / 100), "items")
    for i in range(copies):
        pages.select("payload").write.text(f"{landing}/copy={i}")


def _land_events(spark, sf, landing: str, copies: int) -> T.StructType:
    ev = B.table(spark, sf, "events")
    for i in range(copies):
        ev.write.parquet(f"{landing}/copy={i}")
    return ev.schema


PLAYS = Feed("raw_spotify_plays", N.normalize_plays, "items")


def _play_stream_run(spark, sf, partitioned: bool = True):
    landing = scratch_path(spark, "landing-plays")
    _land_pages(spark, sf, landing)
    target, audit = scratch_path(spark, "raw"), scratch_path(spark, "audit")
    S.stream_upsert(S.page_stream(spark, landing, FILES_PER_TRIGGER), PLAYS, target, scratch_path(spark, "ckpt"),
                    RUN_NOW, audit_root=audit, partitioned=partitioned)
    return target, audit


@register("stream_upsert", f"""
    SELECT p.*, TIMESTAMP '{RUN_NOW}' AS ingested_at, TIMESTAMP '{RUN_NOW}' AS updated_at
    FROM ({_PLAY_SQL}) p""")
def stream_upsert(spark, sf):
    """M1: landed play pages (each delivered twice) -> normalise -> upsert per micro-batch."""
    target, _ = _play_stream_run(spark, sf)
    return S.read_partitioned(spark, target, "raw_spotify_plays", RAW["raw_spotify_plays"]).drop("raw_payload")


@register("stream_upsert_snapshots", f"""
    SELECT p.*, TIMESTAMP '{RUN_NOW}' AS ingested_at, TIMESTAMP '{RUN_NOW}' AS updated_at
    FROM ({_PLAY_SQL}) p""")
def stream_upsert_snapshots(spark, sf):
    """M1 with the snapshot sink: each micro-batch publishes a new snapshot (pointer move)."""
    target, _ = _play_stream_run(spark, sf, partitioned=False)
    return L.read_table(spark, target, "raw_spotify_plays").drop("raw_payload")


@register("stream_run_audit", """
    SELECT 'success' AS status, CAST(2 * count(*) AS BIGINT) AS records_fetched,
           CAST(count(*) AS BIGINT) AS records_inserted, CAST(count(*) AS BIGINT) AS records_updated,
           CAST(0 AS BIGINT) AS records_failed
    FROM events""")
def stream_run_audit(spark, sf):
    """M4: one audit row per micro-batch; reported as totals per status, which do not depend
    on where the batch boundaries fall."""
    _, audit = _play_stream_run(spark, sf)
    a = S.read_audit(spark, audit)
    return a.groupBy("status").agg(*[F.sum(c).cast("bigint").alias(c) for c in (
        "records_fetched", "records_inserted", "records_updated", "records_failed")])


#: Watermark of the dedup, and the events that land in a second delivery, after the others.
DEDUP_DELAY_DAYS = 10
_SECOND = "event_id % 10 = 3"
_LATE_SQL = f"""
    SELECT event_id, ts, user_id, event_type, {_SECOND} AND ts <= (
               SELECT date_trunc('millisecond', max(ts)) - INTERVAL {DEDUP_DELAY_DAYS} DAY FROM events WHERE NOT {_SECOND}) AS late
    FROM events"""


def _dedup_runs(spark, sf) -> tuple[str, str, str]:
    """Events land in two deliveries, the second one a month's worth of stragglers with everything again;
    after each the stream is drained. Returns the folders of the output, the late rows and the audit."""
    landing, out, late, audit, ckpt = (scratch_path(spark, x) for x in ("landing-events", "dedup-out", "dedup-late", "dedup-audit", "ckpt"))
    ev = B.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    for run, part in (("first", ev.where(f"NOT {_SECOND}")), ("second", ev)):
        part.write.parquet(f"{landing}/delivery={run}")
        s = (spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(landing))
        dropped = S.run_to_parquet(S.stream_dedup(s, ["event_id"], "ts", f"{DEDUP_DELAY_DAYS} days"), out, ckpt)
        landed = spark.read.schema(ev.schema).option("recursiveFileLookup", "true").parquet(landing)
        S.keep_late(spark, landed, out, late, ["event_id"], run, dropped, audit)
    return out, late, audit


@register("stream_dedup", _LATE_SQL)
def stream_dedup(spark, sf):
    """M2: events delivered again pass the watermark dedup once; stragglers behind the watermark are in the
    late table."""
    out, late, _ = _dedup_runs(spark, sf)
    schema = spark.read.parquet(out).schema
    both = spark.read.schema(schema).parquet(out).withColumn("late", F.lit(False)).unionByName(
        spark.read.schema(schema).parquet(late).withColumn("late", F.lit(True)))
    return both.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "late")


@register("stream_late_audit", f"""
    WITH e AS ({_LATE_SQL})
    SELECT 'first' AS run, CAST(count(*) FILTER (WHERE NOT {_SECOND}) AS BIGINT) AS records_landed,
           CAST(count(*) FILTER (WHERE NOT {_SECOND}) AS BIGINT) AS records_passed, CAST(0 AS BIGINT) AS records_late FROM e
    UNION ALL
    SELECT 'second', count(*) + count(*) FILTER (WHERE NOT {_SECOND}), count(*) FILTER (WHERE NOT late), count(*) FILTER (WHERE late) FROM e""")
def stream_late_audit(spark, sf):
    """M2 + M4: the audit of the dedup's two runs: what had landed, what has passed, what was late."""
    _, _, audit = _dedup_runs(spark, sf)
    return S.read_late_audit(spark, audit).drop("rows_dropped")


DAILY_SCHEMA = T.StructType([T.StructField("activity_date", T.DateType()),
                             T.StructField("events", T.LongType()),
                             T.StructField("purchases", T.LongType())])


@register("stream_daily_activity", """
    SELECT CAST(ts AS DATE) AS activity_date, count(*) AS events,
           count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases
    FROM events GROUP BY 1""")
def stream_daily_activity(spark, sf):
    """M3: per-day counts maintained incrementally (update mode, upserted by day)."""
    landing = scratch_path(spark, "landing-events")
    schema = _land_events(spark, sf, landing, copies=1)
    s = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
         .option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(landing)
         .select(F.col("ts").cast("timestamp").alias("ts"), "event_type"))
    daily = S.stream_daily(s, "ts", WATERMARK_DELAY).select(
        F.to_date("w.start").alias("activity_date"), "events", "purchases")
    root = scratch_path(spark, "daily")
    S.run_update_upsert(daily, ["activity_date"], root, "stream_daily", DAILY_SCHEMA,
                        scratch_path(spark, "ckpt"), RUN_NOW)
    return L.read_table(spark, root, "stream_daily", DAILY_SCHEMA)


#: Days until this one land in a first delivery, the others in a second.
DAY_CUT = "1995-06-17"


@register("stream_day_activity", O.model_sql("int_daily_activity"))
def stream_day_activity(spark, sf):
    """M3 as J1: commits and meetings as two streams. After the second delivery both name a time far ahead,
    which closes all days before it."""
    w = wh(spark, sf)
    commits = w.stg_commits.select(F.col("committed_at").cast("timestamp").alias("committed_at"), "repository_source_id")
    meetings = w.stg_calendar_events.where(F.col("category") == "meeting").select(
        F.col("start_at").cast("timestamp").alias("start_at"), "duration_minutes")
    ahead = (commits.select(F.col("committed_at").alias("t")).unionByName(meetings.select(F.col("start_at").alias("t")))
             .agg((F.max("t") + F.expr("INTERVAL 90 DAYS")).alias("t")))
    landing = {"committed_at": scratch_path(spark, "landing-commits"), "start_at": scratch_path(spark, "landing-meetings")}
    out, ckpt = scratch_path(spark, "days"), scratch_path(spark, "ckpt")
    for late in (False, True):
        for df, ts, other in ((commits, "committed_at", "repository_source_id"), (meetings, "start_at", "duration_minutes")):
            part = df.where((F.col(ts) >= F.lit(DAY_CUT).cast("timestamp")) == late)
            if late:
                part = part.unionByName(ahead.select(F.col("t").alias(ts), F.lit(None).cast(df.schema[other].dataType).alias(other)))
            part.write.parquet(f"{landing[ts]}/second={late}")
        streams = [spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").parquet(landing[ts])
                   for df, ts in ((commits, "committed_at"), (meetings, "start_at"))]
        daily = S.stream_day_activity(*streams, WATERMARK_DELAY)
        S.run_to_parquet(daily, out, ckpt)
    return spark.read.schema(daily.schema).parquet(out)


# ================================================================== versions within one batch

def _land_versions(spark, landing: str, old, new, list_key: str | None) -> None:
    """Every record twice on one page: the older version first, then the newer."""
    both = old.select("ref", F.lit(0).alias("v"), "record").unionByName(new.select("ref", F.lit(1).alias("v"), "record"))
    page = both.groupBy(F.floor(F.col("ref") / 100).alias("page")).agg(F.sort_array(F.collect_list(F.struct("v", "ref", "record"))).alias("r"))
    body = F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["record"]), ","), F.lit("]"))
    if list_key is not None:
        body = F.concat(F.lit(f'{{"{list_key}":'), body, F.lit("}"))
    page.select(body.alias("payload")).write.text(landing)


@register("stream_upsert_calendar", """
    SELECT 'calendar' AS source, CAST(event_id AS VARCHAR) AS source_id, 'primary' AS calendar_id, '' AS title,
           CAST(NULL AS TIMESTAMP) AS start_at, 'cancelled' AS status
    FROM events""")
def stream_upsert_calendar(spark, sf):
    """M1: every event arrives confirmed and, later on the same page, cancelled (without times, so
    the older version is the greater in value). The cancellation must win."""
    e = B.table(spark, sf, "events")
    when_ = F.struct(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("dateTime"))
    eid = F.col("event_id").cast("string").alias("id")
    old = e.select(F.col("event_id").alias("ref"), F.to_json(F.struct(
        eid, F.lit("confirmed").alias("status"), F.lit("Zebra walk").alias("summary"),
        when_.alias("start"), when_.alias("end"))).alias("record"))
    new = e.select(F.col("event_id").alias("ref"), F.to_json(F.struct(eid, F.lit("cancelled").alias("status"))).alias("record"))
    landing, target = scratch_path(spark, "landing-calendar"), scratch_path(spark, "raw")
    _land_versions(spark, landing, old, new, "items")
    feed = Feed("raw_calendar_events", lambda d: N.normalize_calendar(d, "primary"), "items")
    S.stream_upsert(S.page_stream(spark, landing, FILES_PER_TRIGGER), feed, target, scratch_path(spark, "ckpt"), RUN_NOW)
    return S.read_partitioned(spark, target, feed.table, RAW[feed.table]).select(
        "source", "source_id", "calendar_id", "title", "start_at", "status")


@register("stream_upsert_issues", f"""
    SELECT 'N_' || CAST(event_id AS VARCHAR) AS source_id, 'closed' AS state,
           CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 3 HOUR ELSE ts END AS updated_at,
           TIMESTAMP '{RUN_NOW}' AS ingested_at
    FROM events""")
def stream_upsert_issues(spark, sf):
    """M1: every issue arrives open and, later on the same page, closed (smaller in value; for odd
    ids even with an earlier source time). The later one wins and its own updated_at stays."""
    e = B.table(spark, sf, "events")

    def iso(c):
        return F.concat(F.date_format(c, J.ISO_US), F.lit("Z"))

    def version(state, updated):
        return e.select(F.col("event_id").alias("ref"), F.to_json(F.struct(
            F.concat(F.lit("N_"), F.col("event_id").cast("string")).alias("node_id"),
            F.col("event_id").cast("int").alias("number"), F.col("event_type").alias("title"), F.lit(state).alias("state"),
            iso(F.col("ts")).alias("created_at"), iso(updated).alias("updated_at"))).alias("record"))

    later = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("INTERVAL 3 HOURS")).otherwise(F.col("ts"))
    landing, target = scratch_path(spark, "landing-issues"), scratch_path(spark, "raw")
    _land_versions(spark, landing, version("open", F.col("ts") + F.expr("INTERVAL 1 HOURS")), version("closed", later), None)
    feed = Feed("raw_github_issues", lambda d: N.normalize_issues(d.withColumn("repo", F.lit("o/r")), "repo"))
    S.stream_upsert(S.page_stream(spark, landing, FILES_PER_TRIGGER), feed, target, scratch_path(spark, "ckpt"), RUN_NOW)
    return S.read_partitioned(spark, target, feed.table, RAW[feed.table]).select("source_id", "state", "updated_at", "ingested_at")


_PAGE = "event_id // 100"


@register("page_quarantine", f"""
    WITH page AS (SELECT {_PAGE} AS p, count(*) AS n FROM events GROUP BY 1)
    SELECT kind, reason, count(*) AS rejects FROM (
        SELECT 'page' AS kind, CASE p % 5 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'not JSON' ELSE 'items is not a list' END AS reason
        FROM page WHERE p % 5 IN (1, 2, 3)
        UNION ALL
        SELECT CASE WHEN event_id % 10 = 7 THEN 'key' ELSE 'record' END,
               CASE WHEN event_id % 10 = 7 THEN 'null key' ELSE 'bad played_at' END
        FROM events WHERE {_PAGE} % 5 IN (0, 4) AND event_id % 10 IN (7, 8)) x
    GROUP BY 1, 2""")
def page_quarantine(spark, sf):
    """A1 + B10 + C6: of the landed pages some are cut, some are HTML error pages, some have an error
    object for their list; on the others some records have a bad time or a null id. All of them are
    stored with a reason, and the rest of the batch loads."""
    e = B.table(spark, sf, "events")
    k = F.col("event_id") % 10
    when_ = F.when(k == 8, F.lit("10:30:00")).otherwise(F.concat(F.date_format("ts", J.ISO_MS), F.lit("Z")))
    track = F.when(k == 7, F.lit('{"id":null}')).otherwise(F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('"}')))
    rec = F.concat(F.lit('{"played_at":"'), when_, F.lit('","track":'), track, F.lit("}"))
    pages = L.build_pages(e.select(F.col("event_id").alias("ref"), rec.alias("record")), "record", F.floor(F.col("ref") / 100), "items")
    p = F.col("page") % 5
    broken = (F.when(p == 1, F.expr("substring(payload, 1, length(payload) - 9)"))
              .when(p == 2, F.lit("<html><body>502 Bad Gateway</body></html>"))
              .when(p == 3, F.lit('{"items": {"error": "rate limit"}}')).otherwise(F.col("payload")))
    landing, target, rejects = (scratch_path(spark, x) for x in ("landing-broken", "raw", "quarantine"))
    pages.select(broken.alias("payload")).write.text(landing)
    S.stream_upsert(S.page_stream(spark, landing, FILES_PER_TRIGGER), PLAYS, target, scratch_path(spark, "ckpt"), RUN_NOW,
                    quarantine_root=rejects)
    return read_rejected(spark, rejects).groupBy("kind", "reason").agg(F.count(F.lit(1)).alias("rejects"))
