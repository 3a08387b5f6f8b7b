"""Driver tables -> records in the services' JSON shapes (bindings for the normalisers).

`to_json` drops null fields, so a null in these builders means "key absent": that is how
the absent-key defaults (archived, comments, draft, status, threadId, track name) get
exercised. Every shape the normalisers handle appears: timed with offset, timed with a
zone (known, unknown, absent), all-day, cancelled, duplicate mail headers, no payload,
malformed records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import to_ms
from .bindings import CLOSED_EVENT_TYPES, PR_EVENT_TYPES, table

ISO_S = "yyyy-MM-dd'T'HH:mm:ss"
ISO_US = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS"

# Zone ids used by the calendar fixture, by line number (5 = no zone key).
ZONES = {1: "America/New_York", 2: "Europe/Berlin", 3: "Asia/Tokyo", 4: "No/Such",
         6: "UTC", 7: "Australia/Sydney"}


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def repo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    owner = F.col("c_nationkey").cast("string")
    rec = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.struct(owner.alias("login")).alias("owner"),
        F.concat(owner, F.lit("/"), F.col("c_name")).alias("full_name"),
        F.col("c_mktsegment").alias("language"),
        F.lit("2020-01-01T00:00:00Z").alias("created_at"),
        F.when(F.col("c_acctbal") < 0, F.lit(True)).alias("archived")))
    return c.select(F.col("c_custkey").alias("ref"), rec.alias("record"))


def commit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    repo = F.concat(F.col("o_custkey").cast("string"), F.lit("/repo"))
    author = F.struct(
        F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "F",
               F.concat(F.lit("dev"), F.col("o_custkey").cast("string"), F.lit("@example.com"))).alias("email"),
        F.concat(F.date_format("o_orderdate", ISO_S), F.lit("Z")).alias("date"))
    rec = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("sha"),
        F.struct(author.alias("author"), F.col("o_orderstatus").alias("message")).alias("commit")))
    return o.select(F.col("o_orderkey").alias("ref"), repo.alias("repo_full_name"),
                    repo.alias("repo_source_id"), rec.alias("record"))


def issue_feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ts = F.col("ts")
    closed = F.col("event_type").isin(*CLOSED_EVENT_TYPES)
    is_pr = F.col("event_type").isin(*PR_EVENT_TYPES)

    def iso(c):
        return F.concat(F.date_format(c, ISO_US), F.lit("Z"))

    pr = F.struct(
        F.concat(F.lit("https://example.com/pr/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.lit("https://example.com/pr/"), F.col("event_id").cast("string")).alias("html_url"),
        F.when(F.col("event_type") == "error", iso(ts + F.expr("INTERVAL 3 HOURS"))).alias("merged_at"))
    rec = F.to_json(F.struct(
        F.concat(F.lit("N_"), F.col("event_id").cast("string")).alias("node_id"),
        F.col("event_id").cast("int").alias("number"),
        F.col("event_type").alias("title"),
        F.when(closed, "closed").otherwise("open").alias("state"),
        F.when(closed, "completed").alias("state_reason"),
        F.when(F.col("event_type") != "view",
               F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("login"))).alias("user"),
        iso(ts).alias("created_at"),
        iso(ts + F.expr("INTERVAL 1 HOURS")).alias("updated_at"),
        F.when(closed, iso(ts + F.expr("INTERVAL 2 HOURS"))).alias("closed_at"),
        F.when(_k() >= 10, _k()).alias("comments"),
        F.when(F.col("event_type") == "signup", F.lit(True)).alias("draft"),
        F.when(is_pr, pr).alias("pull_request")))
    return e.select(F.col("event_id").alias("ref"), F.col("user_id").cast("string").alias("repo_source_id"),
                    rec.alias("record"))


def _zone(line: Column) -> Column:
    z = None
    for n, name in ZONES.items():
        z = (F.when(line == n, F.lit(name)) if z is None else z.when(line == n, F.lit(name)))
    return z


def calendar_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    start_local = F.col("l_shipdate") + F.expr("INTERVAL 9 HOURS")
    end_local = F.timestamp_add("MINUTE", F.col("l_quantity").cast("int"), start_local)
    zone = _zone(ln)
    eid = F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string"))
    attendees = F.transform(F.sequence(F.lit(1), ln), lambda i: F.struct(
        F.concat(F.lit("a"), i.cast("string"), F.lit("@example.com")).alias("email")))

    def when_(dt=None, d=None, tz=None):
        return F.struct(dt.alias("dateTime") if dt is not None else F.lit(None).cast("string").alias("dateTime"),
                        d.alias("date") if d is not None else F.lit(None).cast("string").alias("date"),
                        tz.alias("timeZone") if tz is not None else F.lit(None).cast("string").alias("timeZone"))

    offset = F.lit("-04:00")
    timed_off = F.to_json(F.struct(
        eid.alias("id"), F.lit("confirmed").alias("status"), F.lit("Weekly sync").alias("summary"),
        when_(dt=F.concat(F.date_format(start_local, ISO_S), offset)).alias("start"),
        when_(dt=F.concat(F.date_format(end_local, ISO_S), offset)).alias("end"),
        attendees.alias("attendees")))
    timed_zone = F.to_json(F.struct(
        eid.alias("id"), F.lit("Write design doc").alias("summary"),
        when_(dt=F.date_format(start_local, ISO_S), tz=zone).alias("start"),
        when_(dt=F.date_format(end_local, ISO_S), tz=zone).alias("end")))
    day = F.to_date("l_shipdate")
    all_day = F.to_json(F.struct(
        eid.alias("id"), F.lit("tentative").alias("status"), F.lit("Lunch break").alias("summary"),
        when_(d=F.date_format(day, "yyyy-MM-dd"), tz=zone).alias("start"),
        when_(d=F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), tz=zone).alias("end")))
    cancelled = F.to_json(F.struct(eid.alias("id"), F.lit("cancelled").alias("status")))
    rec = (F.when(rf == "R", timed_off).when(rf == "A", timed_zone)
           .when(ls == "O", all_day).otherwise(cancelled))
    return li.select(eid.alias("ref"), rec.alias("record"))


def email_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail messages; `error` events with k >= 95 carry a non-numeric date and `signup`
    events with k >= 98 are not JSON at all (both quarantined)."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    sender = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
    headers = F.array(
        F.struct(F.lit("From").alias("name"), sender.alias("value")),
        F.struct(F.lit("To").alias("name"), F.lit("me@example.com").alias("value")),
        F.struct(F.lit("Subject").alias("name"), F.lit("draft").alias("value")),
        F.struct(F.lit("Subject").alias("name"), et.alias("value")))
    payload = F.struct(headers.alias("headers"), F.struct(F.col("props").alias("data")).alias("body"))
    internal = F.when((et == "error") & (_k() >= 95), F.lit("n/a")).otherwise(to_ms("ts").cast("string"))
    rec = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.when(et != "view", F.col("user_id").cast("string")).alias("threadId"),
        internal.alias("internalDate"),
        F.col("props").alias("snippet"),
        F.when(et != "click", payload).alias("payload")))
    bad = (et == "signup") & (_k() >= 98)
    rec = F.when(bad, F.concat(F.lit("not json "), F.col("event_id").cast("string"))).otherwise(rec)
    return e.select(F.col("event_id").alias("ref"), rec.alias("record"))


def play_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    artist = F.struct(F.concat(F.lit("artist "), F.col("user_id").cast("string")).alias("name"))
    artists = (F.when(et == "purchase", F.array(artist, F.struct(F.lit("guest").alias("name"))))
               .when(et != "view", F.array(artist)))
    rec = F.to_json(F.struct(
        F.concat(F.date_format("ts", ISO_MS), F.lit("Z")).alias("played_at"),
        F.struct(F.col("event_id").cast("string").alias("id"),
                 F.when(et != "view", et).alias("name"),
                 artists.alias("artists")).alias("track")))
    return e.select(F.col("event_id").alias("ref"), F.to_date("ts").alias("day"), rec.alias("record"))
