"""Driver tables -> raw tables (test bindings).

The driver ships TPC-H-like tables, not service data; each binding maps one driver table
onto one raw table so that every model runs over whole driver tables and DuckDB can check
it. Projections only: column pruning reaches the Parquet scan, nothing is collected.

| raw table                 | driver table | role                                          |
|---------------------------|--------------|-----------------------------------------------|
| raw_github_repositories   | customer     | one repository per customer                   |
| raw_github_commits        | orders       | one commit per order, repo = twice the customer |
| raw_calendar_events       | lineitem     | one event per line, quantity = minutes        |
| raw_github_issues / _prs  | events       | error/signup events are PRs, the rest issues  |
| raw_gmail_messages        | events       | one message per event                         |
| raw_spotify_plays         | events       | one play per event                            |

Odd cases are part of the data: odd repositories have no commit and commits of the upper half of the
customers have no repository (orphans); some repositories and commits lack an id, some pull requests
have a state outside of the list, the seventh line's event ends before it starts, and some runs of
the log were aborted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed load time of the bound raw rows (ingested_at / updated_at), so results are repeatable.
LOAD_TS = "2024-01-01 00:00:00"
REPO_CREATED_TS = "2020-01-01 00:00:00"
PR_EVENT_TYPES = ("error", "signup")
CLOSED_EVENT_TYPES = ("purchase", "error")


def ts_lit(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _tail(payload: Column | None = None) -> list[Column]:
    return [
        ts_lit(LOAD_TS).alias("ingested_at"),
        ts_lit(LOAD_TS).alias("updated_at"),
        (payload if payload is not None else F.lit("{}")).alias("raw_payload"),
    ]


def raw_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    owner = F.col("c_nationkey").cast("string")
    return c.select(
        F.lit("github").alias("source"),
        F.col("c_custkey").cast("string").alias("source_id"),
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey").cast("long")).alias("github_repository_id"),
        F.col("c_name").alias("name"),
        owner.alias("owner"),
        F.concat(owner, F.lit("/"), F.col("c_name")).alias("full_name"),
        F.col("c_mktsegment").alias("language"),
        ts_lit(REPO_CREATED_TS).alias("created_at"),
        (F.col("c_acctbal") < 0).alias("archived"),
        *_tail(),
    )


def raw_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        F.lit("github").alias("source"),
        key.alias("source_id"),
        (F.col("o_custkey") * 2).cast("string").alias("repository_source_id"),
        F.when(F.col("o_orderkey") % 40 != 0, key).alias("commit_sha"),
        F.col("o_orderpriority").alias("author_name"),
        F.lit("").alias("author_email"),
        F.col("o_orderdate").alias("committed_at"),
        F.lit(None).cast("int").alias("additions"),
        F.lit(None).cast("int").alias("deletions"),
        F.col("o_orderstatus").alias("message"),
        *_tail(),
    )


def calendar_title(returnflag: Column) -> Column:
    return (F.when(returnflag == "R", "Weekly sync")
            .when(returnflag == "A", "Write design doc")
            .otherwise("Focus block"))


def calendar_category(returnflag: Column) -> Column:
    return (F.when(returnflag == "R", "meeting")
            .when(returnflag == "A", "work")
            .otherwise("other"))


def raw_calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rf = F.col("l_returnflag")
    return li.select(
        F.lit("calendar").alias("source"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("source_id"),
        F.lit("primary").alias("calendar_id"),
        calendar_title(rf).alias("title"),
        F.col("l_shipdate").alias("start_at"),
        F.timestamp_add("MINUTE", F.col("l_quantity").cast("int") - F.when(F.col("l_linenumber") == 7, 60).otherwise(0),
                        F.col("l_shipdate")).alias("end_at"),
        F.lit("UTC").alias("timezone"),
        F.col("l_linenumber").alias("attendees_count"),
        F.lit("confirmed").alias("status"),
        calendar_category(rf).alias("category"),
        *_tail(),
    )


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _closed() -> Column:
    return F.col("event_type").isin(*CLOSED_EVENT_TYPES)


def raw_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _feed(spark, sf_dir).where(~F.col("event_type").isin(*PR_EVENT_TYPES))
    return e.select(
        F.lit("github").alias("source"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("user_id").cast("string").alias("repository_source_id"),
        F.col("event_id").cast("int").alias("number"),
        F.col("event_type").alias("title"),
        F.when(_closed(), "closed").otherwise("open").alias("state"),
        F.when(_closed(), "completed").alias("state_reason"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.when(_closed(), F.col("ts")).alias("closed_at"),
        F.get_json_object("props", "$.k").cast("int").alias("comments_count"),
        ts_lit(LOAD_TS).alias("ingested_at"),
        F.col("props").alias("raw_payload"),
    )


def raw_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _feed(spark, sf_dir).where(F.col("event_type").isin(*PR_EVENT_TYPES))
    return e.select(
        F.lit("github").alias("source"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("user_id").cast("string").alias("repository_source_id"),
        F.col("event_id").cast("int").alias("number"),
        F.col("event_type").alias("title"),
        F.when((F.col("event_type") == "error") & (F.get_json_object("props", "$.k").cast("int") >= 90), "merged")
        .when(_closed(), "closed").otherwise("open").alias("state"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        F.when(_closed(), F.col("ts")).alias("closed_at"),
        F.when(F.col("event_type") == "error", F.col("ts")).alias("merged_at"),
        (F.col("event_type") == "signup").alias("is_draft"),
        F.get_json_object("props", "$.k").cast("int").alias("comments_count"),
        ts_lit(LOAD_TS).alias("ingested_at"),
        F.col("props").alias("raw_payload"),
    )


def raw_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _feed(spark, sf_dir)
    return e.select(
        F.lit("gmail").alias("source"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("user_id").cast("string").alias("thread_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("sender"),
        F.lit("me@example.com").alias("recipients"),
        F.col("event_type").alias("subject"),
        F.col("ts").alias("date"),
        F.col("props").alias("snippet"),
        *_tail(),
    )


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _feed(spark, sf_dir)
    track = F.col("event_id").cast("string")
    return e.select(
        F.lit("spotify").alias("source"),
        F.concat(track, F.lit(":"), F.date_format("ts", ISO_MICROS)).alias("source_id"),
        F.col("ts").alias("played_at"),
        track.alias("track_id"),
        F.col("event_type").alias("track_name"),
        F.concat(F.lit("artist "), F.col("user_id").cast("string")).alias("artists"),
        *_tail(),
    )


RAW_BINDINGS = {
    "raw_github_repositories": raw_repositories,
    "raw_github_commits": raw_commits,
    "raw_github_pull_requests": raw_pull_requests,
    "raw_github_issues": raw_issues,
    "raw_calendar_events": raw_calendar_events,
    "raw_gmail_messages": raw_emails,
    "raw_spotify_plays": raw_plays,
}


class LazyTables(Mapping):
    """name -> DataFrame, each built on first access (plan construction costs driver round
    trips; a model touching two tables should not pay for seven)."""

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        self._loaders = loaders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._loaders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)


def raw_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables({name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in RAW_BINDINGS.items()})


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log bound to `events`: one sync run per (day, event type); a record with k >= 95
    counts as failed; every seventh size of a run stands for one that was aborted."""
    from ..operators.runs import status_col

    e = _feed(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    g = e.groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("__day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
        F.count(F.lit(1)).alias("fetched"), F.countDistinct("user_id").alias("inserted"),
        F.count(F.when(k >= 95, 1)).alias("failed"))
    aborted = F.col("fetched") % 7 == 0
    return g.select(
        F.md5(F.concat_ws("|", "source", F.col("__day").cast("string"))).alias("run_id"),
        "source", "started_at", "finished_at",
        status_col(F.col("failed"), aborted).alias("status"),
        F.col("fetched").cast("int").alias("records_fetched"),
        F.col("inserted").cast("int").alias("records_inserted"),
        (F.col("fetched") - F.col("inserted")).cast("int").alias("records_updated"),
        F.col("failed").cast("int").alias("records_failed"),
        F.when(aborted, F.lit("rate limit")).alias("error_message"))
