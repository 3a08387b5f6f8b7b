"""Staging models (F1-F7): key, rename, cast. Pure projections; Spark inlines them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import minutes_between, surrogate_key


def _c(name: str, typ: str, alias: str | None = None):
    return F.col(name).cast(typ).alias(alias or name)


def stg_repositories(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("repository_key"),
        "source", "source_id",
        _c("github_repository_id", "bigint"),
        _c("name", "string"), _c("owner", "string"), _c("full_name", "string"),
        _c("language", "string"), _c("created_at", "timestamp_ntz"),
        _c("archived", "boolean"), _c("ingested_at", "timestamp_ntz"),
        _c("updated_at", "timestamp_ntz"),
    )


def stg_commits(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("commit_key"),
        "source", "source_id",
        _c("repository_source_id", "string"),
        _c("commit_sha", "string", "commit_id"),
        _c("author_name", "string", "author"),
        _c("author_email", "string"),
        _c("committed_at", "timestamp_ntz"),
        _c("additions", "int"), _c("deletions", "int"),
        _c("message", "string"),
    )


def stg_pull_requests(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("pr_key"),
        "source", "source_id",
        _c("repository_source_id", "string"), _c("number", "int"), _c("title", "string"),
        _c("state", "string"), _c("author", "string"),
        _c("created_at", "timestamp_ntz"), _c("updated_at", "timestamp_ntz"),
        _c("closed_at", "timestamp_ntz"), _c("merged_at", "timestamp_ntz"),
        _c("is_draft", "boolean"), _c("comments_count", "int"),
    )


def stg_issues(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("issue_key"),
        "source", "source_id",
        _c("repository_source_id", "string"), _c("number", "int"), _c("title", "string"),
        _c("state", "string"), _c("state_reason", "string"), _c("author", "string"),
        _c("created_at", "timestamp_ntz"), _c("updated_at", "timestamp_ntz"),
        _c("closed_at", "timestamp_ntz"), _c("comments_count", "int"),
    )


def stg_calendar_events(raw: DataFrame, drop_cancelled: bool = False) -> DataFrame:
    """Cancelled events flow through with null times unless `drop_cancelled`."""
    if drop_cancelled:
        raw = raw.where(F.col("status").isNull() | (F.col("status") != "cancelled"))
    return raw.select(
        surrogate_key("source", "calendar_id", "source_id").alias("event_key"),
        "source",
        _c("calendar_id", "string"),
        _c("source_id", "string", "calendar_event_id"),
        _c("title", "string"),
        _c("start_at", "timestamp_ntz"), _c("end_at", "timestamp_ntz"),
        _c("timezone", "string"), _c("attendees_count", "int"),
        _c("status", "string"), _c("category", "string"),
        minutes_between("start_at", "end_at").alias("duration_minutes"),
    )


def stg_emails(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("message_key"),
        "source", "source_id",
        _c("thread_id", "string"), _c("sender", "string"), _c("recipients", "string"),
        _c("subject", "string"), _c("date", "timestamp_ntz"), _c("snippet", "string"),
    )


def stg_plays(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("source", "source_id").alias("play_key"),
        "source", "source_id",
        _c("played_at", "timestamp_ntz"), _c("track_id", "string"),
        _c("track_name", "string"), _c("artists", "string"),
    )
