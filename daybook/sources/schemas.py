"""Declared schemas: raw tables, operational tables, JSON entities. Nothing is inferred.

Timestamps are TIMESTAMP_NTZ holding UTC wall time (the driver's Parquet convention).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMON_HEAD = (("source", S), ("source_id", S))
COMMON_TAIL = (("ingested_at", TS), ("updated_at", TS), ("raw_payload", S))

RAW = {
    "raw_github_repositories": _struct(
        *COMMON_HEAD, ("github_repository_id", L), ("name", S), ("owner", S), ("full_name", S),
        ("language", S), ("created_at", TS), ("archived", B), *COMMON_TAIL),
    "raw_github_commits": _struct(
        *COMMON_HEAD, ("repository_source_id", S), ("commit_sha", S), ("author_name", S),
        ("author_email", S), ("committed_at", TS), ("additions", I), ("deletions", I),
        ("message", S), *COMMON_TAIL),
    "raw_github_pull_requests": _struct(
        *COMMON_HEAD, ("repository_source_id", S), ("number", I), ("title", S), ("state", S),
        ("author", S), ("created_at", TS), ("updated_at", TS), ("closed_at", TS),
        ("merged_at", TS), ("is_draft", B), ("comments_count", I), ("ingested_at", TS),
        ("raw_payload", S)),
    "raw_github_issues": _struct(
        *COMMON_HEAD, ("repository_source_id", S), ("number", I), ("title", S), ("state", S),
        ("state_reason", S), ("author", S), ("created_at", TS), ("updated_at", TS),
        ("closed_at", TS), ("comments_count", I), ("ingested_at", TS), ("raw_payload", S)),
    "raw_calendar_events": _struct(
        *COMMON_HEAD, ("calendar_id", S), ("title", S), ("start_at", TS), ("end_at", TS),
        ("timezone", S), ("attendees_count", I), ("status", S), ("category", S), *COMMON_TAIL),
    "raw_gmail_messages": _struct(
        *COMMON_HEAD, ("thread_id", S), ("sender", S), ("recipients", S), ("subject", S),
        ("date", TS), ("snippet", S), *COMMON_TAIL),
    "raw_spotify_plays": _struct(
        *COMMON_HEAD, ("played_at", TS), ("track_id", S), ("track_name", S), ("artists", S),
        *COMMON_TAIL),
}

# Natural keys of the raw tables.
KEYS = {
    "raw_github_repositories": ("source", "source_id"),
    "raw_github_commits": ("source", "source_id"),
    "raw_github_pull_requests": ("source", "source_id"),
    "raw_github_issues": ("source", "source_id"),
    "raw_calendar_events": ("source", "calendar_id", "source_id"),
    "raw_gmail_messages": ("source", "source_id"),
    "raw_spotify_plays": ("source", "source_id"),
}

# Tables whose `updated_at` is the source's own value (not touched on upsert).
SOURCE_UPDATED_AT = {"raw_github_pull_requests", "raw_github_issues"}

PIPELINE_RUNS = _struct(
    ("run_id", S), ("source", S), ("started_at", TS), ("finished_at", TS), ("status", S),
    ("records_fetched", I), ("records_inserted", I), ("records_updated", I),
    ("records_failed", I), ("error_message", S))

SYNC_STATE = _struct(
    ("connector", S), ("entity_key", S), ("last_successful_sync", TS), ("last_cursor", S),
    ("source_updated_at", TS), ("updated_at", TS))

# JSON entities as delivered by the services (parsing schema for from_json).
_LOGIN = _struct(("login", S))
REPO_JSON = _struct(("id", L), ("name", S), ("owner", _LOGIN), ("full_name", S),
                    ("language", S), ("created_at", S), ("archived", B))
COMMIT_JSON = _struct(
    ("sha", S),
    ("commit", _struct(("author", _struct(("name", S), ("email", S), ("date", S))),
                       ("message", S))))
ISSUE_JSON = _struct(
    ("node_id", S), ("number", I), ("title", S), ("state", S), ("state_reason", S),
    ("user", _LOGIN), ("created_at", S), ("updated_at", S), ("closed_at", S),
    ("comments", I), ("draft", B),
    ("pull_request", _struct(("url", S), ("html_url", S), ("merged_at", S))))
_WHEN = _struct(("dateTime", S), ("date", S), ("timeZone", S))
CALENDAR_JSON = _struct(
    ("id", S), ("status", S), ("summary", S), ("start", _WHEN), ("end", _WHEN),
    ("attendees", T.ArrayType(_struct(("email", S)))))
EMAIL_JSON = _struct(
    ("id", S), ("threadId", S), ("internalDate", S), ("snippet", S),
    ("payload", _struct(("headers", T.ArrayType(_struct(("name", S), ("value", S)))))))
PLAY_JSON = _struct(
    ("played_at", S),
    ("track", _struct(("id", S), ("name", S),
                      ("artists", T.ArrayType(_struct(("name", S)))))))

# Keys that must be present for a record to be well-formed.
REQUIRED = {
    "repo": ("id", "name", "owner", "full_name", "created_at"),
    "commit": ("sha", "commit"),
    "issue": ("node_id", "number", "title", "state", "created_at", "updated_at"),
    "calendar": ("id",),
    "email": ("id", "internalDate"),
    "play": ("played_at", "track"),
}
