"""JSON record -> typed raw row (B1-B10), as Column expressions over a DataFrame of records.

Each `normalize_*` takes a DataFrame with a JSON text column (`record`) and returns the raw
table's columns plus `raw_payload` (the record) and `_error` (null when well-formed).
`split_malformed` separates the quarantine. Malformed means: not a JSON object, a required
key absent, or a required number/timestamp that does not parse. One bad record never fails
the batch (the documented "skipped and counted" behaviour).

Absent vs null: `.get(k, default)` in the source applies the default only when the key is
absent; an explicit null stays null. Top-level presence is read with `json_object_keys`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ISO_TIME, categorize, local_to_utc, parse_iso_date, parse_iso_ts, valid_zone
from ..sources import schemas as S
from ..sources.landing import SEQUENCE

REC = "record"
_J = "__j"
_K = "__k"


def _nk(path: str) -> str:
    return "__k" + path.replace("$", "").replace(".", "_")


def _prep(df: DataFrame, schema: T.StructType, col: str, nested: Sequence[str] | Mapping[str, Sequence[str]] = ()) -> DataFrame:
    """One typed parse of the record, its top-level key set, and the key set of each nested
    object in `nested` (each parsed once, then shared by every presence test on it). Where `nested` names
    an object's fields, its key set is null if the typed parse has them all: see `present`."""
    d = df.withColumn(_J, F.from_json(F.col(col), schema)).withColumn(
        _K, F.json_object_keys(F.col(col)))
    for path in nested:
        keys = F.json_object_keys(F.get_json_object(F.col(col), path))
        if isinstance(nested, Mapping):
            keys = F.when(reduce(or_, [j(f).isNull() for f in nested[path]]), keys)
        d = d.withColumn(_nk(path), keys)
    return d


def has(key: str) -> Column:
    """Top-level key present (null-valued counts as present)."""
    return F.coalesce(F.array_contains(F.col(_K), key), F.lit(False))


def has_in(col: str, path: str, key: str) -> Column:
    """`key` present in the object at JSON path `path` (declared in `_prep(nested=...)`)."""
    return F.coalesce(F.array_contains(F.col(_nk(path)), key), F.lit(False))


def present(col: str, field: str) -> Column:
    """A nested field (declared in `_prep(nested=...)` by its object) is there, null-valued or not: the key
    set is only needed where the typed parse has null."""
    parent, _, key = field.rpartition(".")
    return j(field).isNotNull() | has_in(col, f"$.{parent}", key)


def j(field: str) -> Column:
    c = F.col(_J)
    for part in field.split("."):
        c = c[part]
    return c


def _first_error(rules: Sequence[tuple[Column, str]]) -> Column:
    """First failing rule's message, null when all pass. `rules` are (ok condition, message)."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(msg)) for ok, msg in rules])


def _required(keys: Sequence[str]) -> list[tuple[Column, str]]:
    return [(has(k), f"missing {k}") for k in keys]


def _object() -> tuple[Column, str]:
    return (F.col(_K).isNotNull(), "not a JSON object")


def _finish(df: DataFrame, cols: list[Column], rules: list[tuple[Column, str]], col: str) -> DataFrame:
    """The raw columns and `_error`. The error comes from a generator of one row, for a filter on it then
    stays above the parse; pushed below, it would parse the record again for every rule."""
    keep = [c for c in df.columns if (c == SEQUENCE or not c.startswith("__")) and c != col]
    checked = df.select("*", F.explode(F.array(_first_error(rules))).alias("_error"))
    return checked.select(*keep, *cols, F.col(col).alias("raw_payload"), "_error")


def _ts_ok(text: Column, parsed: Column) -> Column:
    return text.isNotNull() & parsed.isNotNull()


# ------------------------------------------------------------------ B1 repositories

def normalize_repos(df: DataFrame, col: str = REC, source: str = "github") -> DataFrame:
    d = _prep(df, S.REPO_JSON, col, ["$.owner"])
    created = parse_iso_ts(j("created_at"))
    cols = [
        F.lit(source).alias("source"),
        j("full_name").alias("source_id"),
        j("id").alias("github_repository_id"),
        j("name").alias("name"),
        j("owner.login").alias("owner"),
        j("full_name").alias("full_name"),
        j("language").alias("language"),
        created.alias("created_at"),
        F.when(has("archived"), j("archived")).otherwise(F.lit(False)).alias("archived"),
    ]
    rules = [_object(), *_required(S.REQUIRED["repo"]),
             (F.get_json_object(F.col(col), "$.id").isNull() | j("id").isNotNull(), "bad id"),
             (has_in(col, "$.owner", "login"), "missing owner.login"),
             (_ts_ok(j("created_at"), created), "bad created_at")]
    return _finish(d, cols, rules, col)


# ------------------------------------------------------------------ B2 commits

def normalize_commits(df: DataFrame, repo_full_name: str, repo_source_id: str,
                      col: str = REC, source: str = "github") -> DataFrame:
    """Commits of one repository feed; the repository comes from context columns."""
    d = _prep(df, S.COMMIT_JSON, col, {"$.commit": ["commit.author", "commit.message"], "$.commit.author": ["commit.author.name"]})
    date = parse_iso_ts(j("commit.author.date"))
    email = j("commit.author.email")
    cols = [
        F.lit(source).alias("source"),
        # a null part makes the key null, and the row is rejected before any upsert
        F.concat(F.col(repo_full_name), F.lit(":"), j("sha")).alias("source_id"),
        F.col(repo_source_id).alias("repository_source_id"),
        j("sha").alias("commit_sha"),
        j("commit.author.name").alias("author_name"),
        F.when(email.isNull() | (email == ""), F.lit("")).otherwise(email).alias("author_email"),
        date.alias("committed_at"),
        F.lit(None).cast("int").alias("additions"),
        F.lit(None).cast("int").alias("deletions"),
        j("commit.message").alias("message"),
    ]
    rules = [_object(), *_required(S.REQUIRED["commit"]),
             (present(col, "commit.author"), "missing commit.author"),
             (present(col, "commit.message"), "missing commit.message"),
             (present(col, "commit.author.name"), "missing author.name"),
             (_ts_ok(j("commit.author.date"), date), "bad author.date")]
    return _finish(d, cols, rules, col)


# ------------------------------------------------------------------ B3-B5 issues / PRs

def is_pull_request(col: str = REC) -> Column:
    """An item of the issues feed is a PR when `pull_request` is present and not null."""
    return F.get_json_object(F.col(col), "$.pull_request").isNotNull()


def split_issues_prs(df: DataFrame, col: str = REC) -> tuple[DataFrame, DataFrame]:
    """Route one feed into (issues, prs) with two filters over the same records."""
    pr = is_pull_request(col)
    return df.where(~pr), df.where(pr)


def route_issues_prs(df: DataFrame, col: str = REC) -> DataFrame:
    """B3 in one pass: the feed with the `kind` of each record, 'issue' or 'pr'."""
    return df.withColumn("kind", F.when(is_pull_request(col), "pr").otherwise("issue"))


def _issue_common(d: DataFrame, col: str, source: str, repo_source_id: str):
    created = parse_iso_ts(j("created_at"))
    updated = parse_iso_ts(j("updated_at"))
    closed_txt = j("closed_at")
    closed = F.when(closed_txt.isNotNull() & (closed_txt != ""), parse_iso_ts(closed_txt))
    cols = [
        F.lit(source).alias("source"),
        j("node_id").alias("source_id"),
        F.col(repo_source_id).alias("repository_source_id"),
        j("number").alias("number"),
        j("title").alias("title"),
        j("state").alias("state"),
    ]
    tail = [
        j("user.login").alias("author"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        closed.alias("closed_at"),
    ]
    comments = F.when(has("comments"), j("comments")).otherwise(F.lit(0)).alias("comments_count")
    rules = [_object(), *_required(S.REQUIRED["issue"]),
             (j("number").isNotNull() | F.get_json_object(F.col(col), "$.number").isNull(), "bad number"),
             (_ts_ok(j("created_at"), created), "bad created_at"),
             (_ts_ok(j("updated_at"), updated), "bad updated_at"),
             (closed_txt.isNull() | (closed_txt == "") | closed.isNotNull(), "bad closed_at")]
    return cols, tail, comments, rules


def normalize_issues(df: DataFrame, repo_source_id: str, col: str = REC, source: str = "github") -> DataFrame:
    d = _prep(df, S.ISSUE_JSON, col)
    cols, tail, comments, rules = _issue_common(d, col, source, repo_source_id)
    return _finish(d, [*cols, j("state_reason").alias("state_reason"), *tail, comments], rules, col)


def normalize_prs(df: DataFrame, repo_source_id: str, col: str = REC, source: str = "github") -> DataFrame:
    d = _prep(df, S.ISSUE_JSON, col)
    cols, tail, comments, rules = _issue_common(d, col, source, repo_source_id)
    m_txt = j("pull_request.merged_at")
    merged = F.when(m_txt.isNotNull() & (m_txt != ""), parse_iso_ts(m_txt))
    extra = [merged.alias("merged_at"),
             F.when(has("draft"), j("draft")).otherwise(F.lit(False)).alias("is_draft"),
             comments]
    rules = rules + [(m_txt.isNull() | (m_txt == "") | merged.isNotNull(), "bad merged_at")]
    return _finish(d, [*cols, *tail, *extra], rules, col)


# ------------------------------------------------------------------ B6 calendar

_OFFSET = r"T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)$"


def _timed(value: Column, zone_ok: Column) -> Column:
    """An explicit offset wins; otherwise local time in `zone_ok` (already validated)."""
    local = F.when(value.rlike(ISO_TIME), F.try_to_timestamp(value)).cast("timestamp_ntz")
    return F.when(value.rlike(_OFFSET), parse_iso_ts(value)).otherwise(local_to_utc(local, zone_ok, False))


def normalize_calendar(df: DataFrame, calendar_id: str | Column, col: str = REC,
                       source: str = "calendar") -> DataFrame:
    """Three shapes by key presence: `start.dateTime` (timed), `start.date` (all-day, end date
    + 1 day as the source system does, both ends in the start zone), neither (cancelled:
    null times, zone 'UTC')."""
    d = _prep(df, S.CALENDAR_JSON, col, ["$.start", "$.end"])
    # each zone id is looked up once per row, then reused
    d = d.withColumn("__zs", F.when(valid_zone(j("start.timeZone")), j("start.timeZone")).otherwise(F.lit("UTC")))
    d = d.withColumn("__ze", F.when(valid_zone(j("end.timeZone")), j("end.timeZone")).otherwise(F.lit("UTC")))
    start_has_dt = has_in(col, "$.start", "dateTime")
    start_has_d = has_in(col, "$.start", "date")
    tz_start = j("start.timeZone")
    tz = F.when((tz_start.isNull()) | (tz_start == ""), F.lit("UTC")).otherwise(tz_start)
    tz_ok = F.col("__zs")
    sd = parse_iso_date(j("start.date"))
    ed = parse_iso_date(j("end.date"))
    day_start = local_to_utc(sd.cast("timestamp_ntz"), tz_ok, False)
    day_end = local_to_utc(F.date_add(ed, 1).cast("timestamp_ntz"), tz_ok, False)
    t_start = _timed(j("start.dateTime"), tz_ok)
    t_end = _timed(j("end.dateTime"), F.col("__ze"))
    # the converted times are computed once in their own projection: rules and outputs read
    # the columns (conditional branches would otherwise re-evaluate the conversions)
    d = (d.withColumn("__ks", start_has_dt).withColumn("__kd", start_has_d)
          .withColumn("__zs_s", F.when(start_has_dt, t_start).when(start_has_d, day_start))
          .withColumn("__zs_e", F.when(start_has_dt, t_end).when(start_has_d, day_end)))
    start_has_dt, start_has_d = F.col("__ks"), F.col("__kd")
    start_at, end_at = F.col("__zs_s"), F.col("__zs_e")
    summary = j("summary")
    d = d.withColumn("__title", F.when(summary.isNull() | (summary == ""), F.lit("")).otherwise(summary))
    title = F.col("__title")
    cal = calendar_id if isinstance(calendar_id, Column) else F.lit(calendar_id)
    cols = [
        F.lit(source).alias("source"),
        j("id").alias("source_id"),
        cal.alias("calendar_id"),
        title.alias("title"),
        start_at.alias("start_at"),
        end_at.alias("end_at"),
        F.when(start_has_dt | start_has_d, tz).otherwise(F.lit("UTC")).alias("timezone"),
        F.when(j("attendees").isNull(), F.lit(0)).otherwise(F.size(j("attendees"))).alias("attendees_count"),
        F.when(has("status"), j("status")).otherwise(F.lit("confirmed")).alias("status"),
        categorize(title).alias("category"),
    ]
    rules = [_object(), *_required(S.REQUIRED["calendar"]),
             (~start_has_dt | has_in(col, "$.end", "dateTime"), "missing end.dateTime"),
             (~start_has_dt | (start_at.isNotNull() & end_at.isNotNull()), "bad dateTime"),
             (start_has_dt | ~start_has_d | has_in(col, "$.end", "date"), "missing end.date"),
             (start_has_dt | ~start_has_d | (sd.isNotNull() & ed.isNotNull()), "bad date")]
    return _finish(d, cols, rules, col)


# ------------------------------------------------------------------ B7 mail

def header(name: str) -> Column:
    """Last header called `name` (case-sensitive), '' when there is none."""
    hs = F.coalesce(j("payload.headers"), F.array())
    last = F.try_element_at(F.filter(hs, lambda h: h["name"] == name), F.lit(-1))
    return F.when(last.isNull(), F.lit("")).otherwise(last["value"])


def normalize_emails(df: DataFrame, col: str = REC, source: str = "gmail") -> DataFrame:
    """Metadata only: the body never reaches a column. `date` = internalDate (epoch ms)."""
    d = _prep(df, S.EMAIL_JSON, col)
    ms = F.trim(j("internalDate")).try_cast("long")
    cols = [
        F.lit(source).alias("source"),
        j("id").alias("source_id"),
        F.when(has("threadId"), j("threadId")).otherwise(F.lit("")).alias("thread_id"),
        header("From").alias("sender"),
        header("To").alias("recipients"),
        header("Subject").alias("subject"),
        F.timestamp_millis(ms).cast("timestamp_ntz").alias("date"),
        F.when(has("snippet"), j("snippet")).otherwise(F.lit("")).alias("snippet"),
    ]
    headers = F.coalesce(j("payload.headers"), F.array())
    hdr_names_ok = F.coalesce(F.forall(headers, lambda h: h["name"].isNotNull()), F.lit(True))
    hdr_values_ok = F.coalesce(F.forall(headers, lambda h: h["value"].isNotNull()), F.lit(True))
    rules = [_object(), *_required(S.REQUIRED["email"]),
             (ms.isNotNull(), "bad internalDate"),
             (hdr_names_ok, "header without name"),
             (hdr_values_ok, "header without value")]
    return _finish(d, cols, rules, col)


# ------------------------------------------------------------------ B8 plays

def normalize_plays(df: DataFrame, col: str = REC, source: str = "spotify") -> DataFrame:
    d = _prep(df, S.PLAY_JSON, col, ["$.track"])
    played = parse_iso_ts(j("played_at"))
    artists = F.array_join(F.transform(F.coalesce(j("track.artists"), F.array()), lambda a: a["name"]), ", ")
    cols = [
        F.lit(source).alias("source"),
        F.concat(j("track.id"), F.lit(":"), j("played_at")).alias("source_id"),
        played.alias("played_at"),
        j("track.id").alias("track_id"),
        F.when(has_in(col, "$.track", "name"), j("track.name")).otherwise(F.lit("")).alias("track_name"),
        artists.alias("artists"),
    ]
    rules = [_object(), *_required(S.REQUIRED["play"]),
             (has_in(col, "$.track", "id"), "missing track.id"),
             (_ts_ok(j("played_at"), played), "bad played_at")]
    return _finish(d, cols, rules, col)


# ------------------------------------------------------------------ B10 quarantine

def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without `_error`, quarantined rows with their reason)."""
    return df.where(F.col("_error").isNull()).drop("_error"), df.where(F.col("_error").isNotNull())


def to_raw(df: DataFrame, table: str, now) -> DataFrame:
    """Normalised rows -> raw table shape; `ingested_at`/`updated_at` stamped with the run
    time (the upsert keeps the first `ingested_at`). PR/issue `updated_at` is the source's.
    A record's sequence stays as a last column for the fold."""
    n = F.lit(str(now)).cast("timestamp_ntz")
    schema = S.RAW[table]
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in ("ingested_at", "updated_at"):
            out.append(n.alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out, *([SEQUENCE] if SEQUENCE in df.columns else []))
