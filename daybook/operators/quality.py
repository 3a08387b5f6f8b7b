"""Data-quality checks (L1-L7). Each check returns its failing rows as a DataFrame;
`run_checks` turns a list of specs into one report `(check, model, column, failures)`.

All checks are single-pass filters, grouped aggregates (partial aggregation, so a hot value
does not land whole in one task) or anti joins; the report reads each base table once for all of
its checks, and again only where values are suspect.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    """L1: rows where `column` is null."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """L2: non-null values occurring more than once, with their counts."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """L3: values outside the list (null passes), with their counts."""
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """L4: child rows whose non-null key has no parent (null passes). Anti join; the
    parent side is reduced to its distinct keys first."""
    keys = parent.select(F.col(parent_column).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    child = df.where(F.col(column).isNotNull())
    return child.join(keys, child[column] == keys["__pk"], "left_anti")


def no_negative(df: DataFrame, column: str) -> DataFrame:
    """Rows where `column` < 0."""
    return df.where(F.col(column) < 0)


def plausible_ts(df: DataFrame, column: str, as_of: datetime | str,
                 floor: str = "2000-01-01 00:00:00") -> DataFrame:
    """Timestamps after `as_of` (the run's "now") or before `floor`."""
    c = F.col(column)
    return df.where((c > F.lit(str(as_of)).cast("timestamp_ntz"))
                    | (c < F.lit(floor).cast("timestamp_ntz")))


@dataclass(frozen=True)
class Check:
    kind: str            # not_null | unique | accepted_values | relationships | no_negative | plausible_ts
    model: str
    column: str
    args: dict = field(default_factory=dict)


def failing_rows(models: dict[str, DataFrame], c: Check) -> DataFrame:
    df = models[c.model]
    if c.kind == "not_null":
        return not_null(df, c.column)
    if c.kind == "unique":
        return unique(df, c.column)
    if c.kind == "accepted_values":
        return accepted_values(df, c.column, c.args["values"])
    if c.kind == "relationships":
        return relationships(df, c.column, models[c.args["to"]], c.args["field"])
    if c.kind == "no_negative":
        return no_negative(df, c.column)
    if c.kind == "plausible_ts":
        return plausible_ts(df, c.column, c.args["as_of"], c.args.get("floor", "2000-01-01 00:00:00"))
    raise ValueError(f"unknown check {c.kind}")


_ROW_LEVEL = ("not_null", "no_negative", "plausible_ts")
FLOOR = "2000-01-01 00:00:00"


def _bears(c: Check, column: str) -> str:
    """SQL: whether a row bears on the check. Row-level checks: it fails."""
    if c.kind == "not_null":
        return f"{column} IS NULL"
    if c.kind == "no_negative":
        return f"{column} < 0"
    if c.kind == "plausible_ts":
        return f"({column} > TIMESTAMP_NTZ '{c.args['as_of']}' OR {column} < TIMESTAMP_NTZ '{c.args.get('floor', FLOOR)}')"
    if c.kind == "accepted_values":
        values = ", ".join("'" + v.replace("'", "''") + "'" for v in c.args["values"])
        return f"{column} NOT IN ({values})"  # a null passes
    if c.kind == "unique":
        return f"{column} IS NOT NULL"
    raise ValueError(c.kind)


def _row_failures(df: DataFrame, own: list[tuple[int, Check, str]]) -> DataFrame:
    """(i, failures) of row-level checks: one aggregate of the base."""
    row = df.selectExpr(*[f"count_if({_bears(c, col)}) AS c{i}" for i, c, col in own])
    return row.selectExpr(f"stack({len(own)}, {', '.join(f'{i}, c{i}' for i, _, _ in own)}) AS (i, failures)")


def _hashed(df: DataFrame, own: list[tuple[int, Check, str]], with_value: bool = False) -> DataFrame:
    """(i, h) of each row and check by value that it bears on: the check's number and 64 bits of the value
    (and `v`, the value)."""
    items = ", ".join(f"{i}, if({_bears(c, col)}, xxhash64({i}, {col}), NULL)" + (f", CAST({col} AS STRING)" if with_value else "")
                      for i, c, col in own)
    return df.selectExpr(f"stack({len(own)}, {items}) AS (i, h{', v' if with_value else ''})").where("h IS NOT NULL")


def _in(own: Iterable[int]) -> str:
    return f"i IN ({', '.join(map(str, sorted(own)))})"


def _suspects(models: dict[str, DataFrame], numbered: dict[str, list[tuple[int, Check, str]]]) -> DataFrame:
    """Phase 1 of checks by value, one pass over each base: (i, h) of the hashes that stand for a value outside of the
    list or that occur twice. 12 bytes a row and check are folded in the tasks and shuffled, no value; what
    occurs once is gone after that."""
    once = [i for own in numbered.values() for i, c, _ in own if c.kind == "unique"]
    counted = (union_all([_hashed(models[base], own) for base, own in numbered.items()])
               .groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")))
    return counted.where(f"n > 1 OR NOT {_in(once)}" if once else "true").select("i", "h")


def _offending(models: dict[str, DataFrame], numbered: dict[str, list[tuple[int, Check, str]]], found: set[int],
               suspects: DataFrame) -> DataFrame:
    """Phase 2, a pass over the bases that have suspects: (i, failures), the values themselves counted where
    their hash is suspect, so that equal hashes of different values don't count."""
    again = {base: [x for x in own if x[0] in found] for base, own in numbered.items()}
    rows = union_all([_hashed(models[base], own, with_value=True) for base, own in again.items() if own])
    counted = rows.join(suspects, ["i", "h"], "left_semi").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    unique = [i for own in again.values() for i, c, _ in own if c.kind == "unique"]
    if unique:
        counted = counted.where(f"n > 1 OR NOT {_in(unique)}")
    return counted.groupBy("i").agg(F.count(F.lit(1)).alias("failures"))


def _lost_keys(models: dict[str, DataFrame], checks: list[tuple[int, Check]], folded: dict[str, DataFrame]) -> DataFrame:
    """(i, failures) of relationship checks: the children's keys, folded to counts in the tasks, of all
    children of a parent together, against the parent's keys."""
    by_parent: dict[tuple[str, str], list[tuple[int, Check]]] = {}
    for i, c in checks:
        by_parent.setdefault((c.args["to"], c.args["field"]), []).append((i, c))
    out = []
    for (parent, key), own in by_parent.items():
        children = []
        for i, c in own:
            keys = folded.get(c.model)
            if keys is None:
                keys = models[c.model].groupBy(F.col(c.column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            children.append(keys.where("key IS NOT NULL").selectExpr(f"{i} AS i", "key", "n"))
        lost = relationships(union_all(children), "key", models[parent], key)
        out.append(lost.groupBy("i").agg(F.sum("n").alias("failures")))
    return union_all(out)


def run_checks(models: dict[str, DataFrame], checks: Iterable[Check],
               same_rows: dict[str, tuple[str, dict[str, str]]] | None = None,
               folded: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per check with its failure count (the rows of each test: failing rows, or
    offending distinct values for `unique` / `accepted_values`).

    Row-level checks are one aggregate of each base. Checks by value take two phases: the first leaves the
    hashes of suspect values, a small table in the shared folder; the second reads only bases with suspects,
    and counts only their values. A warehouse without duplicates has none.

    `same_rows` maps a model to `(base model, renamed columns)` when it is a projection of the base (same
    rows, same values), so e.g. raw-table and staging checks share one scan, and equal checks are computed
    once. `folded` gives (key, n) of a model whose foreign keys are known already; other children are folded here.
    """
    from ..session import scratch_path

    checks = list(checks)
    same_rows = same_rows or {}
    number: dict[tuple, int] = {}
    numbered: dict[str, list[tuple[int, Check, str]]] = {}
    related: list[tuple[int, Check]] = []
    slot: list[int] = []
    for c in checks:
        base, renames = (c.model, {}) if c.kind == "relationships" else same_rows.get(c.model, (c.model, {}))
        column = renames.get(c.column, c.column)
        key = (c.kind, base, column, str(sorted(c.args.items())))
        new = key not in number
        i = number.setdefault(key, len(number))
        slot.append(i)
        if new and c.kind == "relationships":
            related.append((i, c))
        elif new:
            numbered.setdefault(base, []).append((i, c, column))
    spark = next(iter(models.values())).sparkSession
    results = []
    by_row = {base: [x for x in own if x[1].kind in _ROW_LEVEL] for base, own in numbered.items()}
    by_value = {base: [x for x in own if x[1].kind not in _ROW_LEVEL] for base, own in numbered.items()}
    by_row, by_value = ({base: own for base, own in x.items() if own} for x in (by_row, by_value))
    results += [_row_failures(models[base], own) for base, own in by_row.items()]
    if by_value:
        path = scratch_path(spark, "suspects")
        _suspects(models, by_value).write.mode("overwrite").parquet(path)
        suspects = spark.read.schema("i int, h long").parquet(path)
        found = {r["i"] for r in suspects.select("i").distinct().collect()}  # numbers of checks
        if found:
            results.append(_offending(models, by_value, found, suspects))
    if related:
        results.append(_lost_keys(models, related, folded or {}))
    names = ", ".join(f"({k}, {i}, '{c.kind}', '{c.model}', '{c.column}')" for k, (i, c) in enumerate(zip(slot, checks, strict=True)))
    declared = spark.sql(f"SELECT * FROM VALUES {names} AS t(k, i, `check`, model, `column`)")
    return declared.join(union_all(results), "i", "left").selectExpr(
        "`check`", "model", "`column`", "CAST(coalesce(failures, 0) AS BIGINT) AS failures")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union many frames as a balanced tree (each union re-analyses its inputs, so a chain
    costs quadratic planning time); the optimizer flattens it into one Union."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


# Projections among the declared models: same rows, same values under the same names.
SAME_ROWS = {
    "raw_github_repositories": ("stg_github_repositories", {}),
    "raw_github_commits": ("stg_github_commits", {}),
    "raw_github_pull_requests": ("stg_github_pull_requests", {}),
    "raw_github_issues": ("stg_github_issues", {}),
    "raw_calendar_events": ("stg_calendar_events", {"source_id": "calendar_event_id"}),
    "raw_gmail_messages": ("stg_gmail_messages", {}),
    "raw_spotify_plays": ("stg_spotify_plays", {}),
    "dim_repository": ("stg_github_repositories", {}),
    "fct_calendar_events": ("stg_calendar_events", {}),
    "fct_email_messages": ("stg_gmail_messages", {}),
    "fct_spotify_plays": ("stg_spotify_plays", {}),
}


# So are the facts, where no two repositories have the id that commits, issues and pull requests name.
FACT_ROWS = {
    "fct_commits": ("stg_github_commits", {}),
    "fct_pull_requests": ("stg_github_pull_requests", {}),
    "fct_issues": ("stg_github_issues", {}),
}

STATES = ("open", "closed")
CATEGORY_VALUES = ("work", "personal", "learning", "meeting", "other")
STATUS_VALUES = ("active", "stale", "inactive")


def declared_checks(as_of: str) -> list[Check]:
    """The warehouse's declared tests: source not-nulls, staging and mart column tests,
    and the two singular tests."""
    cs: list[Check] = []
    for raw in ("raw_github_repositories", "raw_github_commits", "raw_github_pull_requests",
                "raw_github_issues", "raw_calendar_events", "raw_gmail_messages", "raw_spotify_plays"):
        cs += [Check("not_null", raw, "source"), Check("not_null", raw, "source_id")]

    def nn_u(model, *cols):
        return [Check(k, model, c) for c in cols for k in ("unique", "not_null")]

    cs += nn_u("stg_github_repositories", "repository_key", "source_id")
    cs += [Check("not_null", "stg_github_repositories", "github_repository_id")]
    cs += nn_u("stg_github_commits", "commit_key", "source_id")
    cs += [Check("not_null", "stg_github_commits", "commit_id"),
           Check("not_null", "stg_github_commits", "committed_at")]
    for m, k in (("stg_github_pull_requests", "pr_key"), ("stg_github_issues", "issue_key")):
        cs += nn_u(m, k, "source_id")
        cs += [Check("not_null", m, "number"),
               Check("accepted_values", m, "state", {"values": STATES}),
               Check("not_null", m, "created_at"), Check("not_null", m, "updated_at")]
    cs += nn_u("stg_calendar_events", "event_key", "calendar_event_id")
    cs += [Check("accepted_values", "stg_calendar_events", "category", {"values": CATEGORY_VALUES}),
           Check("not_null", "stg_calendar_events", "duration_minutes")]
    cs += nn_u("stg_gmail_messages", "message_key", "source_id")
    cs += [Check("not_null", "stg_gmail_messages", "date")]
    cs += nn_u("stg_spotify_plays", "play_key", "source_id")
    cs += [Check("not_null", "stg_spotify_plays", "played_at")]
    # marts
    cs += nn_u("dim_date", "date")
    cs += nn_u("dim_repository", "repository_key", "github_repository_id")
    cs += nn_u("fct_commits", "commit_key", "commit_id")
    rel = {"to": "dim_repository", "field": "repository_key"}
    cs += [Check("relationships", "fct_commits", "repository_key", rel)]
    cs += nn_u("fct_calendar_events", "event_key", "calendar_event_id")
    cs += [Check("accepted_values", "fct_calendar_events", "category", {"values": CATEGORY_VALUES})]
    cs += nn_u("fct_pull_requests", "pr_key")
    cs += [Check("relationships", "fct_pull_requests", "repository_key", rel),
           Check("accepted_values", "fct_pull_requests", "state", {"values": STATES})]
    cs += nn_u("fct_issues", "issue_key")
    cs += [Check("relationships", "fct_issues", "repository_key", rel),
           Check("accepted_values", "fct_issues", "state", {"values": STATES})]
    cs += nn_u("fct_email_messages", "message_key")
    cs += nn_u("fct_spotify_plays", "play_key")
    cs += nn_u("mart_daily_activity", "date")
    cs += nn_u("mart_project_activity", "repository_key")
    cs += [Check("accepted_values", "mart_project_activity", "status", {"values": STATUS_VALUES})]
    cs += nn_u("mart_monthly_summary", "month")
    # singular tests
    cs += [Check("no_negative", "fct_calendar_events", "duration_minutes"),
           Check("plausible_ts", "fct_commits", "committed_at", {"as_of": as_of})]
    return cs
