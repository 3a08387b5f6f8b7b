"""Incremental selection and cursors.

State is a `sync_state` DataFrame keyed by (connector, entity_key) with the cursor stored as
text: ISO-8601 for timestamps (Python `isoformat` of a UTC instant), epoch milliseconds for
plays. Cursors are always parsed before comparing, never compared as strings.

The cursor table has one row per entity (e.g. per repository), so it grows with the data:
of it only a row for each band of cursors comes to the driver. No broadcast hint; the planner broadcasts it only under its size threshold (static sizes,
then AQE's measured ones), otherwise a shuffle join where AQE splits a hot entity.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col_of, from_ms, parse_iso_ts, to_ms
from ..sources.schemas import SYNC_STATE
from .upsert import upsert

PRIMARY = "primary"


def _ts(v: datetime | str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp_ntz")


def iso_cursor(ts: Column | str) -> Column:
    """UTC timestamp -> ISO-8601 text as Python's `isoformat()` writes it
    ('2024-06-05T12:00:00+00:00', fraction only when non-zero)."""
    t = col_of(ts)
    frac = F.date_format(t, "SSSSSS")
    return F.when(t.isNotNull(), F.concat(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.lit("+00:00")))


def ms_cursor(ts: Column | str) -> Column:
    """Epoch milliseconds (truncated) as text."""
    return to_ms(ts).cast("string")


def cursor_time(cursor: Column | str, kind: str = "iso") -> Column:
    c = col_of(cursor)
    return from_ms(c) if kind == "ms" else parse_iso_ts(c)


def get_cursors(state: DataFrame, connector: str, entity: str | None = None) -> DataFrame:
    """(entity_key, last_cursor) of one connector, or of one entity."""
    s = state.where(F.col("connector") == connector)
    if entity is not None:
        s = s.where(F.col("entity_key") == entity)
    return s.select("entity_key", "last_cursor")


def select_since(
    df: DataFrame,
    state: DataFrame,
    connector: str,
    entity_col: str,
    ts_col: str,
    default_since: datetime | str,
    full: bool = False,
    kind: str = "iso",
    banded: bool = True,
) -> DataFrame:
    """Rows at or after the entity's cursor, else at or after `default_since`.

    Entities are put in bands by the age of their cursor (`BAND_DAYS` behind the newest one). A band is one
    read of the table from its oldest cursor on, a literal bound that reaches the scan, joined with the
    band's entities alone; so an entity that has been idle for a year widens its own band's read, not the
    others'. A band of few entities also names them to the scan. Entities without a cursor (or with one that
    can't be read, and rows without an entity) are read from `default_since` on. Rows of different bands are
    disjoint, so the bands are a union. `full` drops the bound (per-entity sources re-read everything).

    `banded=False` is for rows that a run has parsed itself, which a band's bound spares no reading: they are
    read once, from the oldest bound on, and meet all cursors in one join.
    """
    if full:
        return df
    cur = get_cursors(state, connector).select(
        F.col("entity_key").alias("__entity"), cursor_time("last_cursor", kind).alias("__since")).where("__since IS NOT NULL")
    entity = df[entity_col].cast("string")
    if not banded:
        oldest = F.least(cur.agg(F.min("__since")).scalar(), _ts(default_since))
        met = df.where(F.col(ts_col) >= oldest).join(cur, entity == F.col("__entity"), "left")
        return met.where(F.col(ts_col) >= F.coalesce(F.col("__since"), _ts(default_since))).select(*df.columns)
    rest = df.where(F.col(ts_col) >= _ts(default_since))
    parts = [rest.join(cur.select("__entity"), entity == F.col("__entity"), "left_anti")]
    newest = cur.agg(F.max("__since").alias("s")).scalar()
    banded = cur.withColumn("__band", cursor_band(F.col("__since"), newest))
    for band in cursor_bands(banded):
        own = banded.where(F.col("__band") == band.number).select("__entity", "__since")
        rows = df.where(F.col(ts_col) >= _ts(band.since))
        if band.entities is not None:
            rows = rows.where(entity.isin(band.entities))
        met = rows.join(own, entity == F.col("__entity")).where(F.col(ts_col) >= F.col("__since"))
        parts.append(met.select(*df.columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Ages behind the newest cursor at which a band ends; what is older is the last band.
BAND_DAYS = (1, 7, 30, 180)
#: A band of so many entities or fewer names them to the scan.
NAMED_ENTITIES = 200


@dataclass(frozen=True)
class Band:
    number: int
    since: str                    # its oldest cursor
    entities: list[str] | None    # if they are few


def cursor_band(since: Column, newest: Column) -> Column:
    """Number of a cursor's band: how many of BAND_DAYS it is behind the newest."""
    return sum((F.when(since < newest - F.expr(f"INTERVAL {d} DAYS"), 1).otherwise(0) for d in BAND_DAYS), F.lit(0))


def cursor_bands(banded: DataFrame) -> list[Band]:
    """The bands that have entities: a row for each, and the entities of those that have few."""
    found = banded.groupBy("__band").agg(F.min("__since").cast("string").alias("since"), F.count(F.lit(1)).alias("n")).collect()
    few = [r["__band"] for r in found if r["n"] <= NAMED_ENTITIES]
    named: dict[int, list[str]] = {k: [] for k in few}
    if few:
        for r in banded.where(F.col("__band").isin(few)).select("__band", "__entity").collect():
            named[r["__band"]].append(r["__entity"])
    return [Band(r["__band"], r["since"], sorted(named[r["__band"]]) if r["__band"] in named else None)
            for r in sorted(found, key=lambda r: r["__band"])]


def new_cursors(batch: DataFrame, entity_col: str, ts_col: str, kind: str = "iso") -> DataFrame:
    """D3: newest timestamp per entity of the batch, as cursor text (partial aggregation)."""
    g = batch.groupBy(F.col(entity_col).cast("string").alias("entity_key")).agg(
        F.max(ts_col).alias("__max"))
    fmt = ms_cursor if kind == "ms" else iso_cursor
    return g.select("entity_key", fmt("__max").alias("last_cursor"))


def state_rows(connector: str, cursors: DataFrame, now: datetime | str) -> DataFrame:
    """Cursor rows in `sync_state` shape for one connector, stamped with the run time."""
    n = _ts(now)
    return cursors.select(
        F.lit(connector).alias("connector"), F.col("entity_key"),
        n.alias("last_successful_sync"), F.col("last_cursor"),
        n.alias("source_updated_at"), n.alias("updated_at")).select(*SYNC_STATE.fieldNames())


def upsert_state(state: DataFrame, rows: DataFrame, now: datetime | str) -> DataFrame:
    """Upsert cursor rows on (connector, entity_key); every column takes the new row."""
    return upsert(state.select(*SYNC_STATE.fieldNames()), rows, ("connector", "entity_key"),
                  now, keep=(), touch=())


def advance(state: DataFrame, batch: DataFrame, connector: str, entity_col: str, ts_col: str,
            now: datetime | str, kind: str = "iso") -> DataFrame:
    """D3 + D8: the state after a batch. Entities without rows keep their old cursor."""
    return upsert_state(state, state_rows(connector, new_cursors(batch, entity_col, ts_col, kind), now), now)


def primary_cursor(batch: DataFrame, ts_col: str, run_start: datetime | str,
                   empty: str = "now", kind: str = "iso") -> DataFrame:
    """Single-entity cursor: max(ts) of the batch, or the run start when the batch is empty
    (`empty='now'`); calendar style (`empty='start'`) always stores the run start."""
    start = _ts(run_start)
    g = batch.agg(F.max(ts_col).alias("__max"))
    v = start if empty == "start" else F.coalesce(F.col("__max"), start)
    fmt = ms_cursor if kind == "ms" else iso_cursor
    return g.select(F.lit(PRIMARY).alias("entity_key"), fmt(v).alias("last_cursor"))


def select_window(df: DataFrame, ts_col: str, lo: datetime | str, hi: datetime | str) -> DataFrame:
    """D5 (backfill): lo <= ts <= hi."""
    return df.where(F.col(ts_col).between(_ts(lo), _ts(hi)))


def select_updated(df: DataFrame, updated_col: str, cursor_ts: datetime | str) -> DataFrame:
    """D5 (incremental): rows updated at or after the cursor, cancellations included."""
    return df.where(F.col(updated_col) >= _ts(cursor_ts))


def select_from_day(df: DataFrame, ts_col: str, cursor_ts: Column) -> DataFrame:
    """Day-granular cursor: everything from the cursor's day on (overlap re-read and
    absorbed by the upsert)."""
    return df.where(F.col(ts_col) >= F.date_trunc("day", cursor_ts).cast("timestamp_ntz"))


def day_query(cursor_ts: Column) -> Column:
    """The mail service's search form of a day cursor: 'YYYY/MM/DD'."""
    return F.date_format(cursor_ts, "yyyy/MM/dd")


def drop_failed(batch: DataFrame, failed: DataFrame, entity_col: str, failed_col: str) -> DataFrame:
    """Rows of entities whose feed failed are dropped (no rows, no cursor change)."""
    f = failed.select(F.col(failed_col).alias("__failed")).distinct()
    return batch.join(f, batch[entity_col] == f["__failed"], "left_anti")
