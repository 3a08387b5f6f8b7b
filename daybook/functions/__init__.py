"""Scalar Column functions used by the models (all JVM-side expressions)."""

from __future__ import annotations

import zoneinfo
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .categorize import CATEGORIES, DEFAULT_RULES, categorize, categorize_sql, unicode_trim

__all__ = [
    "CATEGORIES", "DEFAULT_RULES", "categorize", "categorize_sql", "unicode_trim",
    "surrogate_key", "iso_week", "month_str", "day_name", "is_weekend", "minutes_between",
    "to_ms", "from_ms", "parse_iso_ts", "parse_iso_date", "local_to_utc", "valid_zone", "floor_day", "trunc_second", "col_of",
]


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """md5 of the parts as text, null -> '' , joined by '|'.

    The inner coalesce matters: `concat_ws` would otherwise skip nulls and shift parts.
    """
    return F.md5(F.concat_ws("|", *[F.coalesce(col_of(p).cast("string"), F.lit("")) for p in parts]))


def iso_week(d: Column | str) -> Column:
    """ISO year and week as 'IYYY-IW' (2024-12-30 -> '2025-01')."""
    d = col_of(d)
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
        F.lit("-"),
        F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
    )


def month_str(ts: Column | str) -> Column:
    """'YYYY-MM' of a date or timestamp."""
    return F.date_format(col_of(ts), "yyyy-MM")


def day_name(d: Column | str) -> Column:
    """Full English day name, e.g. 'Monday'."""
    return F.date_format(col_of(d), "EEEE")


def is_weekend(d: Column | str) -> Column:
    """Saturday or Sunday (Spark dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(col_of(d)).isin(1, 7)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """round(seconds(end - start) / 60) as int, half away from zero; null if an end is null.

    Exact integer arithmetic on the microsecond difference (works on TIMESTAMP and
    TIMESTAMP_NTZ alike): |d| + 30 s, integer-divided by one minute, sign restored.
    """
    us = F.timestamp_diff("MICROSECOND", col_of(start), col_of(end))
    whole_minutes = F.call_function("div", F.abs(us) + F.lit(30_000_000), F.lit(60_000_000))
    return (F.signum(us).cast("long") * whole_minutes).cast("int")


def to_ms(ts: Column | str) -> Column:
    """Epoch milliseconds (truncated) of a UTC timestamp, as a long."""
    c = col_of(ts).cast("timestamp")
    return F.unix_millis(c)


def from_ms(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ in UTC wall time."""
    return F.timestamp_millis(col_of(ms).cast("long")).cast("timestamp_ntz")


#: ISO-8601 date or date-time, with or without an offset.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def parse_iso_ts(s: Column | str) -> Column:
    """ISO-8601 text with 'Z' or an offset -> TIMESTAMP_NTZ (UTC); null when it is anything else
    (a bare time or a bare month is no instant).

    Text without an offset is read as UTC. Requires the UTC session zone (ensure_session).
    """
    c = col_of(s)
    return F.when(c.rlike(ISO_TIME), F.try_to_timestamp(c)).cast("timestamp_ntz")


def parse_iso_date(s: Column | str) -> Column:
    """ISO-8601 calendar date -> DATE; null when it is anything else."""
    c = col_of(s)
    return F.when(c.rlike(ISO_DATE), F.try_to_date(c))


@cache
def zone_ids() -> tuple[str, ...]:
    """The zone database's region ids (those that name a file of the system aside)."""
    return tuple(sorted(zoneinfo.available_timezones() - {"localtime", "posixrules", "Factory"}))


def valid_zone(zone: Column | str) -> Column:
    """True when `zone` is an id of the zone database (a literal set; null zone -> false)."""
    return F.coalesce(col_of(zone).isin(*zone_ids()), F.lit(False))


def local_to_utc(local_ntz: Column | str, zone: Column | str, validate: bool = True) -> Column:
    """Wall-clock time in `zone` -> UTC wall time (TIMESTAMP_NTZ); unknown zone -> UTC.

    The zone is validated first (skip with `validate=False` when the caller already did) so
    that `to_utc_timestamp` never sees an id it would reject. DST gaps move forward,
    overlaps take the earlier offset.
    """
    z = F.when(valid_zone(zone), col_of(zone)).otherwise(F.lit("UTC")) if validate else col_of(zone)
    z = F.when(z == "ROC", F.lit("Asia/Taipei")).otherwise(z)  # the one id that Java calls otherwise
    return F.to_utc_timestamp(col_of(local_ntz).cast("timestamp"), z).cast("timestamp_ntz")


def floor_day(ts: Column | str) -> Column:
    return F.date_trunc("day", col_of(ts)).cast("timestamp_ntz")


def trunc_second(ts: Column | str) -> Column:
    """date_trunc('second') keeping the TIMESTAMP_NTZ type."""
    return F.date_trunc("second", col_of(ts)).cast("timestamp_ntz")
