import datetime as dt

from pyspark.sql import functions as F

from daybook import functions as fn


def one(spark, col, rows=None, schema=None):
    df = spark.createDataFrame(rows or [(1,)], schema or "x int")
    return df.select(col.alias("v")).first()["v"]


def test_surrogate_key_null_part_is_empty_text(spark):
    got = one(spark, fn.surrogate_key(F.lit("github"), F.lit(None).cast("string")))
    want = one(spark, F.md5(F.lit("github|")))
    assert got == want


def test_iso_week_year_boundary(spark):
    assert one(spark, fn.iso_week(F.lit("2024-12-30").cast("date"))) == "2025-01"
    assert one(spark, fn.iso_week(F.lit("2024-06-03").cast("date"))) == "2024-23"


def test_minutes_between_rounds_half_away_from_zero(spark):
    s = F.lit("2024-06-01 09:00:00").cast("timestamp_ntz")
    assert one(spark, fn.minutes_between(s, F.lit("2024-06-01 09:30:30").cast("timestamp_ntz"))) == 31
    assert one(spark, fn.minutes_between(s, F.lit("2024-06-01 08:29:30").cast("timestamp_ntz"))) == -31
    assert one(spark, fn.minutes_between(s, F.lit(None).cast("timestamp_ntz"))) is None


def test_weekend_day_name_month(spark):
    d = F.lit("2024-12-28").cast("date")
    assert one(spark, fn.is_weekend(d)) is True
    assert one(spark, fn.day_name(d)) == "Saturday"
    assert one(spark, fn.month_str(d)) == "2024-12"


def test_local_to_utc_zones_and_dst(spark):
    def utc(local, zone):
        return one(spark, fn.local_to_utc(F.lit(local).cast("timestamp_ntz"), F.lit(zone)))

    assert utc("2024-06-01 09:00:00", "America/New_York") == dt.datetime(2024, 6, 1, 13, 0)
    assert utc("2024-06-01 09:00:00", "No/Such") == dt.datetime(2024, 6, 1, 9, 0)
    assert utc("2024-03-10 02:30:00", "America/New_York") == dt.datetime(2024, 3, 10, 7, 30)
    assert utc("2024-11-03 01:30:00", "America/New_York") == dt.datetime(2024, 11, 3, 5, 30)


def test_ms_round_trip(spark):
    ts = F.lit("2024-06-05 12:00:00").cast("timestamp_ntz")
    assert one(spark, fn.to_ms(ts)) == 1717588800000
    assert one(spark, fn.from_ms(F.lit(1717588800000))) == dt.datetime(2024, 6, 5, 12, 0)


# Own titles: every rule, rules that compete (the earlier one wins), and words inside words.
CASES = {
    "TRIAGE of the backlog": "meeting", "1-on-1, Ada": "meeting", "all-hands in June": "meeting", "Demo of the demo": "meeting",
    "lecture notes": "learning", "Pottery COURSE": "learning", "first-class seats": "learning",
    "Haircut": "personal", "family dinner": "personal", "breakwater inspection": "personal",
    "vacation planning": "other", "No Meetings Friday": "other", "laptop return": "other",
    "training review": "meeting", "coffee and study": "learning",
    "Refactor the parser": "work", "Send invoices": "work", "": "other", "\t \n": "other", None: "other",
}


def test_zone_ids(spark):
    df = spark.createDataFrame([("EST",), ("GMT+2",), ("Asia/Tokyo",), ("Moon/Base",), (None,)], "z string")
    assert [r["v"] for r in df.select(fn.valid_zone("z").alias("v")).collect()] == [True, False, True, False, False]


def test_categorize_default_rules(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "t string")
    got = {r["t"]: r["c"] for r in df.select("t", fn.categorize("t").alias("c")).collect()}
    assert got == CASES


def test_categorize_custom_rules(spark):
    rules = (("fastener", ("bolt", "nut")),)
    df = spark.createDataFrame([("Red Bolt",), ("gear",)], "t string")
    got = [r["c"] for r in df.select(fn.categorize("t", rules, "misc").alias("c")).collect()]
    assert got == ["fastener", "misc"]
