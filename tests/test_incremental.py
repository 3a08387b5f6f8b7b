import datetime as dt

from pyspark.sql import functions as F

from daybook.operators import incremental as D
from daybook.sources.schemas import SYNC_STATE

C = "repo string, ts timestamp_ntz"


def test_cursor_advance_and_inclusive_selection(spark):
    first = spark.createDataFrame([("a", dt.datetime(2024, 6, 1)), ("a", dt.datetime(2024, 6, 5))], C)
    empty_state = spark.createDataFrame([], SYNC_STATE)
    s1 = D.advance(empty_state, first, "github", "repo", "ts", "2024-06-06 00:00:00")
    cur = D.get_cursors(s1, "github", "a").first()
    assert cur["last_cursor"] == "2024-06-05T00:00:00+00:00"
    later = spark.createDataFrame(
        [("a", dt.datetime(2024, 6, 5)), ("a", dt.datetime(2024, 6, 10)), ("a", dt.datetime(2024, 6, 2)),
         ("b", dt.datetime(2024, 6, 3))], C)
    sel = D.select_since(later, s1, "github", "repo", "ts", default_since="2024-06-03 00:00:00")
    got = sorted((r["repo"], r["ts"].day) for r in sel.collect())
    assert got == [("a", 5), ("a", 10), ("b", 3)]      # at-or-after; b uses the default
    s2 = D.advance(s1, sel.where(F.col("repo") == "b"), "github", "repo", "ts", "2024-06-11 00:00:00")
    cursors = {r["entity_key"]: r["last_cursor"] for r in D.get_cursors(s2, "github").collect()}
    assert cursors == {"a": "2024-06-05T00:00:00+00:00", "b": "2024-06-03T00:00:00+00:00"}


def test_partial_failure_drops_entity(spark):
    batch = spark.createDataFrame([("a", dt.datetime(2024, 6, 1)), ("b", dt.datetime(2024, 6, 1))], C)
    failed = spark.createDataFrame([("b",)], "repo string")
    assert [r["repo"] for r in D.drop_failed(batch, failed, "repo", "repo").collect()] == ["a"]


def test_primary_cursor_empty_and_ms(spark):
    empty = spark.createDataFrame([], C)
    assert D.primary_cursor(empty, "ts", "2024-06-07 08:00:00").first()["last_cursor"] == "2024-06-07T08:00:00+00:00"
    one = spark.createDataFrame([("a", dt.datetime(2024, 6, 5, 12, 0))], C)
    assert D.primary_cursor(one, "ts", "2024-06-07 00:00:00", kind="ms").first()["last_cursor"] == "1717588800000"


def test_day_cursor(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 6, 5, 1)), ("a", dt.datetime(2024, 6, 4, 23))], C)
    cur = F.lit("2024-06-05 17:00:00").cast("timestamp_ntz")
    assert D.select_from_day(df, "ts", cur).count() == 1
    assert df.select(D.day_query(cur)).first()[0] == "2024/06/05"


def _events(spark):
    """Entities 0..299 with a row a day for 400 days, entity 300 without a cursor, and rows without one."""
    from pyspark.sql import functions as F

    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(301 * 400).select(
        F.when(F.col("id") % 997 != 0, (F.col("id") % 301).cast("string")).alias("entity"),
        (base + F.make_dt_interval((F.col("id") / 301).cast("int"))).alias("ts"), "id")


def _state(spark, since):
    rows = [("github", e, None, c, None, None) for e, c in since.items()]
    return spark.createDataFrame(rows, SYNC_STATE)


def test_bands_select_what_each_cursor_says(spark):
    import datetime as dt

    day = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(400)]
    since = {str(e): day[399 - (0, 3, 20, 100, 390)[e % 5] if e else 2].isoformat() + "+00:00" for e in range(300)}
    since |= {"7": None, "8": "not a time", "gone": day[5].isoformat() + "+00:00"}
    df = _events(spark)
    got = {r["id"] for r in D.select_since(df, _state(spark, since), "github", "entity", "ts", "2024-12-01 00:00:00").collect()}
    want = set()
    for i in range(301 * 400):
        entity = str(i % 301) if i % 997 else None
        own = since.get(entity)
        bound = dt.datetime.fromisoformat(own[:19]) if own and own != "not a time" else dt.datetime(2024, 12, 1)
        if day[i // 301] >= bound:
            want.add(i)
    assert got == want
    empty = D.select_since(df, _state(spark, {}), "github", "entity", "ts", "2025-01-30 00:00:00")
    assert empty.count() == sum(day[i // 301] >= dt.datetime(2025, 1, 30) for i in range(301 * 400))


def test_an_idle_entity_widens_its_own_band_only(spark, tmp_path):
    """One year-old cursor: the other entities' read still starts at their own oldest cursor."""
    import re

    from tests.test_plans import plan

    _events(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    since = {str(e): "2025-01-30T00:00:00+00:00" for e in range(300)} | {"0": "2024-01-03T00:00:00+00:00"}
    out = D.select_since(df, _state(spark, since), "github", "entity", "ts", "2025-02-01 00:00:00")
    bounds = re.findall(r"PushedFilters: .*GreaterThanOrEqual\(ts,(\S+?)\)(.*)", plan(out))
    assert sorted(b for b, _ in bounds) == ["2024-01-03T00:00", "2025-01-30T00:00", "2025-02-01T00:00"]
    old = next(rest for b, rest in bounds if b == "2024-01-03T00:00")
    assert "EqualTo(entity,0)" in old or "In(entity, [0])" in old
    assert out.where("entity = '0'").count() > 390 and out.where("entity = '1'").count() < 10
