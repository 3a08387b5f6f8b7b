"""What a code-hosting sync reads grows with its input, not with its cursors' bands or a record's levels."""

from pyspark.sql import functions as F

from daybook.operators import incremental as D
from daybook.operators import normalize as N
from daybook.operators import sync as SY
from daybook.operators.load import Feed
from daybook.sources.schemas import RAW, SYNC_STATE

NOW = "2024-02-01 00:00:00"
CURSORS = {"a": "2024-01-30T00:00:00+00:00", "b": "2024-01-20T00:00:00+00:00", "c": "2023-01-01T00:00:00+00:00", "d": "noon", "e": None}


def _state(spark):
    return spark.createDataFrame([("github", e, None, c, None, None) for e, c in CURSORS.items()], SYNC_STATE)


def _pages(spark):
    def record(sha, day):
        return ('{"sha":"%s","commit":{"author":{"name":"n","email":"e","date":"%sT00:00:00Z"},"message":"m"}}' % (sha, day))

    days = ("2022-12-31", "2023-06-01", "2024-01-15", "2024-01-20", "2024-01-31")
    rows = [(r, r, "[" + ",".join(record(f"{r}{k}", d) for k, d in enumerate(days)) + "]", (0,)) for r in "abcdef"]
    return spark.createDataFrame(rows + [("g", "g", "[{", (0,))],
                                 "repo_full_name string, repo_source_id string, payload string, __arrival struct<page:int>")


def test_a_sync_reads_its_parsed_rows_once_whatever_the_cursors(spark, monkeypatch):
    staged, seen = SY.staged, {}

    def spy(df, name):
        seen[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(SY, "staged", spy)
    feed = Feed("raw_github_commits", lambda d: N.normalize_commits(d, "repo_full_name", "repo_source_id"))
    repos = spark.createDataFrame([("github", r) for r in "abcdefg"], "source string, source_id string")
    empty = spark.createDataFrame([], RAW["raw_github_commits"])
    run = SY.sync_entities("github", _pages(spark), [feed], "committed_at", {feed.table: empty}, _state(spark), repos,
                           repos.where(F.lit(False)), NOW, F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    assert seen["raw_github_commits"].count("raw_payload#") and seen["raw_github_commits"].count("Union") == 0
    got = sorted(r["source_id"] for r in run.tables[feed.table].collect())
    assert got == ["a:a4", "b:b3", "b:b4", "c:c1", "c:c2", "c:c3", "c:c4", *[f"{r}:{r}{k}" for r in "def" for k in (3, 4)]]
    assert run.audit.first()["records_failed"] == 1
    run.release()


def test_one_read_selects_what_the_bands_select(spark):
    rows = [(e, f"20{y}-0{m}-15 00:00:00", k) for k, (e, y, m) in enumerate((e, y, m) for e in ("a", "b", "c", "d", "e", "f", None)
                                                                          for y in (22, 23, 24) for m in (1, 3, 9))]
    df = spark.createDataFrame(rows, "entity string, t string, id int").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    for state in (_state(spark), _state(spark).where(F.lit(False))):
        by_band, once = (sorted(r["id"] for r in D.select_since(df, state, "github", "entity", "ts", "2024-02-01 00:00:00", banded=b).collect())
                         for b in (True, False))
        assert once == by_band and once


def test_commit_keys_are_looked_up_only_where_the_parse_has_null(spark):
    good = '{"sha":"1","commit":{"author":{"name":"n","date":"2024-01-01T00:00:00Z"},"message":"m"}}'
    cases = {
        good: None,
        good.replace('"n"', "null"): None,
        good.replace('"m"', "null"): None,
        good.replace('"name":"n",', ""): "missing author.name",
        good.replace(',"message":"m"', ""): "missing commit.message",
        good.replace('"author":{"name":"n","date":"2024-01-01T00:00:00Z"},', ""): "missing commit.author",
        good.replace('{"name":"n","date":"2024-01-01T00:00:00Z"}', "null"): "missing author.name",
        '{"sha":"1","commit":null}': "missing commit.author",
        '{"sha":"1","commit":"text"}': "missing commit.author",
        "[1]": "not a JSON object",
    }
    df = spark.createDataFrame([(r, "o/r") for r in cases], "record string, repo string")
    out = N.normalize_commits(df, "repo", "repo")
    assert {r["raw_payload"]: r["_error"] for r in out.collect()} == cases
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    nested = [line for line in plan.split("\n") if "get_json_object" in line]
    assert len(nested) == 1 and nested[0].count("CASE WHEN") == 2
