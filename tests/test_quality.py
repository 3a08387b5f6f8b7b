from daybook.operators import quality as Q


def test_checks_and_report(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (2, "b", "bad"), (None, "c", None)],
                               "k int, v string, s string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert Q.not_null(df, "v").count() == 1
    assert [tuple(r) for r in Q.unique(df, "k").collect()] == [(1, 2)]
    assert [r["value_field"] for r in Q.accepted_values(df, "s", ["x", "y"]).collect()] == ["bad"]
    assert Q.relationships(df, "k", parent, "k").count() == 1
    models = {"m": df, "p": parent}
    checks = [Q.Check("not_null", "m", "v"), Q.Check("not_null", "m", "k"), Q.Check("unique", "m", "k"),
              Q.Check("accepted_values", "m", "s", {"values": ["x", "y"]}),
              Q.Check("relationships", "m", "k", {"to": "p", "field": "k"})]
    rep = {(r["check"], r["column"]): r["failures"] for r in Q.run_checks(models, checks).collect()}
    assert rep == {("not_null", "v"): 1, ("not_null", "k"): 1, ("unique", "k"): 1,
                   ("accepted_values", "s"): 1, ("relationships", "k"): 1}


def test_declared_checks_count():
    cs = Q.declared_checks("2024-01-01 00:00:00")
    assert len(cs) == 94
    assert sum(c.kind in ("no_negative", "plausible_ts") for c in cs) == 2
