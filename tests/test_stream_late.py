"""Rows behind the watermark: kept in the late table and counted."""

from daybook.streaming import ingest as S


def test_a_row_of_sixty_days_ago_is_kept(spark, tmp_path):
    import datetime as dt

    schema = "event_id long, ts timestamp, event_type string"
    landing, out, late, audit, ckpt = (str(tmp_path / x) for x in ("landing", "out", "late", "audit", "ckpt"))
    start = dt.datetime(2024, 3, 1)
    deliveries = [
        [(k, start + dt.timedelta(hours=k), "a") for k in range(48)],
        [(100, start - dt.timedelta(days=60), "old"), (100, start - dt.timedelta(days=60), "old"), (101, start + dt.timedelta(hours=50), "b"),
         (5, start + dt.timedelta(hours=5), "again")],
        [(100, start - dt.timedelta(days=60), "old"), (102, start - dt.timedelta(days=30), "old")],
    ]
    want = [(48, 48, 0, 0), (52, 49, 1, 2), (54, 49, 2, 2)]
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{landing}/delivery={k}")
        stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing))
        dropped = S.run_to_parquet(S.stream_dedup(stream, ["event_id"], "ts", "10 days"), out, ckpt)
        landed = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        S.keep_late(spark, landed, out, late, ["event_id"], str(k), dropped, audit)
        S.keep_late(spark, landed, out, late, ["event_id"], str(k), dropped, audit)  # again: nothing twice
    got = {r["run"]: (r["records_landed"], r["records_passed"], r["records_late"], r["rows_dropped"])
           for r in S.read_late_audit(spark, audit).collect()}
    assert got == {str(k): w for k, w in enumerate(want)}
    kept = sorted(r["event_id"] for r in spark.read.schema(schema).parquet(late).collect())
    assert kept == [100, 102]
