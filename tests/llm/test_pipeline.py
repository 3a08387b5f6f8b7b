"""The pipeline's stages on the given table, each judged on its own input."""

import corpus_pipeline
from daybook.llm.tables import read_table, written

from . import brute
from .conftest import keyed


def test_stages_one_by_one(spark, sf):
    docs = read_table(spark, sf, "documents")
    items = [r["text"] for r in read_table(spark, sf, "benchmark").collect()]
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf), f"test-{name}")
        at[name] = ([(r["doc_id"], r["text"]) for r in docs.collect()], out)
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
    rows, out = at["language_id"]
    assert {r["doc_id"] for r in out.collect()} >= {i for i, t in rows if t and sum(c.isalpha() for c in t) > 50}
    rows, out = at["line_dedup"]
    gone = brute.line_dedup(rows)
    left = [(i, brute.without(t or "", gone[i, t])) for i, t in rows if not gone[i, t] or brute.words(brute.without(t, gone[i, t]))]
    assert keyed(out, "doc_id", "text") == sorted(left, key=repr)
    rows, out = at["near_dedup"]
    comp = brute.components([(i, brute.fingerprint(t)) for i, t in rows])
    assert keyed(out, "doc_id") == sorted([(i,) for (i, _), c in zip(rows, comp, strict=True) if i == c], key=repr)
    rows, out = at["decontamination"]
    kept = {r["doc_id"] for r in out.collect()}
    dirty = {i for i, t in rows if any(brute.contains(t, x) for x in items)}
    assert not kept & dirty and len(kept) >= len(rows) - len(dirty) - 2
    rows, out = at["packing"]
    assert {r["doc_id"] for r in out.collect()} == {i for i, _ in rows}


def test_run_is_its_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    total = out.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert total and all(r["sum(length)"] == r["max(doc_tokens)"] for r in total)


def test_stages_of_odd_documents(spark, docs, none, sf):
    """Nulls, empty and long texts, repeated rows and clashing columns pass through every stage."""
    for table in (docs, none):
        for name, stage in corpus_pipeline.STAGES:
            out = written(stage(spark, table, sf), f"odd-{name}")
            if name != "packing":
                assert out.schema == docs.schema
                table = out
