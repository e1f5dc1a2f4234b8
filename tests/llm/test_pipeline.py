"""The pipeline against its stages' plain definitions."""

from collections import Counter

import brute
import corpus_pipeline
import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    d = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    b = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == docs.columns
        docs = corpus_pipeline.staged(out, f"test-{name}")
        seen.append(docs.collect())
    verdict, over = brute.quality([(r["doc_id"], r["text"], r["source"]) for r in d])
    assert not over
    kept = {v[0] for v in verdict if v[-1]}
    texts = {r["doc_id"]: r["text"] for r in d}
    assert {r.doc_id: r.text for r in seen[0]} == {k: texts[k] for k in kept}
    classes = brute.near_classes([(r.doc_id, r.text) for r in seen[0]])
    assert {r.doc_id for r in seen[1]} == set(classes.values())
    leaks = {x[0] for x in brute.contained([(r.doc_id, r.text) for r in seen[1]], [(r["item_id"], r["text"]) for r in b])}
    assert leaks and {r.doc_id for r in seen[2]} == {r.doc_id for r in seen[1]} - leaks
    assert {r.doc_id for r in seen[3]} <= {r.doc_id for r in seen[2]}
    assert Counter(r.doc_id for r in seen[3]) == Counter(r.doc_id for r in seen[4])
    assert {r["size"] for r in seen[4]} == {brute.size(r.text) for r in seen[3]}


def test_run(spark):
    first, again = (corpus_pipeline.run(spark, SF) for _ in range(2))
    assert Counter(map(tuple, first.collect())) == Counter(map(tuple, again.collect()))


def test_stages_take_odd_tables(spark, odd, odd_rows, none):
    for docs in (odd, none):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            if name != "sharding":
                assert out.columns == docs.columns
            rows = corpus_pipeline.staged(out, f"odd-{name}")
        found = rows.collect()
        assert {r.law for r in found} <= {"bytes"} and all(0 <= r.shard < 40 for r in found)
        for s in {r.shard for r in found}:
            slots = sorted(r.slot for r in found if r.shard == s)
            assert slots == list(range(len(slots)))
