"""The pipeline's stages, one after the other, against what each should keep."""

import re

import corpus_pipeline as cp
from meridian.llm import decontam, pii
from tests.conftest import SF_SMALL
from tests.llm.test_operators import brute_components


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["language_id", "ngram_jaccard", "decontamination", "private_data", "length_buckets"]
    named = stages["language_id"](spark, docs, SF_SMALL)
    assert named.columns == docs.columns and named.count() >= 0.98 * docs.count()
    named = cp.written(named, "t-named")
    one = cp.written(stages["ngram_jaccard"](spark, named, SF_SMALL), "t-one")
    want = {c for d, _, c in brute_components([(r["doc_id"], r["text"]) for r in named.collect()])}
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == want and one.count() == len(want)
    clean = cp.written(stages["decontamination"](spark, one, SF_SMALL), "t-clean")
    leaked = {r["doc_id"] for r in decontam.find_leaks(one, items).collect()}
    assert {r["doc_id"] for r in clean.collect()} == want - leaked
    safe = cp.written(stages["private_data"](spark, clean, SF_SMALL), "t-safe")
    assert safe.schema.names == docs.columns and safe.count() == clean.count()
    before = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in safe.collect():
        assert not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if not pii.base_spans(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]
    packed = stages["length_buckets"](spark, safe, SF_SMALL)
    assert sum(r["n_tokens"] for r in packed.collect()) == sum(len(re.findall(rb"[^\x20\x09-\x0D]+", r["text"].encode())) for r in safe.collect())
