"""Rows without an id, and rows that share one, in the pipeline."""

from __future__ import annotations

import pytest

import corpus_pipeline

from ..conftest import SF0001


@pytest.mark.parametrize("limit", (32 << 20, 0))
def test_leaks_of_rows_without_an_id(spark, docs_of, monkeypatch, limit):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_BYTES", limit)
    item = max((r["text"] for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()), key=len)
    clean = "a clean document of its own with words that no benchmark item has at all"
    rows = [(None, item), (None, clean), (None, None), (1, item), (2, clean), (3, item), (3, clean)]
    got = corpus_pipeline.drop_benchmark_leaks(spark, docs_of(rows), SF0001).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == [(2, clean), (3, clean), (None, clean), (None, None)]


def test_rows_of_one_id_in_a_defined_order(spark, docs_of):
    texts = [f"{w} text of its own {w * 2} that shares nothing {w * 3} with any other {w * 4}" for w in "bcadefgh"]
    rows = [(5, None), *[(5, t) for t in texts], (6, None), (6, None), (7, texts[0] + " and more")]
    for n in (1, 3, 7):
        got = corpus_pipeline.drop_near_duplicates(spark, docs_of(rows).repartition(n), SF0001).collect()
        assert {r["doc_id"]: r["text"] for r in got if r["doc_id"] != 7} == {5: min(texts), 6: None}
