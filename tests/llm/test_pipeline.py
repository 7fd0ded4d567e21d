"""The pipeline stage by stage against plain versions."""

from __future__ import annotations

import public_tokenizers
import sentencepiece

import corpus_pipeline
from quaylake.llm import toxicity

from ..conftest import SF0001
from . import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF0001}/labels.parquet").select("doc_id", "toxic"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    if model is not None:
        counter = toxicity.WindowCounter(model.toxic, model.ordinary, model.floor)
        rows = {i: t for i, t in rows.items() if model.score(*counter.count([t]))[0] < 0.5}
    lines, gone = brute.repeated_lines(rows.items())
    kept = {i: "\n".join(x for n, x in enumerate(lines[i]) if n not in gone[i]) for i in rows}
    rows = {i: t for i, t in kept.items() if t.strip() or not gone[i]}
    component, _ = brute.components(rows.items(), 5)
    rows = {i: t for i, t in rows.items() if component[i] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    leaked = {i for i, _ in brute.leaked(rows.items(), items)}
    rows = {i: t for i, t in rows.items() if i not in leaked}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: sp.encode(t, add_bos=True, add_eos=True) for i, t in rows.items()}
    got = corpus_pipeline.run(spark, SF0001).collect()
    assert len(got) == len(want)
    assert {r["doc_id"]: list(r["ids"]) for r in got} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert {r["doc_id"]: r["n_chars"] for r in got} == {i: len(t) for i, t in rows.items()}


def test_stages_keep_the_columns_and_odd_rows(spark, docs_of):
    plain = "a clean document of its own with words that no other has"
    rows = [(1, plain), (1, plain), (2, None), (3, ""), (None, "no id"), (None, "no id"), (4, plain.upper())]
    for make, n in ((lambda: docs_of(rows), None), (lambda: docs_of([]), 0)):
        docs = make()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF0001)
            assert docs.schema.simpleString() == f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>"
        ids = sorted((str(r["doc_id"]) for r in docs.collect()))
        assert ids == ([] if n == 0 else ["1", "2", "3", "None", "None"])
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() == len(ids)
