"""Deleted lines against maximal repeated runs."""

from __future__ import annotations

from quaylake.llm import line_dedup

from ..conftest import SF0001
from . import brute
from .test_line_dedup import line_rows


def removed_lines(df):
    return {r["doc_id"]: {x for s in r["removed"] for x in range(s["start"], s["end"])} for r in df.collect()}


def test_light_lines_after_a_heavy_one_go_with_the_run(spark, docs_of):
    def copy(*words):
        return "\n".join(" ".join(f"w{n}x{k}" for k in range(m)) for n, m in enumerate(words))

    run = copy(9, 17, 21, 47, 7, 178, 44, 6)
    rows = [(210, run), (539, run), (540, "own line\n" + run + "\nown end"), (541, "\n".join(run.split("\n")[-2:]))]
    got = removed_lines(line_dedup.remove_repeated_lines(docs_of(rows)))
    assert got == {210: set(), 539: set(range(8)), 540: set(range(1, 9)), 541: {0, 1}}


def test_against_maximal_runs(spark, docs_of):
    for seed, min_words in ((1, 30), (2, 6), (3, 1), (5, 20)):
        rows = line_rows(seed)
        docs, gone = brute.repeated_lines(rows, min_words)
        got = removed_lines(line_dedup.remove_repeated_lines(docs_of(rows), min_words=min_words))
        assert got == {i: gone[i] for i in docs}, seed


def test_given_documents_against_maximal_runs(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    lines, gone = brute.repeated_lines([tuple(r) for r in docs.collect()])
    assert removed_lines(line_dedup.remove_repeated_lines(docs)) == {i: gone[i] for i in lines}
