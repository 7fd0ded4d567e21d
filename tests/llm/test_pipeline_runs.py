"""Line dedup in the pipeline: a copied passage goes as a whole."""

from __future__ import annotations

import corpus_pipeline

from ..conftest import SF0001


def test_light_lines_of_a_copied_passage_go(spark, docs_of):
    passage = "\n".join(" ".join(f"w{n}x{k}" for k in range(m)) for n, m in enumerate((40, 6, 6)))
    rows = [(1, passage), (2, passage), (3, f"before it\n{passage}\nafter it")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_repeated_lines(spark, docs_of(rows), SF0001).collect()}
    assert got == {1: (passage, len(passage)), 3: ("before it\nafter it", 18)}
