from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """Builds a documents table from (doc_id, text) pairs."""

    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture()
def clashing(spark, docs_of):
    """The same with extra columns whose names operators use inside, or that
    differ from theirs in case alone."""

    def make(rows):
        df = docs_of(rows)
        names = ["rep", "bucket", "gram", "rank", "count", "h", "places", "removed", "toxicity", "ids", "TEXT", "_c1"]
        cols = [f"'{n}' AS `{n}`" for n in names]
        return df.selectExpr("*", *cols)

    return make
