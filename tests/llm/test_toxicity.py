"""The compression-distance classifier: held-out accuracy and defined cases."""

from __future__ import annotations

import random
import zlib

import numpy as np

from quaylake.llm import toxicity
from quaylake.llm.catalog import op4_toxicity

from ..conftest import SF001


def corpus(seed, n=300):
    rng = random.Random(seed)
    plain = ["".join(rng.choice(["an", "be", "co", "du", "er", "fi", "go"]) for _ in range(rng.randint(1, 4))) for _ in range(150)]
    bad = ["grimble", "zorkish", "vexo", "dreck", "nabble"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        toxic = i % 8 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((i, " ".join(words).capitalize()))
        labels.append((i, int(toxic)))
    return rows, labels


def test_words_cover_long_texts():
    assert toxicity.words("A b-C é! " + "x" * 150) == [b"a", b"b", b"c", "é".encode(), b"x" * 64, b"x" * 64, b"x" * 22]
    assert toxicity.words(None) == [] == toxicity.words(" 12 ")


def test_held_out_rows(spark, docs_of):
    rows, labels = corpus(1)
    given = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    model = toxicity.train(docs_of(rows), given)
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs_of(rows), model).collect()}
    unseen = [(y, got[i]) for i, y in labels if i % 5 == 0]
    assert all((s >= 0.5) == bool(y) for y, s in unseen)


def test_logistic_curve():
    rng = np.random.default_rng(0)
    x = np.stack([np.ones(2000), rng.normal(size=2000)], axis=1)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(x @ [0.5, 2.0])))).astype(float)
    assert np.allclose(toxicity._logistic(x, y, np.ones(2000)), [0.5, 2.0], atol=0.3)


def test_defined_cases(spark, docs_of, clashing):
    rows, labels = corpus(2, 160)
    table = spark.createDataFrame(labels + [(0, 0), (1, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.train(clashing(rows), table)
    odd = [(1, None), (2, ""), (None, "vexo " * 30), (None, "vexo " * 30), (3, "a" * 5000)]
    got = toxicity.score(clashing(odd), model).collect()
    by = {str(r["text"])[:6]: r["toxicity"] for r in got}
    assert len(got) == 5 and by["None"] == by[""] < 0.5 < by["vexo v"] and got[0]["count"] == "count"
    assert toxicity.score(docs_of([]), model).count() == 0
    one_class = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs_of(rows), one_class) is None
    assert toxicity.train(docs_of(rows), one_class.limit(0)) is None
    assert [r["toxicity"] for r in toxicity.score(docs_of(rows[:2]), None).collect()] == [0.0, 0.0]


def test_query(spark):
    rows = op4_toxicity(spark, SF001).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(y == p for y, p in held) >= 0.95 * len(held)
    assert sum(p and not y for y, p in held) == 0
