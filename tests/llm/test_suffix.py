"""Suffix arrays and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quaylake.llm import suffix_dedup
from quaylake.llm.catalog import op2_suffix_array_dedup
from quaylake.llm.suffix_array import _words, common_prefix, suffix_array

from ..conftest import SF0001


def brute(rows):
    """(n_bytes, removed spans) per document, documents in order of id and text."""
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        spans, at = [], 0
        while (at := gone.find(1, at)) >= 0:
            end = gone.find(0, at)
            end = len(b) if end < 0 else end
            spans.append((at, end))
            at = end
        out[i] = (len(b), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def test_suffix_array_small_alphabets():
    rng = np.random.default_rng(5)
    for _ in range(400):
        sigma = int(rng.integers(2, 6))
        text = np.append(rng.integers(1, sigma, rng.integers(0, 70)), 0).astype(np.uint8)
        raw = text.tobytes()
        assert suffix_array(text, sigma).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


def test_suffix_array_runs_and_depth():
    text = np.append(np.full(3000, 1), 0).astype(np.uint8)
    assert suffix_array(text, 2).tolist() == list(range(3000, -1, -1))
    rng = np.random.default_rng(6)
    text = np.append(np.tile(rng.integers(1, 4, 40), 30), 0).astype(np.uint8)
    raw = text.tobytes()
    array = suffix_array(text, 4, depth=100)
    heads = [raw[i : i + 100] for i in array]
    assert heads == sorted(heads)


def test_common_prefix():
    rng = np.random.default_rng(7)
    text = rng.integers(1, 3, 400).astype(np.uint8)
    a, b = rng.integers(0, 280, 300), rng.integers(0, 280, 300)
    got = common_prefix(_words(text), a, b, 100)
    for i, j, n in zip(a, b, got):
        assert n == next((k for k in range(100) if text[i + k] != text[j + k]), 100)


def rows_of(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    common = text(260)
    rows = [(i, text(rng.randint(0, 300)) + common[rng.randint(0, 80) : rng.randint(150, 260)] + text(40)) for i in range(25)]
    rows += [(30, rows[3][1]), (31, rows[3][1]), (32, "ab" * 400), (33, "x" + "ab" * 300), (34, "z" * 150), (35, ""), (36, None)]
    rows += [(37, "z" * 99), (38, common[:100]), (39, common[1:101] + "!"), (-4, common)]
    return rows


@pytest.mark.parametrize("crowded", [4096, 1])
def test_against_brute_force(spark, docs_of, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "SEGMENTS_PER_GRAM", crowded)
    rows = rows_of(11)
    want = brute(rows)
    got = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) == (n, spans, kept), r["doc_id"]


def test_shuffle_joins_give_the_same(spark, docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", 0)
    rows = rows_of(12)
    want = brute(rows)
    for r in suffix_dedup.remove_repeats(docs_of(rows)).collect():
        assert [tuple(s) for s in r["spans"]] == want[r["doc_id"]][1]


def test_defined_cases(spark, docs_of, clashing):
    same = "the same line of words " * 8
    rows = [(1, same), (1, same), (None, same), (2, same)]
    got = sorted(((r["doc_id"], r["n_removed"]) for r in suffix_dedup.remove_repeats(clashing(rows)).collect()), key=str)
    inner = len(same) - 23  # every string of 100 bytes but those in the first period
    n = len(same)
    assert got == [(1, n), (1, n), (2, n), (None, inner)]
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    want = brute(docs)
    rows = op2_suffix_array_dedup(spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (n, sum(b - a for a, b in spans), len(spans))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_texts_and_runs_are_shuffled_once(spark, docs_of):
    """No exchange of runs before a filter, and one of texts, whatever their number."""
    rows = rows_of(13)
    out = suffix_dedup.remove_repeats(docs_of(rows))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    texts = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line]
    assert sum("ReusedExchange" in line for line in plan.splitlines()) >= 1, plan
    assert "BroadcastHashJoin" not in plan and texts


def test_segments_alone_in_their_gram_stay_out_of_the_shards(spark, docs_of):
    """Copies of whole texts need no shard; a text that repeats itself does."""
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(600))
    packed = docs_of([(i, text) for i in range(5)]).select("doc_id", "text")
    found = packed.mapInArrow(suffix_dedup._occurrences, suffix_dedup._OCCURRENCE)
    kinds = {r["kind"]: r["n"] for r in suffix_dedup._with_kinds(found).groupBy("kind").agg({"*": "count"}).toDF("kind", "n").collect()}
    assert set(kinds) == {suffix_dedup.COPY}
    rows = [(1, "ab" * 150), (2, "xyz" * 50)]
    want = brute(rows)
    for r in suffix_dedup.remove_repeats(docs_of(rows)).collect():
        assert r["n_removed"] > 0 and [tuple(s) for s in r["spans"]] == want[r["doc_id"]][1]


def test_many_equal_rows_of_one_document(spark, docs_of):
    """Rows of one id and one text are one document, in any number of batches."""
    text = rows_of(14)[0][1] * 3
    rows = [(None, text)] * 300 + [(1, text)]
    rng = random.Random(1)
    rng.shuffle(rows)
    got = suffix_dedup.remove_repeats(docs_of(rows).repartition(6)).collect()
    want = brute([(-1, text), (1, text)])
    assert len(got) == 301
    for r in got:
        assert [tuple(s) for s in r["spans"]] == want[1 if r["doc_id"] == 1 else -1][1]
