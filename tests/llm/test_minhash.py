"""Near-duplicate components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from quaylake.llm import minhash
from quaylake.llm.catalog import op7_minhash_near_dedup
from quaylake.llm.components import components

from ..conftest import SF0001
from . import brute


def test_shingle_sets_follow_the_words():
    assert len(minhash.shingle_set(None, 2)) == 0 == len(minhash.shingle_set(" \t\n\x0b\x0c\r", 2))
    same = minhash.shingle_set("A b c", 2)
    assert np.array_equal(same, minhash.shingle_set("a \x0b b c", 2)) and len(same) == 1
    assert not np.array_equal(minhash.shingle_set("É x", 2), minhash.shingle_set("é x", 2))
    assert not set(minhash.shingle_set("a", 2)) & set(minhash.shingle_set("a b", 2))


def test_odd_sketch_tells_similar_sets():
    rng = np.random.default_rng(1)
    for common, least, most in ((400, 0, 0), (360, 0, 130), (0, 200, 512)):
        a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        b = np.concatenate([a[:common], rng.integers(0, 1 << 63, 400 - common).astype(np.uint64)])
        x, y = (minhash.odd_sketch(minhash.samples(s)) for s in (a, b))
        assert least <= sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= most


def near_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((i, " ".join(copy)))
            i += rng.randint(1, 3)
    return rows


def test_against_brute_force(spark, docs_of):
    rows = near_rows(3) + [(900, ""), (901, None), (902, "one"), (903, "ONE"), (904, "one two"), (905, " \n")]
    for k in (2, 5):
        want, sizes = brute.components(rows, k)
        got = minhash.near_duplicates(docs_of(rows), words=k).collect()
        assert len(got) == len(rows)
        assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (want[i], sizes[i]) for i in want}


@pytest.mark.parametrize("crowd", [256, 2])
def test_last_round_alone_finds_all_links(spark, docs_of, monkeypatch, crowd):
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(minhash, "CROWD", crowd)
    monkeypatch.setattr(minhash, "BLOCK", 2)
    rows = near_rows(4)
    want, _ = brute.components(rows, 2)
    got = minhash.near_duplicates(docs_of(rows), words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_defined_cases(spark, docs_of, clashing):
    text = "a text that stands here several times over"
    rows = [(7, text), (7, text), (None, text), (9, text.upper()), (None, "")]
    got = minhash.near_duplicates(clashing(rows), words=5).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == [(7, 7), (7, 7), (9, 7), (None, None), (None, None)]
    assert minhash.near_duplicates(docs_of([])).count() == 0
    assert minhash.near_duplicates(docs_of([(1, None), (2, "")])).count() == 2


def by_rows(rows, k):
    """Component of each id that has one, of rows that may share ids: rows are linked by
    their sets, and by their ids."""
    numbered, _ = brute.components([(n, None if i is None else t) for n, (i, t) in enumerate(rows)], k)
    sizes = [len(brute.shingles(t, k)) for _, t in rows]
    group = {n: numbered[n] for n in numbered}
    changed = True
    while changed:
        changed = False
        for key in ({n: rows[n][0] for n in group}, dict(group)):
            least = {}
            for n, x in key.items():
                if rows[n][0] is not None and sizes[n]:
                    least[x] = min(least.get(x, group[n]), group[n])
            for n, x in key.items():
                if rows[n][0] is not None and sizes[n] and least[x] < group[n]:
                    group[n], changed = least[x], True
    best = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            best[group[n]] = min(best.get(group[n], i), i)
    return [(i, sizes[n], None if i is None else best[group[n]]) for n, (i, _) in enumerate(rows)]


def test_texts_of_one_id_are_linked_in_any_row_order(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (7, a + " more"), (8, b + " more"), (9, "unlike the others in all its words")]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(order, "doc_id long, text string").coalesce(1)
        got = {(r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(df, words=2).collect()}
        assert got == {(1, 1), (7, 1), (8, 1), (9, 9)}


@pytest.mark.parametrize("rounds", [4, 0])
def test_repeated_ids_against_brute_force(spark, docs_of, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", rounds)
    rng = random.Random(11)
    rows = [(rng.choice([i, i % 17, None]) if rng.random() < 0.3 else i, t) for i, t in near_rows(6)]
    rows += rows[:5] + [(3, ""), (3, None), (500, ""), (500, "one"), (501, "one")]
    want = sorted(by_rows(rows, 2), key=repr)
    got = minhash.near_duplicates(docs_of(rows), words=2).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want


def test_long_and_very_long_texts(spark, docs_of):
    long = " ".join(f"w{i % 5003}x{i % 97}" for i in range(60_000))
    rows = [(4, long), (2, long + " end"), (3, "x " * 50_000), (6, "X\n" * 40_000)]
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got[4][0] == got[2][0] == 2 and got[3] == got[6] == (3, 1)


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (59, 58)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    want, sizes = brute.components(docs, 2)
    for r in op7_minhash_near_dedup(spark, SF0001).collect():
        i = r["doc_id"]
        assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[i], sizes[i], want[i] == i)
