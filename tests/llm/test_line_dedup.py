"""Line runs against brute force."""

from __future__ import annotations

import random

from quaylake.llm import line_dedup

from . import brute


def line_rows(seed, n=40):
    rng = random.Random(seed)
    pool = ["", "a b", "one line of five words", "x " * 30 + "x", "p q r s t u v w"] + [f"own {i} of some words here" for i in range(12)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for i in range(n)]
    run = "\n".join(f"line {i} of a passage with many words" for i in range(9))
    return rows + [(n, run + "\nend"), (n + 1, "begin\n" + run), (n + 2, ""), (n + 3, None), (n + 4, run), (n + 5, "\n" * 40)]


def check(spark, got, rows, min_words):
    docs, gone = brute.repeated_lines(rows, min_words)
    assert len(got) == len(rows)
    for r in got:
        i = r["doc_id"]
        removed = {x for s in r["removed"] for x in range(s["start"], s["end"])}
        assert removed == gone[i], i
        assert r["n_lines"] == len(docs[i])
        assert (r["text"] or "") == "\n".join(x for n, x in enumerate(docs[i]) if n not in gone[i])
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_against_brute_force(spark, docs_of):
    for seed, min_words in ((1, 30), (2, 6), (3, 1)):
        rows = line_rows(seed)
        check(spark, line_dedup.remove_repeated_lines(docs_of(rows), min_words=min_words).collect(), rows, min_words)


def test_small_slices_and_shuffle_joins(spark, docs_of, monkeypatch):
    monkeypatch.setattr(line_dedup, "SLICE", 3)
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    rows = line_rows(5)
    check(spark, line_dedup.remove_repeated_lines(docs_of(rows), min_words=20).collect(), rows, 20)


def test_ranks_are_places_in_the_suffix_array(spark):
    ids = [[5, 5, -3, 5], [9, 5, -3, 5], [-3, 5, 5]]
    rows = [(d, 0, i, x) for d, line in enumerate(ids) for i, x in enumerate(line)]
    df = spark.createDataFrame(rows, "doc_id long, text_hash long, i int, id long")
    ranks = {r["id"]: r["rank"] for r in line_dedup._first_ranks(df).collect()}
    ordered = sorted(x for line in ids for x in line)
    assert ranks == {x: ordered.index(x) for x in set(ordered)}


def test_defined_cases(spark, docs_of, clashing):
    line = "word " * 40 + "end"
    rows = [(3, line), (3, line), (None, line), (5, f"{line}\n{line}")]
    got = line_dedup.remove_repeated_lines(clashing(rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == [(3, ""), (3, ""), (5, ""), (None, line)]
    assert got[0]["count"] == "count" and got[0]["rank"] == "rank"
    assert line_dedup.remove_repeated_lines(docs_of([])).count() == 0
    assert line_dedup.remove_repeated_lines(docs_of([(1, None)])).collect()[0]["text"] is None
