"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from quaylake.llm import resample

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text, runs):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(runs[0], runs[1] + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, runs=(1, 1), buckets=10_000, seed="2024", percent=10, min_words=20):
    """{place of the row: (n_words, n_features, weight, score, rank)}"""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    rows = [(i, *features(t, runs)) for i, t in docs]
    s = Counter(bucket(f) for _, _, found in rows for f in found)
    t = Counter(bucket(f) for x in target for f in features(x, runs)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = {}
    for n, (i, words, found) in enumerate(rows):
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[n] = [len(words), len(found), weight, score, None]
    enough = [n for n in out if out[n][0] >= min_words]
    enough.sort(key=lambda n: (-out[n][3], rows[n][0] is not None, rows[n][0] or 0))
    for place, n in enumerate(enough[: percent * len(enough) // 100]):
        out[n][4] = place + 1
    return out


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = ["Alpha", "beta", "GAMMA", "été", "ÉTÉ", "x1", "don't", "naïve-co", "żółw", "K9", "zz"] + [f"w{i}" for i in range(40)]
    docs = [(i, rng.choice([" ", "\n", ", ", "--"]).join(rng.choice(pool) for _ in range(rng.randint(0, 70)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "!!! ???"), (n + 3, "one"), (n + 4, "word " * 20_000)]
    target = [" ".join(rng.choice(pool[:8]) for _ in range(30)) for _ in range(10)] + ["", None]
    return docs, target


@pytest.mark.parametrize("runs,buckets,percent", [((1, 1), 10_000, 10), ((1, 3), 97, 35), ((2, 2), 70_000, 100)])
def test_against_plain_version(spark, docs_of, runs, buckets, percent):
    docs, target = corpus(sum(runs))
    want = plain(docs, target, runs, buckets, percent=percent)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.importance(docs_of(docs), items, runs=runs, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert {r[0]: list(r[1:]) for r in got.collect()} == {docs[n][0]: v for n, v in want.items()}
    drawn = resample.resample(docs_of(docs), items, runs=runs, buckets=buckets, percent=percent).collect()
    texts = {i: t for i, t in docs}
    assert sorted(r["rank"] for r in drawn) == list(range(1, sum(v[4] is not None for v in want.values()) + 1))
    assert all(r["text"] == texts[r["doc_id"]] and r["lang"] == "en" for r in drawn)


def test_spans_overlap_and_keep_to_words():
    text = resample.collapsed("A  b-b,été\n\nB!".encode())
    assert text == "a b b été b".encode()
    assert [text[a:b].decode() for a, b in resample.spans(text, 2)] == ["a b", "b b", "b été", "été b"]
    assert [text[a:b].decode() for a, b in resample.spans(text, 5)] == ["a b b été b"]
    assert list(resample.spans(text, 6)) == [] and list(resample.spans(b"", 1)) == []


def test_ties_repeated_rows_and_null_ids(spark, clashing):
    text = "many words " * 15
    docs = [(None, text), (None, text), (7, text), (7, text), (7, text), (8, "few")]
    rows = resample.importance(clashing(docs), spark.createDataFrame([], "text string"), percent=100).collect()
    want = plain(docs, [], percent=100)
    assert Counter((r[0], *r[1:5]) for r in rows) == Counter((docs[n][0], *v[:4]) for n, v in want.items())
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4, 5]
    by_id = {i: sorted(r["rank"] for r in rows if r["doc_id"] == i) for i in (None, 7)}
    assert by_id == {i: sorted(v[4] for n, v in want.items() if docs[n][0] == i) for i in (None, 7)}
    half = resample.resample(clashing(docs), spark.createDataFrame([("many",)], "text string"), percent=50).collect()
    assert len(half) == 2 and half[0]["rank"] in (1, 2) and half[0]["h"] == "h" and half[0]["TEXT"] == "TEXT"


def test_empty_tables_and_bad_parameters(spark, docs_of):
    none = spark.createDataFrame([], "text string")
    assert resample.importance(docs_of([]), none).count() == 0
    assert resample.resample(docs_of([(1, "a b")]), none).count() == 0
    with pytest.raises(ValueError):
        resample.importance(docs_of([]), none, runs=(0, 1))
