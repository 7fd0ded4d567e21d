"""Feistel shuffle against a pure-Python model, and its defined cases."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
import xxhash

from quaylake.llm import sharding
from quaylake.llm.catalog import op10_sharding

from ..conftest import SF0001


def _hash(x: int, key: int) -> int:
    """Spark's xxhash64 of two longs (the second seeded by the first)."""
    seed = 42
    for v in (x, key):
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def _permute(x: int, n: int, seed: int) -> int:
    a = math.ceil(math.sqrt(n))
    b = math.ceil(n / a)
    while True:
        left, right = divmod(x, b)
        for r in range(sharding.ROUNDS):
            if r % 2 == 0:
                left = (left + _hash(right, seed + r) % a) % a
            else:
                right = (right + _hash(left, seed + r) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 257])
def test_permutation_matches_model(spark, n):
    df = spark.range(n).selectExpr("id AS k")
    got = {r["row_number"]: (r["position"], r["shard"], r["slot"]) for r in sharding.shard_rows(df, ["k"], 5, seed=9).collect()}
    assert sorted(got) == list(range(n))
    for x, (position, shard, slot) in got.items():
        assert position == _permute(x, n, 9)
        assert (shard, slot) == (position % 5, position // 5)


def test_repeats_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a")] * 40 + [(None, None)] * 3 + [(2, "b")], "key0 long, _n string")
    got = sharding.shard_rows(df, ["key0", "_n"], 4).collect()
    assert len(got) == 44 and sorted(r["position"] for r in got) == list(range(44))
    assert max(Counter(r["shard"] for r in got).values()) == 11
    assert sharding.shard_rows(df.limit(0), ["key0"], 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(df, ["key0"], 0)


def test_same_place_whatever_the_partitioning(spark):
    df = spark.range(500).selectExpr("id * 7 AS k")
    place = lambda d: {(r["k"], r["shard"], r["slot"]) for r in sharding.shard_rows(d, ["k"], 24, 3).collect()}
    assert place(df.repartition(9)) == place(df.repartition(2, "k"))


def test_write_shards(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "doc_id long, text string")
    sharding.write_shards(df, ["doc_id"], 4, f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards").collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == [(i, f"t{i}") for i in range(30)]
    assert {(r["shard"], r["slot"]) for r in back} == {(i % 4, i // 4) for i in range(30)}


def test_query(spark):
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = op10_sharding(spark, SF0001).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) <= set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for r in rows:
        assert (r["size"], r["text_crc32"], r["law"]) == (len(docs[r["doc_id"]]) + 8, zlib.crc32(docs[r["doc_id"]]), "rows")
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
