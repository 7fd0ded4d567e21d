"""LZ phrase fingerprints against a plain parse."""

from __future__ import annotations

import hashlib
import random

from quaylake.llm import lz_fingerprint as lz
from quaylake.llm.catalog import op5_document_fingerprints

from ..conftest import SF0001


def phrase_ends(text):
    seen, start, out = set(), 0, []
    for e in range(1, len(text) + 1):
        if text[start:e] not in seen:
            seen.add(text[start:e])
            out.append(e)
            start = e
    return out


def test_parse():
    rng = random.Random(2)
    for _ in range(800):
        text = "".join(rng.choice("ab é😀") for _ in range(rng.randint(0, 80)))
        half = rng.randint(0, len(text))
        assert lz.Phrases().parse(text, half).copy().parse(text, len(text)).ends == phrase_ends(text)


def test_small_sets_are_exact():
    a, b = "abcdefgh", "abcdzzzz"
    sets = []
    for t in (a, b):
        ends = [0, *phrase_ends(t)]
        sets.append({t[x:y] for x, y in zip(ends, ends[1:])})
    want = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert lz.likeness(lz.from_text(lz.fingerprint(a)), lz.from_text(lz.fingerprint(b))) == want


def test_likeness_follows_the_overlap():
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    sims = []
    for share in (1.0, 0.9, 0.5, 0.0):
        keep = int(len(base) * share)
        other = base[:keep] + "".join(rng.choice("klmnopqrst ") for _ in range(len(base) - keep))
        sims.append(lz.likeness(lz.from_text(lz.fingerprint(base)), lz.from_text(lz.fingerprint(other))))
    assert sims[0] == 1 and sims == sorted(sims, reverse=True) and sims[3] < 0.1
    assert lz.likeness(lz.from_text(""), lz.from_text("")) == 1 and lz.likeness(lz.from_text(""), lz.from_text(lz.fingerprint("a"))) == 0


def expect(rows):
    out = []
    for n, (i, t) in enumerate(rows):
        nxt = rows[(n + 1) % len(rows)][1] or ""
        t = t or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        prints = [lz.fingerprint(x) for x in (t, edited, nxt)]
        sig = [lz.from_text(p) for p in prints]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], lz.likeness(sig[0], sig[1]), lz.likeness(sig[0], sig[2])))
    return out


def test_edits_over_many_ranges(spark, docs_of, clashing):
    rng = random.Random(5)
    rows = [(i * 3 - 20, "".join(rng.choice("abc é") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows[7] = (rows[7][0], None)
    rows[8] = (rows[8][0], "")
    for make, buckets in ((docs_of, 1), (clashing, 7), (docs_of, 200)):
        got = lz.fingerprint_edits(make(rows), buckets=buckets).collect()
        assert sorted(map(tuple, got)) == expect(rows)


def test_defined_cases(spark, docs_of):
    assert lz.fingerprint_edits(docs_of([])).count() == 0
    one = lz.fingerprint_edits(docs_of([(5, "abab")])).collect()
    assert list(map(tuple, one)) == expect([(5, "abab")])
    same = lz.fingerprint_edits(docs_of([(5, "abab")] * 3 + [(None, "first")])).collect()
    assert len(same) == 4 and len({r["fingerprint"] for r in same}) == 2
    assert sorted(r["near_next"] for r in same)[-2:] == [1.0, 1.0]


def test_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    assert sorted(map(tuple, op5_document_fingerprints(spark, SF0001).collect())) == expect(docs)
