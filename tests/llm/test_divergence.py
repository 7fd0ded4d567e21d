"""The divergence audit against a plain version in exact integers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quaylake.llm import divergence

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
BILLION = 10**9
DOCS = "doc_id long, text string, lang string, source string"


def terms_of(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(rows, min_docs=3, top=200):
    groups, docs, counts = defaultdict(set), Counter(), Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = terms_of(text)
        docs.update((lang, t) for t in set(found))
        counts.update((lang, source, t) for t in found)
    out = set()
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]
        v = len(kept)
        shares = {}
        for s in [*sources, None]:
            n = {t: sum(counts[lang, x, t] for x in (sources if s is None else [s])) for t in kept}
            total = sum(n.values())
            shares[s] = {t: 1 + BILLION * (n[t] + 1) // (total + v) for t in kept}
        gap = lambda p, q: (p - q) * (p - q) // q
        for s in sources:
            pairs = [(x, sum(gap(shares[s][t], shares[x][t]) for t in kept)) for x in sources if x != s]
            more = [t for t in kept if counts[lang, s, t] and shares[s][t] > shares[None][t]]
            own = [(t, gap(shares[s][t], shares[None][t])) for t in more]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", own, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])}
    return out


def corpus(seed, n=150):
    rng = random.Random(seed)
    pool = ["The", "of", "été", "ß", "don't", "x9y", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "żółwżółw"]
    pool += [a * k for a in ("ab", "é", "q") for k in (1, 4, 8, 9, 20)] + ["Donaudampfschifffahrtsgesellschaft", "Donaudampfschifffahrtsgesellschaften"]
    rows = []
    for _ in range(n):
        source = f"s{min(rng.randint(0, 9), 6)}"
        text = rng.choice([" ", "\n", "3", "_"]).join(rng.choice(pool) for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "en", "fr"]), source))
    rows += [(None, "en", "empty"), ("a b c", None, None), ("a b c", "", "x"), (None, "xx", "p"), ("!", "xx", "r"), ("alone", "yy", "one")]
    return rows


def audited(spark, rows, **options):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS).repartition(3)
    got = [tuple(r) for r in divergence.audit(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_size": 2, "rows_per_slice": 7}), (3, {"block_size": 3, "top": 4, "min_docs": 1})])
def test_against_plain_version(spark, seed, options):
    rows = corpus(seed)
    kept = {k: v for k, v in options.items() if k in ("top", "min_docs")}
    assert audited(spark, rows, **options) == plain(rows, **kept)


def test_small_chunks_and_shuffle_joins(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(divergence, "CELLS", 5)
    rows = corpus(4) + [("word " * 30_000, "en", "s1")] * 3
    assert audited(spark, rows) == plain(rows)


def test_counts_of_a_chunk():
    texts = [t for t, _, _ in corpus(5) if t]
    groups = [i // 40 for i in range(len(texts))]
    want, held = Counter(), Counter()
    for g, t in zip(groups, texts, strict=True):
        want.update((g, x.encode()) for x in terms_of(t))
        held.update((g, x.encode()) for x in set(terms_of(t)))
    got = [(g, t, n, d) for terms, group, ns, docs in divergence.count_terms([t.encode() for t in texts], groups)
           for t, g, n, d in zip(terms, group.tolist(), ns.tolist(), docs.tolist(), strict=True)]
    assert len(got) == len(want)
    assert {(g, t): (n, d) for g, t, n, d in got} == {k: (want[k], held[k]) for k in want}
    assert list(divergence.count_terms([b"", b"123"], [0, 0])) == []


def test_radix_order_is_stable():
    rng = np.random.default_rng(3)
    high, low = (rng.integers(0, 1 << 63, 500, dtype=np.uint64) >> np.uint64(s) for s in (61, 40))
    want = sorted(range(500), key=lambda i: (high[i], low[i], i))
    assert divergence.radix_order([high, low]).tolist() == want


def test_shares_are_exact_for_large_counts():
    rng = random.Random(9)
    for _ in range(300):
        total = rng.randint(1, 9 * 10**15)
        n = rng.randint(0, total - 1)
        assert divergence.shares(np.array([n]), np.array([total]))[0] == 1 + BILLION * (n + 1) // total


def test_spark_shares_are_exact_for_large_counts(spark):
    rows = [(9 * 10**14, 9 * 10**14 + 7, 12), (0, 1, 1), (10**16 + 1, 3 * 10**16 + 11, 10**9)]
    df = spark.createDataFrame(rows, "n long, total long, v long")
    got = df.select("n", "total", "v", divergence._share(df.n, df.total, df.v).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + BILLION * (n + 1) // (t + v) for n, t, v in rows]


def test_empty_table_and_clashing_columns(spark, clashing):
    assert audited(spark, []) == set()
    rows = [(1, "alpha beta"), (2, "alpha beta"), (3, "alpha")]
    got = divergence.audit(clashing(rows)).collect()
    assert got == []  # one source: no pair, and no term above its language
