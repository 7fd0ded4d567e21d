"""Benchmark leaks against a search over all windows."""

from __future__ import annotations

import random

from quaylake.llm import decontaminate

from . import brute


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("an", "or", "ithe", "ou", "esta", "éla")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(15, 50))) for i in range(20)] + [(20, "only four words here"), (21, ""), (22, None), (23, "!!")]
    docs = [(i, text(rng.randint(5, 200))) for i in range(30)]
    for n, (item, t) in enumerate(items[:20]):
        w = t.split()
        if n % 4 == 1:
            w[rng.randrange(len(w))] = "changed"
        if n % 4 == 2:
            w.insert(rng.randrange(len(w)), "more")
        if n % 4 == 3:
            w = w[: len(w) // 2]
        docs.append((100 + n, f"{text(20)}. {' '.join(w).upper()}!\n{text(9)}"))
    docs += [(200, items[0][1]), (201, items[1][1][:60]), (202, ""), (203, None), (204, "So: only FOUR words, here."), (205, items[2][1] * 2)]
    return docs, items


def found(spark, docs, items, make):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(make(docs), bench).collect()}


def test_against_all_windows(spark, docs_of):
    for seed in (1, 2):
        docs, items = corpus(seed)
        want = brute.leaked(docs, items)
        got = found(spark, docs, items, docs_of)
        assert set(got) == set(want) and len(want) > 12
        # a window between two placed ones may be a little more similar than both
        assert all(0.8 <= got[k] <= want[k] + 1e-9 for k in want)
        assert all(got[k] > 1 - 1e-9 for k in want if want[k] > 1 - 1e-9)


def test_shuffle_joins_give_the_same(spark, docs_of, monkeypatch):
    docs, items = corpus(3)
    want = found(spark, docs, items, docs_of)
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert found(spark, docs, items, docs_of) == want


def test_uneven_weights_lose_no_window(spark, docs_of):
    """Edits near the threshold where one long token carries most of the weight."""
    rng = random.Random(17)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(n))
    items, docs = [], []
    for i in range(60):
        words = [word(4) for _ in range(rng.randint(60, 125))]
        words[rng.randrange(5, len(words) - 5)] = word(100)
        items.append((i, " ".join(words)))
        for n in range(4):
            copy, long = list(words), max(range(len(words)), key=lambda k: len(words[k]))
            for at in rng.sample([k for k in range(len(words)) if abs(k - long) > 6], rng.randint(2, 5)):
                copy[at] = word(4)
            if n == 3:
                copy[long] = word(100)
            docs.append((1000 * n + i, " ".join(copy)))
    want = brute.leaked(docs, items)
    near = {k for k, v in want.items() if v < 0.9}
    assert len(near) > 60
    assert set(found(spark, docs, items, docs_of)) == set(want)


def test_two_thousand_items(spark, docs_of):
    rng = random.Random(23)
    words = [f"w{n}" for n in range(3000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(20, 60))) for i in range(2000)]
    docs = [(i, f"{text(30)} {items[i * 13][1]} {text(30)}") for i in range(100)] + [(500 + i, text(200)) for i in range(50)]
    assert set(found(spark, docs, items, docs_of)) == {(i, i * 13) for i in range(100)}


def test_very_long_text(spark, docs_of):
    item = "this benchmark item has exactly nine words in it"
    docs = [(1, "filler words of a long text " * 30_000 + item + " and more " * 1000), (2, "x" * 300_000)]
    assert set(found(spark, docs, [(1, item)], docs_of)) == {(1, 1)}


def test_blocks_cover_the_fingerprint():
    parts = decontaminate._blocks()
    assert len(parts) == decontaminate.RADIUS + 1
    assert [b for at, w in parts for b in range(at, at + w)] == list(range(64))


def test_defined_cases(spark, docs_of, clashing):
    item = "this benchmark item has exactly nine words in it"
    docs = [(None, f"x {item} y"), (4, item), (4, item), (5, "nothing of the kind")]
    got = found(spark, docs, [(1, item), (1, item), (None, item)], clashing)
    assert set(got) == {(None, 1), (4, 1), (None, None), (4, None)}
    assert found(spark, docs, [], docs_of) == {} and found(spark, [], [(1, item)], docs_of) == {}
    assert found(spark, docs, [(1, ""), (2, None)], docs_of) == {}
