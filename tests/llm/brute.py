"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def components(rows, k):
    """component of each id: (id, text) rows linked at 0.8 of their shingle sets."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                common = len(a & b)
                if common * 100 >= 80 * (len(a) + len(b) - common):
                    x, y = sorted((find(i), find(j)))
                    parent[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def repeated_lines(rows, min_words=30):
    """Deleted line numbers per id: from each pair of places with equal lines, the
    maximal run that the two have in common, if it has the words; rows (id, text)
    with distinct ids."""
    docs = {i: (t or "").split("\n") for i, t in rows}
    words = lambda line: 0 if line == "" else line.count(" ") + 1
    order = sorted(docs, key=lambda x: (x is not None, x))
    places = defaultdict(list)
    gone = defaultdict(set)
    for at, i in enumerate(order):
        for x, line in enumerate(docs[i]):
            for before, y in places[line]:
                a, b = docs[i], docs[order[before]]
                if x and y and a[x - 1] == b[y - 1]:
                    continue  # inside the run of an earlier pair
                n = 0
                while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
                    n += 1
                if sum(map(words, a[x : x + n])) >= min_words:
                    gone[i].update(range(x, x + n))
            places[line].append((at, x))
    return docs, gone


def word_list(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def leaked(docs, items, similarity=0.8):
    """{(doc id, item id): best similarity} over all windows of an item's length."""
    out = {}

    def weigh(words):
        k = min(5, len(words))
        return {tuple(words[i : i + k]): sum(map(len, words[i : i + k])) for i in range(len(words) - k + 1)}

    for item, text in items:
        target = word_list(text)
        if not target:
            continue
        want = weigh(target)
        total = sum(want.values())
        for doc, t in docs:
            words = word_list(t)
            k = min(5, len(target))
            if not any(tuple(words[i : i + k]) in want for i in range(len(words) - k + 1)):
                continue
            for s in range(max(1, len(words) - len(target) + 1)):
                w = words[s : s + len(target)]
                got = {tuple(w[i : i + k]): sum(map(len, w[i : i + k])) for i in range(len(w) - k + 1)}
                sim = sum(v for x, v in got.items() if x in want) / max(sum(got.values()), total)
                if sim >= similarity:
                    out[doc, item] = max(out.get((doc, item), 0), sim)
    return out
