"""Licence scans against a search over all alignments."""

from __future__ import annotations

import math
import random
import re

import pytest

from quaylake.llm import license_scan
from quaylake.llm.license_scan import BASE_PHRASES, NOTICES, Template

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALL = BASE_PHRASES + NOTICES


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, templates=ALL, share=80):
    """Per row: number of words and the sorted places."""
    rows = [words_of(t) for _, t in docs]
    cut = [t.words() for t in templates]
    weight = {w: 1 + math.floor(1000 * math.log((len(rows) + 1) / (sum(w in set(r) for r in rows) + 1))) for c in cut for w, _ in c}
    out = []
    for row in rows:
        found = []
        for t, c in zip(templates, cut, strict=True):
            total = sum(weight[w] for w, _ in c)
            for start in range(1 - len(c), len(row)):
                here = [0 <= start + i < len(row) and row[start + i] == w for i, (w, _) in enumerate(c)]
                if all(x or not must for x, (_, must) in zip(here, c, strict=True)):
                    got = sum(weight[w] for x, (w, _) in zip(here, c, strict=True) if x)
                    if got * 100 >= share * total:
                        found.append((start, start + len(c), t.label, got / total, t.base))
        out.append((len(row), sorted(found)))
    return out


def scanned(df):
    places = lambda r: [(x["start"], x["end"], x["label"], x["share"], x["base"]) for x in r["licenses"]]
    return [(r["n_words"], places(r)) for r in df.collect()]


def corpus(seed):
    rng = random.Random(seed)
    common = [w for t in ALL for w, _ in t.words()]
    docs = []
    for i in range(80):
        words = [rng.choice(common) if rng.random() < 0.3 else f"word{rng.randint(0, 50)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            notice = [w for w, _ in rng.choice(ALL).words()]
            if rng.random() < 0.4:
                notice[rng.randrange(len(notice))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if rng.random() < 0.2 else w for w in notice]
        docs.append((i, rng.choice([" ", "\n", "; "]).join(words)))
    return docs + [(80, None), (81, ""), (82, "CC BY CC-BY (cc/by)"), (83, "license, version 2.0"), (84, "K cc by 4.0 été")]


@pytest.mark.parametrize("seed,share", [(1, 80), (2, 80), (3, 40), (4, 100)])
def test_against_all_alignments(spark, docs_of, seed, share):
    docs = corpus(seed)
    want = {i: x for (i, _), x in zip(docs, plain(docs, share=share), strict=True)}
    df = license_scan.scan(docs_of(docs), share=share)
    got = dict(zip([r["doc_id"] for r in df.collect()], scanned(df), strict=True))
    assert got == want and sum(len(x[1]) for x in want.values()) > 50


def test_only_the_rarest_words_are_indexed():
    template = Template("x", "the terms of the [rare thing] apply to the work")
    weights = {"the": 1, "of": 1, "to": 1, "terms": 40, "apply": 30, "work": 30, "rare": 900, "thing": 500}
    assert license_scan.rare_postings([template], weights) == {"rare": [(0, 4)]}
    assert license_scan.rare_postings([Template("y", "a b a")], {"a": 1, "b": 1}) == {"a": [(0, 0)]}


def test_long_text_and_repeats(spark, docs_of):
    docs = [(1, "all rights reserved. " * 3000 + "free general apache " * 5000)]
    got = scanned(license_scan.scan(docs_of(docs)))
    assert got[0][0] == 24000 and [x[0] for x in got[0][1]] == list(range(0, 9000, 3))


def test_defined_cases(spark, docs_of, clashing):
    docs = [(None, "Released under the MIT License."), (3, "Released under the MIT License."), (3, "Released under the MIT License."), (4, None)]
    rows = license_scan.scan(clashing(docs)).collect()
    assert sorted((str(r["doc_id"]), [x["label"] for x in r["licenses"]]) for r in rows) == [
        ("3", ["mit"]), ("3", ["mit"]), ("4", []), ("None", ["mit"]),
    ]
    assert rows[0]["TEXT"] == "TEXT" and rows[0]["_c1"] == "_c1"
    again = license_scan.scan(license_scan.scan(docs_of(docs)))
    assert again.columns.count("licenses") == 1 and again.count() == 4
    assert license_scan.scan(docs_of([])).count() == 0
    assert scanned(license_scan.scan(docs_of([(1, "a b")]), templates=[])) == [(2, [])]
    with pytest.raises(ValueError):
        license_scan.scan(docs_of([]), templates=[Template("none", "!!")])
