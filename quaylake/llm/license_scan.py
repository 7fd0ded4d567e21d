"""Licence scan by a positional index of rare tokens.

1. A-Z go to lower case; words are runs of letters, digits and non-ASCII
   characters. A template is a short notice cut the same way; words in square
   brackets are its mandatory key phrases.
2. Licence words are the words of the templates. Their inverse document
   frequency comes from one pass over all documents (in integers,
   ``1 + floor(1000 ln((N+1)/(df+1)))``); it is their weight.
3. Of each template only the words of highest IDF are indexed, with their
   positions: as many as it takes so that the others alone weigh less than any
   match must. So a match holds an indexed word, and none is missed.
4. A file's words that are in the index (its licence words of highest IDF) are
   looked up; a posting fixes where the template would start. At each such
   start the template's postings are intersected by relative position.
5. An alignment is a licence if all mandatory words stand in their places and
   the words that agree weigh 80 in 100 of the template or more.

Everything after the word counts is a projection of one row: no text is
shuffled, and a frequent licence word costs its own files only. The index is a
constant of the plan; templates are limited to ``MAX_TEMPLATE_WORDS`` words in all.

Defined cases: a NULL or empty text has no words and no licences; places that
overlap or repeat count each; rows of one id are scanned each for itself; an
empty table gives no rows. Very long texts are handled like others, in time
proportional to their words. Columns are carried by place; columns that have the
names of results are replaced.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import only, position

#: share of a template's weight that must agree, in hundredths
SHARE = 80
MAX_TEMPLATE_WORDS = 20_000
RESULTS = ("n_words", "licenses")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice; words in square brackets are mandatory. ``base`` marks the plain
    phrases that are counted place by place."""

    label: str
    notice: str
    base: bool = False

    def words(self) -> list[tuple[str, bool]]:
        """(word, whether it is mandatory) in order."""
        out = []
        for part in re.findall(r"\[[^\]]*\]|[^\[\]]+", self.notice):
            plain = part.translate(str.maketrans(_UPPER, _LOWER))
            out += [(w, part.startswith("[")) for w in re.split(_BETWEEN, plain) if w]
        return out


# Phrases counted in any case, and the usual wording of notices.
BASE_PHRASES = (
    Template("cc-by", "[cc by]", base=True),
    Template("gpl", "[general public license]", base=True),
    Template("reserved", "[all rights reserved]", base=True),
)
NOTICES = (
    Template("apache-2.0", "Licensed under the [Apache License], Version [2.0]"),
    Template("mit", "Released under the [MIT License]"),
    Template("mit", "Licensed under the [MIT License]"),
    Template("mit", "[Permission is hereby granted, free of charge], to any person obtaining a copy of this software"),
    Template("gpl-2.0", "This work is licensed under the GNU [General Public License], version [2]"),
    Template("gpl-3.0", "This work is licensed under the GNU [General Public License], version [3]"),
    Template("lgpl", "under the terms of the GNU [Lesser General Public License]"),
    Template("agpl", "under the terms of the GNU [Affero General Public License]"),
    Template("mpl-2.0", "subject to the terms of the [Mozilla Public License], v. [2.0]"),
    Template("bsd", "[Redistribution and use in source and binary forms], with or without modification, are permitted"),
    Template("cc-by-4.0", "Licensed under [CC BY 4.0]"),
    Template("cc-by-sa-4.0", "Licensed under [CC BY-SA 4.0]"),
    Template("cc-by-nc-4.0", "Licensed under [CC BY-NC 4.0]"),
    Template("cc0-1.0", "[CC0 1.0] Universal Public Domain Dedication"),
    Template("isc", "Permission to [use, copy, modify, and/or distribute this software] for any purpose"),
    Template("unlicense", "This is free and unencumbered software [released into the public domain]"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def word_weights(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "text") -> dict[str, int]:
    """IDF weight of each word over all documents; one row a word is collected."""
    known = F.array(*[F.lit(w) for w in sorted(vocabulary)]).cast("array<string>")
    # the empty word stands for the document itself
    seen = F.concat(F.array(F.lit("")), F.array_intersect(words_of(F.col("text")), known))
    counts = only(docs, text=text_col).select(F.explode(seen).alias("word")).groupBy("word").count()
    df = {r["word"]: r["count"] for r in counts.collect()}
    n = df.get("", 0)
    return {w: 1 + math.floor(1000 * math.log((n + 1) / (df.get(w, 0) + 1))) for w in vocabulary}


def rare_postings(templates: Sequence[Template], weights: dict[str, int], share: int = SHARE) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, position) of the indexed words."""
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(templates):
        words = template.words()
        total = sum(weights[w] for w, _ in words)
        # a match weighs this much at least (in hundredths)
        least = max(share * total, 100 * sum(weights[w] for w, must in words if must))
        rest = total
        for at in sorted(range(len(words)), key=lambda i: (-weights[words[i][0]], i)):
            if 100 * rest < least:
                break
            index.setdefault(words[at][0], []).append((t, at))
            rest -= weights[words[at][0]]
    return index


def _constant(value, schema: str) -> Column:
    """A nested constant; Catalyst folds it into a literal."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _alignments(words: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
    """Distinct (template, start) at which an indexed word of the file is in place."""
    postings = _constant({w: [{"t": t, "at": at} for t, at in p] for w, p in index.items()}, "map<string,array<struct<t:int,at:int>>>")
    rare = F.array(*[F.lit(w) for w in sorted(index)])
    placed = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*sorted(index)))
    starts = F.transform(
        placed,
        lambda x: F.transform(F.element_at(postings, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["at"]).alias("start"))),
    )
    nothing = F.array().cast("array<struct<t:int,start:int>>")
    return F.when(F.arrays_overlap(words, rare), F.array_distinct(F.flatten(starts))).otherwise(nothing)


def scan(
    docs: DataFrame, templates: Sequence[Template] = BASE_PHRASES + NOTICES, text_col: str = "text", share: int = SHARE
) -> DataFrame:
    """``docs`` with ``n_words`` and ``licenses``: per place ``label``, ``start`` and ``end``
    (words from 0, end exclusive), ``share`` (of the weight, 0 to 1) and ``base``, by
    start, end and label."""
    cut = [t.words() for t in templates]
    if not all(cut) or sum(map(len, cut)) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates need words, {MAX_TEMPLATE_WORDS} in all at most")
    fields = docs.columns
    places = [i for i, c in enumerate(fields) if c not in RESULTS]
    text_at = position(docs, text_col)
    plain = docs.toDF(*[f"_c{i}" for i in range(len(fields))])
    carried = [f"_c{i}" for i in places]
    found = F.array().cast("array<struct<label:string,start:int,end:int,share:double,base:boolean>>")
    rows = plain.select(*carried, words_of(F.col(f"_c{text_at}")).alias("_words"))
    if templates:
        weights = word_weights(docs, {w for words in cut for w, _ in words}, text_col)
        rows = rows.withColumn("_at", _alignments(F.col("_words"), rare_postings(templates, weights, share)))
        found = _verified(F.col("_words"), F.col("_at"), templates, cut, weights, share)
    out = rows.select(*carried, F.size("_words").cast("long").alias("n_words"), found.alias("licenses"))
    return out.toDF(*[fields[i] for i in places], *RESULTS)


def _verified(words: Column, at: Column, templates, cut, weights, share: int) -> Column:
    shape = "array<struct<label:string,base:boolean,total:long,n:int,words:array<struct<w:string,weight:long,must:boolean>>>>"
    known = _constant(
        [
            {
                "label": t.label,
                "base": t.base,
                "total": sum(weights[w] for w, _ in c),
                "n": len(c),
                "words": [{"w": w, "weight": weights[w], "must": must} for w, must in c],
            }
            for t, c in zip(templates, cut, strict=True)
        ],
        shape,
    )

    def agree(a: Column) -> Column:
        """Weight of the words in their places, or -1 where a mandatory one is not."""
        of_word = F.transform(
            F.get(known, a["t"])["words"],
            lambda x, i: F.when(F.get(words, a["start"] + i) == x["w"], x["weight"]).when(x["must"], F.lit(None).cast("long")).otherwise(0),
        )
        return F.coalesce(F.aggregate(of_word, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(-1).cast("long"))

    weighed = F.transform(at, lambda a: F.struct(a["start"].alias("start"), F.get(known, a["t"]).alias("k"), agree(a).alias("weight")))
    good = F.filter(weighed, lambda x: x["weight"] * 100 >= x["k"]["total"] * share)
    shown = F.transform(
        good,
        lambda x: F.struct(
            x["start"].alias("start"),
            (x["start"] + x["k"]["n"]).alias("end"),
            x["k"]["label"].alias("label"),
            (x["weight"].cast("double") / x["k"]["total"]).alias("share"),
            x["k"]["base"].alias("base"),
        ),
    )
    ordered = F.array_sort(shown)
    return F.transform(ordered, lambda x: F.struct(x["label"].alias("label"), x["start"], x["end"], x["share"], x["base"]))
