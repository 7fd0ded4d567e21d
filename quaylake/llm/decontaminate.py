"""Benchmark decontamination: item-sized windows, SimHash, Hamming blocks.

1. Documents and items are cut into words (runs of letters and digits, in lower
   case) and shingles of five words. A window is a stretch of a document with
   as many words as an item; it is looked at where a shingle of the document
   equals one of an item of that size, placed so that the two coincide. A
   window that is similar to an item shares a shingle with it.
2. Windows and items get a 64-bit SimHash of their shingles. A shingle weighs as
   many units as it has characters in the similarity, and the square root of
   that in the SimHash: the cosine of two such vectors is the shared weight over
   the geometric mean of the two weights, which is the similarity at least,
   however unevenly the shingles weigh.
3. The fingerprints are cut into ``RADIUS + 1`` blocks. Two fingerprints within
   the radius agree in a block at least, so equal blocks (of items of the
   window's size) give all candidates; the exact distance is checked at once.
4. Candidates are verified: the weight of the shared shingles over the larger
   of the two weights must be 0.8 or more.

At similarity 0.8 the expected distance is 13.1 bits at most with a deviation of
3.2; the radius of 26 leaves two in a hundred thousand of the windows that lie
exactly on the threshold, and none that are closer in practice. Blocks that
guarantee such a radius have two or three bits and tell little apart; windows
are few because they are placed on shared shingles, and the exact distance
leaves one unrelated pair in twelve.

Only DataFrame expressions are used. The text is read where it is; the shingles
of the benchmark are broadcast to it up to a measured size and joined by a
shuffle beyond it.

Defined cases: a NULL text counts as empty; an item of fewer than five words is
one shingle; an item without words matches nothing; repeated items of one id
count once each text; rows of one id are one document in the result; a NULL
document id is an id like any other. If several of the windows looked at match
an item, the most similar one is told, the first among equals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import fewer, only, stored
from quaylake.plans.broadcast import join_small

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 26
BROADCAST_BYTES = 32 << 20
_SEPARATOR = r"[^\p{L}\p{N}]+"


def _blocks() -> list[tuple[int, int]]:
    """(offset, width) of the RADIUS + 1 blocks of 64 bits."""
    n = RADIUS + 1
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR), "")


def _shingle_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of the runs of ``k`` words, in order."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def _weighted_shingles(words: Column, k: Column) -> Column:
    """Distinct (hash, weight) of the runs of ``k`` words; the weight is the number
    of characters."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    run = lambda i: F.slice(words, i + 1, k)
    one = F.transform(at, lambda i: F.struct(F.xxhash64(run(i)).alias("h"), F.length(F.array_join(run(i), "")).alias("w")))
    return F.array_distinct(one)


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct items: id, words, their number ``n`` and shingle size ``k``."""
    items = only(benchmark, item_id=id_col, text=text_col)
    items = items.select("item_id", words_of(F.col("text")).alias("item_words")).distinct()
    n = F.size("item_words")
    return items.select("item_id", "item_words", n.alias("n"), F.least(n, F.lit(SHINGLE)).alias("k")).filter("n > 0")


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc, n, k, start): windows of ``n`` words placed over an item."""
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most SHINGLE values
    found = None
    for k in sizes:
        of_items = items.filter(F.col("k") == k).select("n", F.posexplode(_shingle_hashes(F.col("item_words"), k)).alias("at", "h"))
        shingles = of_items.distinct()
        of_docs = docs.select("doc", "words").select("doc", F.size("words").alias("size"), F.posexplode(_shingle_hashes(F.col("words"), k)).alias("pos", "h"))
        met = join_small(of_docs, fewer(shingles), "h", max_bytes=BROADCAST_BYTES)
        start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("at"), F.col("size") - F.col("n")))
        placed = met.select("doc", "n", F.lit(k).alias("k"), start.alias("start")).distinct()
        found = placed if found is None else found.unionByName(placed)
    return found


def simhash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (keys and ``shingles``) with their 64-bit ``fingerprint``."""
    root = F.round(F.sqrt(F.col("s.w").cast("double")) * 1024).cast("long")
    one = rows.select(*keys, F.explode("shingles").alias("s")).select(*keys, F.col("s.h").alias("h"), root.alias("w"))
    bit = lambda b: F.shiftright("h", b).bitwiseAND(F.lit(1)) == 1
    sums = [F.sum(F.when(bit(b), F.col("w")).otherwise(-F.col("w"))).alias(f"b{b}") for b in range(64)]
    voted = one.groupBy(*keys).agg(*sums)
    fingerprint = F.lit(0).cast("long")
    for b in range(64):
        fingerprint = fingerprint.bitwiseOR(F.when(F.col(f"b{b}") >= 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(0))
    return voted.select(*keys, fingerprint.alias("fingerprint"))


def _in_blocks(rows: DataFrame) -> DataFrame:
    parts = [
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for i, (at, width) in enumerate(_blocks())
    ]
    return rows.withColumn("_part", F.explode(F.array(*parts))).select("*", "_part.block", "_part.value").drop("_part")


def _similarity(a: Column, b: Column) -> Column:
    """Weight of the shared shingles over the larger weight."""
    weight = lambda s: F.aggregate(s, F.lit(0), lambda t, x: t + x["w"])
    return weight(F.array_intersect(a, b)) / F.greatest(weight(a), weight(b))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and item that it holds: ``doc_id``, ``item_id``,
    ``start_word``, ``n_words``, ``distance`` (Hamming) and ``similarity``."""
    items = stored(_items(benchmark, item_col, item_text_col), "benchmark-items")
    rows = only(docs, id=id_col, text=text_col)
    keyed = rows.select(F.struct("id", F.xxhash64("text").alias("hash")).alias("doc"), "text")
    if items.isEmpty():
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {rows.schema['id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, "
            "start_word int, n_words int, distance int, similarity double"
        )
    windows = _windows(keyed.select("doc", words_of(F.col("text")).alias("words")), items)
    listed = windows.groupBy("doc").agg(F.collect_list(F.struct("n", "k", "start")).alias("windows"))
    held = join_small(keyed, fewer(listed), "doc", max_bytes=BROADCAST_BYTES)
    held = held.select("doc", words_of(F.col("text")).alias("words"), "windows")
    cut = held.select("doc", "words", F.explode("windows").alias("w"))
    cut = cut.select("doc", F.col("w.n").alias("n"), F.col("w.k").alias("k"), F.col("w.start").alias("start"), F.slice("words", F.col("w.start") + 1, F.col("w.n")).alias("words"))
    # a document may be shorter than the item: its window is what there is
    cut = cut.filter(F.size("words") >= F.col("k")).withColumn("shingles", _weighted_shingles(F.col("words"), F.col("k")))
    cut = stored(cut.select("doc", "n", "start", "shingles").dropDuplicates(["doc", "n", "start"]), "benchmark-windows")
    of_items = items.select("item_id", "n", _weighted_shingles(F.col("item_words"), F.col("k")).alias("item_shingles"))
    of_items = of_items.withColumn("item", F.xxhash64("item_id", F.to_json("item_shingles")))
    of_items = stored(of_items, "benchmark-shingles")

    marked = _in_blocks(simhash(cut, ["doc", "n", "start"]))
    marks = simhash(of_items.select("n", "item", F.col("item_shingles").alias("shingles")), ["n", "item"])
    marks = _in_blocks(marks.withColumnRenamed("fingerprint", "item_fingerprint").withColumn("fingerprint", F.col("item_fingerprint"))).drop("fingerprint")
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    near = join_small(marked, fewer(marks), ["n", "block", "value"], max_bytes=BROADCAST_BYTES).filter(distance <= RADIUS)
    near = near.select("doc", "n", "start", "item", distance.alias("distance")).distinct()
    checked = near.join(cut, ["doc", "n", "start"])
    checked = join_small(checked, fewer(of_items.select("item", "item_id", "item_shingles")), "item", max_bytes=BROADCAST_BYTES)
    checked = checked.withColumn("similarity", _similarity(F.col("shingles"), F.col("item_shingles")))
    best = F.min(F.struct((-F.col("similarity")).alias("_worse"), "start", "n", "distance", "similarity"))
    return (
        checked.filter(F.col("similarity") >= similarity)
        .groupBy(F.col("doc.id").alias("doc_id"), "item_id")
        .agg(best.alias("b"))
        .select(
            "doc_id",
            "item_id",
            F.col("b.start").alias("start_word"),
            F.col("b.n").alias("n_words"),
            F.col("b.distance").cast("int").alias("distance"),
            F.col("b.similarity").alias("similarity"),
        )
    )
