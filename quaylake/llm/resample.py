"""Importance resampling of documents towards a target distribution.

1. A text is read as UTF-8 bytes: A-Z go to lower case and every run of
   separators collapses to a single space. Words are what is left between the
   spaces (letters, digits and all non-ASCII characters).
2. One overlapped scan per run length emits the spans of all runs of that many
   words: ``regex`` ``finditer`` with ``overlapped=True``, held to word
   boundaries by lookarounds. A feature is the text of a span; its bucket is the
   CRC-32 of its bytes modulo the number of buckets.
3. The buckets of a document are written once (two bytes a feature up to 65536
   buckets). Bucket totals come from that table, so texts are scanned once.
4. The gain of a bucket is ``floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))`` with s of
   S corpus features, t of T target features and B buckets; a document's weight
   is the floored mean of its gains.
5. ``score = weight + floor(Gumbel noise)``, the noise drawn from the SHA-256 of
   ``seed:id``, so that the highest scores are a sample without replacement in
   proportion to the importance. Documents with enough words are sorted once by
   range partitions; ranks are places in a partition plus the rows before it.

The driver holds one number per bucket and one per sorted partition, whatever
the size of the corpus.

Defined cases: a NULL or empty text has no words, weight 0 and no rank; a NULL id
is the empty text in ``seed:id`` and comes before all others among equal scores;
rows of one id count each, in the order of their text's hash; an empty target or
corpus leaves all its counts 0; very long texts are scanned as a stream of
spans. Columns are carried by place, so clashing names do no harm; columns that
have the names of results are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.llm.common import only, position, scratch_path, ship, tidy

BUCKETS = 10_000
MIN_WORDS = 20
RESULTS = ("n_words", "n_features", "weight", "score", "rank")

#: bytes between words; letters are lower case by then
_SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: place of a row inside its partition in ``monotonically_increasing_id``
_PLACE_BITS = 33
_COMPILED: dict = {}


def _compiled(pattern: bytes):
    import regex

    if pattern not in _COMPILED:
        _COMPILED[pattern] = regex.compile(pattern)
    return _COMPILED[pattern]


def collapsed(text: bytes | None) -> bytes:
    """Words of a text in lower case, with single spaces between them."""
    return _compiled(_SEPARATORS).sub(b" ", (text or b"").lower()).strip(b" ")


def spans(words: bytes, length: int) -> Iterator[tuple[int, int]]:
    """Spans of all runs of ``length`` words of a collapsed text, overlapping ones too."""
    run = _compiled(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (length - 1))
    return (m.span() for m in run.finditer(words, overlapped=True))


def bucket_type(buckets: int) -> np.dtype:
    return np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")


def feature_buckets(words: bytes, runs: tuple[int, int], buckets: int) -> np.ndarray:
    """Buckets of the features of a collapsed text, run length by run length."""
    crc = zlib.crc32
    parts = [
        np.fromiter((crc(words[a:b]) % buckets for a, b in spans(words, n)), bucket_type(buckets)) for n in range(runs[0], runs[1] + 1)
    ]
    return np.concatenate(parts)


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its corpus and target counts."""
    b, all_s, all_t = len(s), int(s.sum()), int(t.sum())
    ratio = ((y + 1.0) * (all_s + float(b)) / ((x + 1.0) * (all_t + float(b))) for x, y in zip(s.tolist(), t.tolist(), strict=True))
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratio), np.int64, b)


def noise(h: int) -> int:
    """Floored Gumbel noise of a 32-bit hash, in thousandths."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _totals(tables: Iterator[np.ndarray], buckets: int):
    """One batch of (bucket, features) for a task's arrays of buckets."""
    import pyarrow as pa

    total = np.zeros(buckets, np.int64)
    for found in tables:
        total += np.bincount(found, minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])


def _counts(partial: DataFrame, buckets: int) -> np.ndarray:
    """Features of each bucket from partial counts; at most ``buckets`` rows are collected."""
    out = np.zeros(buckets, np.int64)
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def _count_target(target: DataFrame, text_col: str, runs: tuple[int, int], buckets: int) -> np.ndarray:
    def run(batches: Iterator) -> Iterator:
        texts = (t for batch in batches for t in batch.column(0).to_pylist())
        yield from _totals((feature_buckets(collapsed(t), runs, buckets) for t in texts), buckets)

    texts = only(target, text=text_col).select(F.col("text").cast("binary"))
    return _counts(texts.mapInArrow(tidy(run), "bucket int, n long"), buckets)


def _scanned(docs: DataFrame, id_col: str, text_col: str, places: list[int], runs: tuple[int, int], buckets: int, seed: str) -> DataFrame:
    """The written scan: ``_row``, ``_id``, ``_tie``, ``_h``, the columns at ``places``
    as ``_k0`` ..., ``n_words`` and ``_buckets`` (binary)."""
    import pyarrow as pa

    fields = docs.schema.fields
    id_at, text_at = position(docs, id_col), position(docs, text_col)
    plain = docs.toDF(*[f"_c{i}" for i in range(len(fields))])
    id_text = F.coalesce(F.col(f"_c{id_at}").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256)
    wide = plain.select(
        F.col(f"_c{text_at}").cast("binary").alias("_text"),
        F.col(f"_c{id_at}").alias("_id"),
        F.xxhash64(f"_c{text_at}").alias("_tie"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("_h"),
        *[F.col(f"_c{i}").alias(f"_k{n}") for n, i in enumerate(places)],
    )
    carried = wide.schema.fields[1:]
    schema = T.StructType(carried + [T.StructField("n_words", T.LongType()), T.StructField("_buckets", T.BinaryType())])

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            n_words, found = [], []
            for text in batch.column(0).to_pylist():
                words = collapsed(text)
                n_words.append(words.count(b" ") + 1 if words else 0)
                found.append(feature_buckets(words, runs, buckets).tobytes())
            cols = batch.columns[1:] + [pa.array(n_words, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    path = scratch_path(docs.sparkSession, "resample-scan")
    scanned = wide.mapInArrow(tidy(run), schema)
    scanned.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _weighed(scanned: DataFrame, target_counts: np.ndarray) -> DataFrame:
    """``_row``, ``_id``, ``_tie``, ``n_words``, ``n_features``, ``weight``, ``score``, written."""
    import pyarrow as pa

    buckets = len(target_counts)
    kind = bucket_type(buckets)

    def count(batches: Iterator) -> Iterator:
        found = (np.frombuffer(b, kind) for batch in batches for b in batch.column(0).to_pylist())
        yield from _totals(found, buckets)

    corpus_counts = _counts(scanned.select("_buckets").mapInArrow(tidy(count), "bucket int, n long"), buckets)
    of_bucket = gains(corpus_counts, target_counts)

    def weigh(batches: Iterator) -> Iterator:
        for batch in batches:
            sizes, weights, scores = [], [], []
            for h, b in zip(batch.column("_h").to_pylist(), batch.column("_buckets").to_pylist(), strict=True):
                n = len(b) // kind.itemsize
                weight = int(of_bucket[np.frombuffer(b, kind)].sum()) // n if n else 0
                sizes.append(n)
                weights.append(weight)
                scores.append(weight + noise(h))
            cols = [batch.column(c) for c in ("_row", "_id", "_tie", "n_words")] + [pa.array(x, pa.int64()) for x in (sizes, weights, scores)]
            yield pa.RecordBatch.from_arrays(cols, ["_row", "_id", "_tie", "n_words", "n_features", "weight", "score"])

    narrow = scanned.select("_row", "_id", "_tie", "n_words", "_h", "_buckets")
    schema = T.StructType(
        [narrow.schema[c] for c in ("_row", "_id", "_tie", "n_words")]
        + [T.StructField(c, T.LongType()) for c in ("n_features", "weight", "score")]
    )
    path = scratch_path(scanned.sparkSession, "resample-scores")
    narrow.mapInArrow(tidy(weigh), schema).write.parquet(path)
    return scanned.sparkSession.read.parquet(path)


def _with_rank(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the drawn rows, else NULL."""
    spark = scored.sparkSession
    enough = scored.filter(F.col("n_words") >= min_words)
    # a total order, so that a task run again puts every row where it was
    ordered = enough.orderBy(F.desc("score"), F.asc_nulls_first("_id"), "_tie", "_row")
    path = scratch_path(spark, "resample-order")
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", _PLACE_BITS))
    # one row for each range partition of the sort
    per_part = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_total")
    )
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.col("_before") + 1
    drawn = F.when(place <= F.expr(f"{percent} * _total div 100"), place)
    ranked = placed.join(F.broadcast(offsets), "_part").select(*scored.columns, drawn.alias("rank"))
    rest = scored.filter(F.coalesce(F.col("n_words") < min_words, F.lit(True)))
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def _ranked(docs, target, id_col, text_col, target_text_col, places, runs, buckets, seed, percent, min_words):
    if not 1 <= runs[0] <= runs[1] or buckets < 1 or not 0 <= percent <= 100:
        raise ValueError("runs, buckets or percent out of range")
    ship(docs.sparkSession)
    scanned = _scanned(docs, id_col, text_col, places, runs, buckets, seed)
    scored = _weighed(scanned, _count_target(target, target_text_col, runs, buckets))
    return scanned, _with_rank(scored, percent, min_words)


def importance(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    runs: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
    seed: str = "2024",
    percent: int = 10,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank`` (NULL if not drawn). Features are all runs of
    ``runs[0]`` to ``runs[1]`` words; ``percent`` of the documents with
    ``min_words`` words or more are drawn, rounded down."""
    _, ranked = _ranked(docs, target, id_col, text_col, target_text_col, [], runs, buckets, seed, percent, min_words)
    return ranked.select(F.col("_id").alias(id_col), *RESULTS)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    runs: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
    seed: str = "2024",
    percent: int = 10,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns and the results of
    ``importance``. Whole rows are stored with the scan; only drawn ones travel."""
    places = [i for i, c in enumerate(docs.columns) if c not in RESULTS]
    scanned, ranked = _ranked(docs, target, id_col, text_col, target_text_col, places, runs, buckets, seed, percent, min_words)
    drawn = ranked.filter("rank IS NOT NULL").select("_row", *RESULTS)
    rows = scanned.select("_row", *[f"_k{n}" for n in range(len(places))]).join(drawn, "_row")
    return rows.select(*[F.col(f"_k{n}").alias(docs.columns[i]) for n, i in enumerate(places)], *RESULTS)
