"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text, a toxic and an
ordinary one. A text is cut into windows, one word each (written twice
between blanks, so that short words compress measurably; words of over 64
bytes give several windows). Each window is compressed against both
dictionaries. It counts as a toxic window when its length with the toxic
dictionary is at the level that this dictionary reaches on its own windows
(the first calibrated threshold) and the ordinary dictionary needs at least
two bytes more. The number of toxic windows and their share give the score by
a logistic curve fitted to the labelled documents (the second threshold).

Content of the dictionaries: the toxic one holds the windows whose document
frequency in toxic text exceeds that in ordinary text beyond chance (a
likelihood ratio over the bound for as many tests as there are words); the
ordinary one the most frequent windows of ordinary text. ``train_dictionary``
of the library was tried on the same windows and reached less (see README).

Training reads a bounded sample of labelled rows (``MAX_TOXIC`` and
``MAX_ORDINARY`` documents, chosen by the hash of their id); scoring covers
whole texts of all documents. Labels, language, source and id are no inputs
of a score.

Defined cases: a NULL or empty text has no windows and gets the score of a
document without toxic windows; labels that are NULL are ignored, of repeated
labels the highest counts; without labels of both classes every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaylake.llm.common import only, position, ship, stored, tidy, worker_state

#: labelled documents per class used for training, at most
MAX_TOXIC = 4000
MAX_ORDINARY = 12000
#: windows in a dictionary, at most
MAX_TOXIC_WINDOWS = 2000
ORDINARY_WINDOWS = 600
WINDOW_BYTES = 64
#: bytes that the ordinary dictionary must need beyond the toxic one
GAIN = 2
MEMO = 250_000

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """The windows' words: runs of letters, in lower case, of 64 bytes at most."""
    found = _WORD.findall((text or "").lower().encode())
    if any(len(w) > WINDOW_BYTES for w in found):
        found = [w[i : i + WINDOW_BYTES] for w in found for i in range(0, len(w), WINDOW_BYTES)]
    return found


def window(word: bytes) -> bytes:
    return b" " + word + b" " + word + b" "


@dataclass(frozen=True)
class Model:
    """Dictionaries, the length threshold and the logistic curve."""

    toxic: bytes
    ordinary: bytes
    floor: int
    weights: tuple[float, float, float]

    def score(self, hits: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = _features(hits, n) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(hits: np.ndarray, n: np.ndarray) -> np.ndarray:
    share = np.minimum(1.0, 20 * hits / np.maximum(n, 1))
    return np.stack([np.ones(len(hits)), np.log1p(hits), share], axis=1)


class WindowCounter:
    """Counts toxic windows with a pair of dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes, floor: int):
        self.toxic, self.ordinary = self._compressor(toxic), self._compressor(ordinary)
        self.floor, self.memo = floor, {}

    @staticmethod
    def _compressor(content: bytes):
        import zstandard as z

        params = z.ZstdCompressionParameters(
            write_content_size=False,
            write_checksum=False,
            write_dict_id=False,
            strategy=z.STRATEGY_BTOPT,
            min_match=3,
            search_log=5,
            hash_log=12,
            chain_log=13,
            window_log=17,
            target_length=64,
        )
        raw = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(compression_params=params)
        return z.ZstdCompressor(dict_data=raw, compression_params=params)

    def is_toxic(self, word: bytes) -> bool:
        x = window(word)
        a = len(self.toxic.compress(x))
        return a <= self.floor and len(self.ordinary.compress(x)) >= a + GAIN

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Toxic windows and all windows of each text."""
        memo = self.memo
        hits, n = [], []
        for t in texts:
            if len(memo) > MEMO:
                memo.clear()
            found = words(t)
            for w in set(found).difference(memo):
                memo[w] = self.is_toxic(w)
            hits.append(sum(map(memo.__getitem__, found)))
            n.append(len(found))
        return np.array(hits, dtype=float), np.array(n, dtype=float)


def _counter(toxic: bytes, ordinary: bytes, floor: int) -> WindowCounter:
    key = (toxic, ordinary, floor)
    return worker_state(key, lambda: WindowCounter(*key))


# ----------------------------------------------------------------------- training
def _sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_ordinary: int) -> tuple[DataFrame, dict]:
    """Texts of the sampled labelled documents, and the documents per class."""
    one = only(labels, "doc_id", "toxic").filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    one = one.filter("doc_id IS NOT NULL")
    sizes = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    pick = lambda y, n: one.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = pick(1, max_toxic).unionByName(pick(0, max_ordinary))  # bounded by the two parameters
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return only(docs, "doc_id", "text").select("doc_id", text).join(F.broadcast(chosen), "doc_id").select("toxic", "text"), sizes


def _frequencies(batches: Iterator):
    """Documents of each class that hold a word, added up per batch."""
    import pyarrow as pa

    for batch in batches:
        found = (Counter(), Counter())
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found[y].update(set(words(t)))
        for y in (0, 1):
            if found[y]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found[y]), pa.binary()), pa.array([y] * len(found[y]), pa.int32()), pa.array(list(found[y].values()), pa.int64())],
                    ["word", "toxic", "docs"],
                )


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    some = F.when(k > 0, k * F.log(p)).otherwise(0.0)
    return some + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0)


def train(
    docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY
) -> Model | None:
    """Fit dictionaries and thresholds on a bounded sample of the labelled rows."""
    import pyarrow as pa

    ship(docs.sparkSession)
    sample, sizes = _sample(docs, labels, max_toxic, max_ordinary)
    sample = stored(sample, "toxicity-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    counts = (
        sample.mapInArrow(tidy(_frequencies), "word binary, toxic int, docs long")
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("k1"),
            F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("k0"),
        )
    )
    counts = stored(counts, "toxicity-words")
    bound = 2 * math.log(max(counts.count(), 2))
    n1, n0 = F.lit(float(n[1])), F.lit(float(n[0]))
    k1, k0 = F.col("k1"), F.col("k0")
    all_p, p1, p0 = (k1 + k0) / (n1 + n0), k1 / n1, k0 / n0
    ratio = 2 * (_log_likelihood(k1, n1, p1) + _log_likelihood(k0, n0, p0))
    ratio = ratio - 2 * (_log_likelihood(k1, n1, all_p) + _log_likelihood(k0, n0, all_p))
    scored = counts.withColumn("g", ratio).withColumn("more", p1 > p0)
    marked = scored.filter(F.col("more") & (F.col("g") >= bound)).orderBy(F.desc("g"), "word").limit(MAX_TOXIC_WINDOWS)
    marked_words = [bytes(r["word"]) for r in marked.select("word").collect()]
    common = counts.filter("k0 > 0").orderBy(F.desc("k0"), "word").limit(ORDINARY_WINDOWS + len(marked_words))
    known = set(marked_words)
    common_words = [w for w in (bytes(r["word"]) for r in common.select("word").collect()) if w not in known]
    if not marked_words or not common_words:
        return None
    # the strongest windows last, where a match costs least
    toxic = b"".join(window(w) for w in reversed(marked_words))
    ordinary = b"".join(window(w) for w in reversed(common_words[:ORDINARY_WINDOWS]))
    toxic_only = WindowCounter(toxic, ordinary, 0)
    lengths = sorted(len(toxic_only.toxic.compress(window(w))) for w in marked_words)
    floor = lengths[int(0.95 * (len(lengths) - 1))]

    def measure(batches: Iterator):
        for batch in batches:
            hits, total = _counter(toxic, ordinary, floor).count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hits), pa.array(total)], ["toxic", "hits", "n"])

    rows = sample.mapInArrow(tidy(measure), "toxic int, hits double, n double").toPandas()  # the bounded sample
    y = rows["toxic"].to_numpy(float)
    weight = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    x = _features(rows["hits"].to_numpy(), rows["n"].to_numpy())
    return Model(toxic, ordinary, floor, tuple(_logistic(x, y, weight)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> list[float]:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, grad)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


# ------------------------------------------------------------------------ scoring
def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``toxicity`` (0 to 1) and
    ``toxic_windows``; columns of these names are replaced."""
    import pyarrow as pa

    out = ("toxicity", "toxic_windows")
    fields = docs.schema.fields
    places = [i for i, f in enumerate(fields) if f.name not in out and (keep is None or f.name in keep)]
    kept = [fields[i] for i in places]
    text_at = position(docs, text_col)
    if model is None:
        plain = docs.toDF(*[f"_c{i}" for i in range(len(fields))])
        return plain.select(
            *[F.col(f"_c{i}").alias(fields[i].name) for i in places], F.lit(0.0).alias(out[0]), F.lit(0).cast("long").alias(out[1])
        )
    ship(docs.sparkSession)
    # columns go through the tasks by place, whatever their names are
    inner = [f"_c{i}" for i in range(len(kept))]
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(inner, kept, strict=True)])
    schema = T.StructType(schema.fields + [T.StructField(out[0], T.DoubleType()), T.StructField(out[1], T.LongType())])

    def run(batches: Iterator) -> Iterator:
        counter = _counter(model.toxic, model.ordinary, model.floor)
        for batch in batches:
            hits, n = counter.count(batch.column(text_at).to_pylist())
            cols = [batch.column(i) for i in places]
            cols += [pa.array(model.score(hits, n)), pa.array(hits.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, [*inner, *out])

    plain = docs.toDF(*[f"_c{i}" for i in range(len(fields))])
    return plain.mapInArrow(tidy(run), schema).toDF(*[f.name for f in kept], *out)
