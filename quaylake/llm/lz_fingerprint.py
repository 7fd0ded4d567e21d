"""Document fingerprints from Lempel-Ziv phrases.

A document is parsed into dictionary phrases (LZ78): each phrase is the
shortest run of code points that is not a phrase yet. Two texts that compress
well together share phrases, so the overlap of phrase sets measures the
likeness that a compressor would see. Phrases are hashed (a polynomial over
the code points, by prefix sums), the set is reduced to its ``k`` smallest
hashes, and two signatures are compared on the ``k`` smallest of their union,
which estimates the Jaccard similarity and is exact for sets of at most ``k``
phrases.

Fingerprint: the ``k`` smallest 32-bit hashes in rising order, 8 hex digits
each. Equal texts have equal fingerprints.

Defined cases: a NULL text counts as empty; an empty text has the empty
fingerprint, and two empty fingerprints have likeness 1, one empty and one
not 0. Documents of equal id follow one another by the hash of their text;
NULL ids come first. Repeated rows are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import only, ship, shuffle_width, tidy

SIGNATURE = 64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the polynomial base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 14)
            self.up = np.ones(size, np.uint64)
            self.down = np.ones(size, np.uint64)
            np.cumprod(np.full(size - 1, _BASE, np.uint64), out=self.up[1:])
            np.cumprod(np.full(size - 1, _BASE_INVERSE, np.uint64), out=self.down[1:])
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Phrases:
    """The LZ78 parse of a text, which can go on with more text."""

    __slots__ = ("seen", "ends", "start", "length")

    def __init__(self) -> None:
        self.seen: set[str] = set()
        self.ends: list[int] = []
        self.start = 0  # of the phrase that is open
        self.length = 2  # of the last phrase: where the next search begins

    def copy(self) -> Phrases:
        other = Phrases()
        other.seen, other.ends = set(self.seen), list(self.ends)
        other.start, other.length = self.start, self.length
        return other

    def parse(self, text: str, upto: int) -> Phrases:
        """Parse ``text[:upto]`` from where the parse stands. Prefixes of a
        phrase are phrases, so the search for the shortest new run may begin at
        any length and go up or down from there."""
        seen, add = self.seen, self.seen.add
        done = self.ends.append
        s, g = self.start, self.length
        while s < upto:
            e = s + g
            if e > upto:
                e = upto
            if text[s:e] in seen:
                e += 1
                while e <= upto and text[s:e] in seen:
                    e += 1
                if e > upto:
                    break  # the open phrase is not complete yet
            else:
                while e > s + 1 and text[s : e - 1] not in seen:
                    e -= 1
            add(text[s:e])
            done(e)
            g = e - s
            s = e
        self.start, self.length = s, g
        return self

    def signature(self, text: str, k: int) -> np.ndarray:
        """The k smallest phrase hashes (an open last phrase is a phrase already)."""
        n = self.ends[-1] if self.ends else 0
        if not n:
            return np.empty(0, np.uint32)
        up, down = _POWERS.get(n + 1)
        codes = np.frombuffer(text[:n].encode("utf-32-le"), np.uint32).astype(np.uint64)
        codes += np.uint64(1)
        codes *= up[:n]
        sums = np.cumsum(codes)
        ends = np.array(self.ends)
        at_end = sums[ends - 1]
        h = at_end.copy()
        h[1:] -= at_end[:-1]
        h[1:] *= down[ends[:-1]]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        small = (h >> np.uint64(11)).astype(np.uint32)
        if len(small) > 4 * k:
            small = np.partition(small, 2 * k)[: 2 * k + 1]
        return np.unique(small)[:k]


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, k: int = SIGNATURE) -> float:
    """Estimated Jaccard similarity of two phrase sets from their signatures."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.sort(np.concatenate((a, b)))
    twice = both[1:] == both[:-1]
    lowest = np.concatenate(([True], ~twice))
    union = min(k, int(lowest.sum()))
    last = both[lowest][union - 1]
    return float(int((twice & (both[1:] <= last)).sum()) / union)


def fingerprint(text: str | None, k: int = SIGNATURE) -> str:
    """The fingerprint of one text."""
    text = text or ""
    return as_text(Phrases().parse(text, len(text)).signature(text, k))


# --------------------------------------------------------------- the edited texts
def _bounds(docs: DataFrame, id_col: str, buckets: int) -> tuple[list[int], object]:
    """Ids at which the buckets begin (ids that occur, at most ``buckets`` of
    them) and the first id of all (None if an id is NULL)."""
    probes = [i / buckets for i in range(1, buckets)]
    found = docs.agg(
        F.percentile_approx(id_col, probes, F.lit(20 * buckets)).alias("at"),
        F.min(id_col).alias("first"),
        F.count(F.when(F.col(id_col).isNull(), 1)).alias("nulls"),
    ).first()
    first = None if found["nulls"] else found["first"]
    starts = sorted(set(found["at"] or []))
    return [s for s in starts if first is None or s != found["first"]], first


def _bucket(id_col: Column, starts: list[int]) -> Column:
    """Number of bounds that are not above the id: a search in two steps."""
    if not starts:
        return F.lit(0)
    step = max(1, int(len(starts) ** 0.5))
    bounds = F.lit(starts)
    coarse = F.lit(starts[step - 1 :: step])
    blocks = F.size(F.filter(coarse, lambda b: b <= id_col))
    rest = F.size(F.filter(F.slice(bounds, blocks * step + 1, F.lit(step)), lambda b: b <= id_col))
    return F.when(id_col.isNull(), 0).otherwise(blocks * step + rest)


def fingerprint_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SIGNATURE, buckets: int | None = None
) -> DataFrame:
    """Fingerprint every document and its edited text: the last half of its code
    points replaced by the first as many of the next document by id (after the
    last: the first document).

    One shuffle of the texts: documents are dealt to ranges of ids, and the
    first document of a range is sent to the range before it as well. Rows
    stream through a task in id order; two documents are held at a time.
    """
    import hashlib

    import pyarrow as pa

    ship(docs.sparkSession)
    if buckets is None:
        buckets = 4 * shuffle_width(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    starts, first = _bounds(rows, "doc_id", buckets)
    doc_id = F.col("doc_id")
    bucket = _bucket(doc_id, starts)
    place = lambda b, kind: F.struct(b.cast("int").alias("bucket"), F.lit(kind).alias("kind"))
    places = F.array(place(F.col("_bucket"), 0))
    if starts:
        ahead = F.when(doc_id.isin(starts), F.array(place(F.col("_bucket") - 1, 1)))
        places = F.concat(places, F.coalesce(ahead, F.filter(places, lambda x: F.lit(False))))
    wrap = F.when(doc_id.eqNullSafe(F.lit(first).cast("long")), F.array(place(F.lit(len(starts)), 2)))
    places = F.concat(places, F.coalesce(wrap, F.filter(places, lambda x: F.lit(False))))
    dealt = (
        rows.withColumn("_bucket", bucket)
        .withColumn("_tie", F.xxhash64("text"))
        .withColumn("_place", F.explode(places))
        .select("_place.bucket", "_place.kind", "doc_id", "_tie", "text")
    )
    dealt = dealt.repartition(shuffle_width(docs.sparkSession), "bucket").sortWithinPartitions(
        "bucket", "kind", F.col("doc_id").asc_nulls_first(), "_tie"
    )
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in names]
        held = None  # (bucket, doc_id, text, half-parsed phrases, signature)

        def close(text_after: str, signature_after: np.ndarray) -> None:
            _, doc, text, half, signature = held
            keep = len(text) - len(text) // 2
            edited = text[:keep] + text_after[: len(text) // 2]
            changed = half.parse(edited, len(edited)).signature(edited, k)
            row = (
                doc,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                as_text(signature),
                as_text(changed),
                likeness(signature, changed, k),
                likeness(signature, signature_after, k),
            )
            for col, v in zip(out, row, strict=True):
                col.append(v)

        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bucket", "kind", "doc_id", "text")]
            for b, kind, doc, text in zip(*cols, strict=True):
                half = Phrases().parse(text, len(text) - len(text) // 2)
                full = half.copy().parse(text, len(text)) if kind == 0 else half.parse(text, len(text))
                signature = full.signature(text, k)
                if held is not None and held[0] == b:
                    close(text, signature)
                held = (b, doc, text, half, signature) if kind == 0 else None
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
                out = [[] for _ in names]

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(tidy(run), schema)
