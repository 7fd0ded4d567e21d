"""Near-duplicate documents by MinHash bands and odd sketches.

1. A task turns each text into its set of word shingles (64-bit hashes), 288
   MinHash samples in 48 bands of 6, and an odd sketch: the samples folded into
   512 parity bits. Equal sets are one class, with a number of its own.
2. Classes that share a band are candidates. Two sets of similarity 0.8 share
   none with probability 5e-7.
3. Within a band no pairs are enumerated: in rounds, a band offers one member as
   leader, each member is checked with the most alike leader of its bands, and
   bands whose members are in one component drop out. What is left are members that are unlike all leaders;
   these are compared with everything in their bands that is not in their
   component, so no link is lost: by pairs in bands of bounded size, in blocks
   that give nothing but links in larger ones.
4. A pair is kept for the exact check if the sizes allow the similarity and the
   population count of the XOR of the odd sketches does: the bound lies 5.5
   standard deviations above what similarity 0.8 gives.
5. The exact check compares the full sets. Links are joined to components by
   star steps; so are the classes of one id. The component of a document is the
   least id in it.

Defined cases: a NULL or empty text, or one without words, has the empty set
and is linked with nothing; a text of fewer words than a shingle has is one
shingle. Repeated rows are copies of one document. Rows of one id are one
document that has the texts of all of them: it is linked where one of these is,
and each row tells the size of its own set. A NULL id is linked with nothing
and has a NULL component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import only, ship, stored, tidy, worker_state
from quaylake.llm.components import components
from quaylake.plans.broadcast import join_small

BANDS, ROWS = 48, 6
SAMPLES = BANDS * ROWS
SKETCH_WORDS = 8  # of 64 parity bits
#: a pair is linked if 100 * intersection >= PERCENT * union
PERCENT = 80
#: population count of the XOR of two odd sketches, at most
MAX_DIFFERENT_BITS = 168
LEADER_ROUNDS = 4
#: buckets of more members are compared in blocks of about so many sets a side
CROWD = 256
BLOCK = 256
#: ids of candidate documents are broadcast up to this size, else joined by a shuffle
CANDIDATE_IDS_BYTES = 32 << 20
WORD_CACHE = 250_000

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xD6E8FEB86659FD93)
_S32 = np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _M2
    return h ^ (h >> _S32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z are lower-cased, words
    are what the ASCII blanks separate."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(worker_state("words", _WordHashes).__getitem__, found), np.uint64, len(found))
    k = min(words, len(h))
    n = len(h) - k + 1
    out = _mix(h[:n] + np.uint64(k))
    for j in range(1, k):
        out = _mix(out * _M1 + h[j : n + j])
    return np.unique(out)


def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20150219)
    a = rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, (1 << 64) - 1, SAMPLES, dtype=np.uint64)


_A, _B = _family()


def samples(shingles: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    best = np.full(SAMPLES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(best, (shingles[at : at + 1024, None] * _A + _B).min(0), out=best)
    return best


def bands(sample: np.ndarray) -> np.ndarray:
    rows = _mix(sample).reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _M1
    for j in range(ROWS):
        h = _mix(h * _M1 + rows[:, j])
    return h.view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Parity bits of the samples: bit p is set if an odd number of (place, value)
    pairs hash to p."""
    bits = SKETCH_WORDS * 64
    spot = _mix(sample * _M1 + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(bits)
    odd = np.bincount(spot.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_hash (NULL for the empty set), bands, s0..s7."""
    import pyarrow as pa
    import xxhash

    sketch = [f"s{i}" for i in range(SKETCH_WORDS)]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            n, keys, band_rows, sketches = [], [], [], []
            for t in batch.column(1).to_pylist():
                s = shingle_set(t, words)
                n.append(len(s))
                if not len(s):
                    keys.append(None)
                    band_rows.append(None)
                    sketches.append(np.zeros(SKETCH_WORDS, np.int64))
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                sample = samples(s)
                band_rows.append(bands(sample))
                sketches.append(odd_sketch(sample))
            table = np.array(sketches).reshape(-1, SKETCH_WORDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(band_rows, pa.list_(pa.int64()))]
                + [pa.array(np.ascontiguousarray(table[:, i])) for i in range(SKETCH_WORDS)],
                ["doc_id", "n_shingles", "set_hash", "bands", *sketch],
            )

    kinds = ", ".join(f"{s} long" for s in sketch)
    return docs.mapInArrow(tidy(run), f"doc_id long, n_shingles long, set_hash binary, bands array<long>, {kinds}")


def _different(left, right) -> Column:
    """Population count of the XOR of the odd sketches of two members."""
    out = F.lit(0)
    for i in range(SKETCH_WORDS):
        out = out + F.bit_count(left[f"s{i}"].bitwiseXOR(right[f"s{i}"]))
    return out


def _may_link(left, right) -> Column:
    """Sizes and odd sketches of two members leave similarity 0.8 possible."""
    n, m = left["n"], right["n"]
    return (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (_different(left, right) <= MAX_DIFFERENT_BITS)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    import pyarrow as pa

    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")), "b")
    both = both.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a")), "a")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate((p, q)))
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= PERCENT * (len(merged) - common))
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield rows.filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(tidy(run), "a long, b long")


def _linked_in_block(xs, ys):
    """Edges between components from two lists of sets of bounded length."""
    import pyarrow as pa

    column = lambda t, c: t.column(c).to_numpy()
    none = pa.table({"ca": pa.array([], pa.int64()), "cb": pa.array([], pa.int64())})
    if not xs.num_rows or not ys.num_rows:
        return none
    a, b = ([np.frombuffer(s.as_buffer(), np.uint64) for s in t.column("shingles")] for t in (xs, ys))
    common = _intersections(a, b)
    n, m = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    near = 100 * common >= PERCENT * (n[:, None] + m[None, :] - common)
    ca, cb, main = column(xs, "comp"), column(ys, "comp"), column(xs, "_main")
    near &= ca[:, None] != cb[None, :]
    near &= (cb[None, :] == main[:, None]) | (column(xs, "rep")[:, None] < column(ys, "rep")[None, :])
    i, j = np.nonzero(near)
    if not len(i):
        return none
    edges = np.unique(np.stack([ca[i], cb[j]], axis=1), axis=0)
    return pa.table({"ca": pa.array(edges[:, 0]), "cb": pa.array(edges[:, 1])})


def _intersections(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by products of
    indicator matrices over slices of the shingles that both sides have."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    total = np.zeros((len(a), len(b)))
    for at in range(0, len(both), width):
        part = both[at : at + width]
        marks = []
        for sets in (a, b):
            mark = np.zeros((len(sets), len(part)), np.float32)
            for row, s in enumerate(sets):
                s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], side="right")]
                spot = np.searchsorted(part, s)
                mark[row, spot[part[spot] == s]] = 1
            marks.append(mark)
        total += marks[0] @ marks[1].T
    return total.astype(np.int64)


class _Classes:
    """Components of classes (numbered ``rep``) that share bands, found in rounds.

    ``classes`` has (rep, set_hash, doc_id), ``reps`` (rep, n, bands, s0..s7) of each,
    ``members`` has (rep, bucket, n, s0..s7) of the buckets with several members,
    ``labels`` (rep, comp) what is known so far, ``live`` the members with their
    component in the buckets that still hold several components.
    """

    sketch = tuple(f"s{i}" for i in range(SKETCH_WORDS))

    def __init__(self, classes: DataFrame, reps: DataFrame, docs: DataFrame, words: int):
        self.reps = reps
        dealt = reps.select("rep", F.posexplode("bands").alias("band", "bucket"))
        shared = dealt.groupBy("bucket").agg(F.min("rep").alias("_lo"), F.max("rep").alias("_hi")).filter("_lo != _hi")
        placed = stored(dealt.join(shared.select("bucket"), "bucket").distinct(), "minhash-buckets")
        self.n_members = placed.count()
        ids = stored(placed.select("rep").distinct(), "minhash-candidates", self.n_members)
        self.n_ids = ids.count()
        facts = reps.select("rep", "n", *self.sketch)
        facts = join_small(facts, ids, "rep", "left_semi", max_bytes=CANDIDATE_IDS_BYTES)
        self.members = stored(placed.join(facts, "rep"), "minhash-members", self.n_members)
        classes = join_small(classes, ids, "rep", "left_semi", max_bytes=CANDIDATE_IDS_BYTES)
        self.sets = self._full_sets(docs, stored(classes, "minhash-holders", self.n_ids), words)
        self.labels = ids.select("rep", F.col("rep").alias("comp"))
        self._find_live()

    @staticmethod
    def _full_sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
        """Shingle sets of the candidates only, each from a document of its class."""
        import pyarrow as pa
        import xxhash

        def full(batches: Iterator) -> Iterator:
            for batch in batches:
                found = [shingle_set(t, words).tobytes() for t in batch.column(1).to_pylist()]
                keys = [xxhash.xxh3_128_digest(s) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(keys, pa.binary()), pa.array(found, pa.binary())], ["doc_id", "set_hash", "shingles"]
                )

        holders = classes.select("doc_id").distinct()
        chosen = join_small(docs.select("doc_id", "text"), holders, "doc_id", "left_semi", max_bytes=CANDIDATE_IDS_BYTES)
        sets = chosen.mapInArrow(tidy(full), "doc_id long, set_hash binary, shingles binary")
        # another text of the document, and repeated rows, drop out
        sets = join_small(sets, classes, ["doc_id", "set_hash"], max_bytes=CANDIDATE_IDS_BYTES).select("rep", "shingles")
        return stored(sets.groupBy("rep").agg(F.any_value("shingles").alias("shingles")), "minhash-sets")

    def _find_live(self) -> None:
        now = self.members.join(self.labels, "rep")
        several = now.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).filter("_lo != _hi")
        self.live = stored(now.join(several.select("bucket"), "bucket"), "minhash-live", self.n_members)
        self.n_members = self.live.count()  # buckets only ever drop out

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """Edges between components (ca, cb) of the candidate pairs (a, b, ca, cb) that
        are linked on their full sets."""
        once = pairs.distinct()
        linked = _linked(once.select("a", "b"), self.sets)
        return linked.join(once, ["a", "b"]).select("ca", "cb")

    def _join_up(self, edges: DataFrame) -> None:
        merged = components(edges, "ca", "cb").select(F.col("vertex").alias("comp"), F.col("component").alias("_to"))
        moved = self.labels.join(merged, "comp", "left").select("rep", F.coalesce("_to", "comp").alias("comp"))
        self.labels = stored(moved, "minhash-labels", self.n_ids)

    def by_leaders(self, turn: int) -> None:
        """Check each member with the most alike leader, by odd sketches, among those
        of its buckets that are in another component. The first leader of a bucket
        is its least member, later ones are drawn by hash."""
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", "bucket", F.lit(turn))
        leader = self.live.groupBy("bucket").agg(F.min_by(F.struct("rep", "comp", "n", *self.sketch), order).alias("leader"))
        member = {c: F.col(c) for c in ("n", *self.sketch)}
        met = self.live.join(leader, "bucket")
        met = met.filter((F.col("comp") != F.col("leader.comp")) & _may_link(member, F.col("leader")))
        best = F.min(F.struct(_different(member, F.col("leader")).alias("d"), F.col("leader.rep").alias("a"), F.col("leader.comp").alias("ca")))
        pairs = met.groupBy(F.col("rep").alias("b"), F.col("comp").alias("cb")).agg(best.alias("best"))
        self._join_up(self._checked(pairs.select("best.a", "b", "best.ca", "cb")))
        self._find_live()

    def rest(self) -> None:
        """What is left: members outside the main component of their bucket, against
        all members of the bucket in another component."""
        sizes = stored(self.live.groupBy("bucket").count(), "minhash-sizes", self.n_members)
        edges = self._small_buckets(sizes.filter(F.col("count") <= CROWD).select("bucket"))
        crowded = sizes.filter(F.col("count") > CROWD).select("bucket")
        if not crowded.isEmpty():
            edges = edges.unionByName(self._crowded_buckets(crowded))
        self._join_up(edges)

    def _small_buckets(self, buckets: DataFrame) -> DataFrame:
        """Edges from pairs inside buckets of bounded size. A pair is taken in the first
        band that it shares."""
        live = self.live.join(buckets, "bucket")
        ids = stored(live.select("rep").distinct(), "minhash-rest", self.n_members)
        bands = join_small(self.reps.select("rep", "bands"), ids, "rep", "left_semi", max_bytes=CANDIDATE_IDS_BYTES)
        head = live.groupBy("bucket").agg(F.min_by("comp", "rep").alias("_main"))
        named = stored(live.join(head, "bucket").join(bands, "rep"), "minhash-named", self.n_members)
        x, y = named.filter("comp != _main").alias("x"), named.alias("y")
        other = (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y._main")) | (F.col("x.rep") < F.col("y.rep")))
        fields = lambda side: {c: F.col(f"{side}.{c}") for c in ("n", *self.sketch)}
        same = F.zip_with("x.bands", "y.bands", lambda p, q: p == q)
        first = F.array_position(same, True) == F.col("x.band") + 1
        cond = (F.col("x.bucket") == F.col("y.bucket")) & other & _may_link(fields("x"), fields("y")) & first
        pairs = x.join(y, cond).select(
            F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.col("x.comp").alias("ca"), F.col("y.comp").alias("cb")
        )
        return self._checked(pairs)

    def _crowded_buckets(self, buckets: DataFrame) -> DataFrame:
        """Edges inside large buckets. Large buckets with a member in common are one
        cluster; the members outside its largest component meet all members in
        blocks of bounded size, which give only the links they find."""
        live = self.live.join(buckets, "bucket").select("rep", "bucket", "comp")
        heads = live.groupBy("bucket").agg(F.min("rep").alias("_head"))
        tied = components(live.join(heads, "bucket"), "rep", "_head", self.n_members)
        tied = tied.select(F.col("vertex").alias("rep"), F.col("component").alias("cluster"))
        placed = stored(live.select("rep", "comp").distinct().join(tied, "rep"), "minhash-clusters", self.n_members)
        counts = placed.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("_n"))
        facts = counts.groupBy("cluster").agg(
            F.max(F.struct("_n", "comp"))["comp"].alias("_main"), F.sum("_n").alias("_all"), F.max("_n").alias("_largest")
        )
        tiles = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
        facts = facts.withColumn("_ys", tiles(F.col("_all"))).withColumn("_xs", tiles(F.col("_all") - F.col("_largest")))
        full = placed.join(facts, "cluster").join(self.sets, "rep")
        of = lambda n, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = ["cluster", "x", "y", "rep", "comp", "_main", "shingles"]
        xs = full.filter("comp != _main").withColumn("x", of("_xs", 1)).withColumn("y", every("_ys")).select(*columns)
        ys = full.withColumn("y", of("_ys", 2)).withColumn("x", every("_xs")).select(*[F.col(c).alias(c) for c in columns])
        block = ["cluster", "x", "y"]
        found = xs.groupBy(*block).cogroup(ys.groupBy(*block)).applyInArrow(_linked_in_block, "ca long, cb long")
        return found.distinct()

    def solve(self) -> DataFrame:
        for turn in range(LEADER_ROUNDS):
            if not self.n_members:
                break
            self.by_leaders(turn)
        if self.n_members:
            self.rest()
        return self.labels


def near_duplicates(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` and ``component_id`` (the least
    id that is reachable over links of similarity 0.8 or more)."""
    ship(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = stored(_signatures(rows, words), "minhash-signatures")
    usable = signed.filter("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    sketch = _Classes.sketch
    # equal sets have equal signatures, so the rows of a class agree in all but the id
    facts = [F.any_value(c).alias(c) for c in ("n_shingles", "bands", *sketch)]
    classes = usable.groupBy("set_hash").agg(F.min("doc_id").alias("doc_id"), *facts).withColumnRenamed("n_shingles", "n")
    # the numbers are written down before they are used
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")
    named = classes.select("rep", "set_hash", "doc_id")
    reps = classes.select("rep", "n", "bands", *sketch)
    labels = _Classes(named, reps, rows.filter("doc_id IS NOT NULL"), words).solve()
    of_class = named.join(labels, "rep", "left").select("rep", "set_hash", "doc_id", F.coalesce("comp", "rep").alias("comp"))
    of_class = _with_shared_ids(of_class, usable)
    least = of_class.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_class = of_class.select("set_hash", "comp").join(least, "comp").drop("comp")
    joined = signed.select("doc_id", "n_shingles", "set_hash").join(of_class, "set_hash", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _with_shared_ids(of_class: DataFrame, usable: DataFrame) -> DataFrame:
    """Components joined where an id has texts of several classes."""
    which = F.xxhash64("set_hash")
    several = usable.groupBy("doc_id").agg(F.min(which).alias("_lo"), F.max(which).alias("_hi")).filter("_lo != _hi")
    several = stored(several.select("doc_id"), "minhash-shared-ids")
    if several.isEmpty():
        return of_class
    of_class = stored(of_class, "minhash-of-class")
    held = usable.select("doc_id", "set_hash").join(several, "doc_id").distinct()
    held = held.join(of_class.select("set_hash", "comp"), "set_hash")
    first = held.groupBy("doc_id").agg(F.min("comp").alias("_first"))
    merged = components(held.join(first, "doc_id"), "_first", "comp")
    merged = merged.select(F.col("vertex").alias("comp"), F.col("component").alias("_to"))
    return of_class.join(merged, "comp", "left").withColumn("comp", F.coalesce("_to", "comp")).drop("_to")
