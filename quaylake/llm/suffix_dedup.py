"""Exact substring deduplication with suffix arrays in shards.

Texts are UTF-8 bytes. A byte is removed if a string of ``LENGTH`` bytes covers
it that also starts earlier: in a document of smaller id, or earlier in the
same one. Strings are judged on the input, not on what is left.

How equal strings meet without comparing everything:

1. The least hash among the 24-byte grams of a window is a function of the
   window alone, so equal windows share it. Runs of windows with the same least
   gram are the unit of work; a run's text is a *segment* (some 140 bytes). All
   runs are shuffled by their gram once, as narrow rows without text.
2. Equal segments are one segment: all but the first occurrence are removed.
   Those with an equal, earlier one in their batch of rows are known to be copies
   and go to other tasks than their gram, so that a very common passage does not
   fill one.
3. The distinct segments of a gram that has several, and those that hold their
   gram twice, go to the shard of their gram; no other can hold a further repeat. A
   shard concatenates them, builds a suffix array by induced sorting and the
   permuted common prefixes of neighbours; windows with 100 bytes in common form
   an interval, and all but its first are removed.
4. A gram with more distinct segments than a shard should hold (a very common
   line in many surroundings) is taken apart into single windows, which meet by
   their own hash. So no group is unbounded and none is dropped.

Shuffled data: runs (one per 39 bytes of text), the texts, and one copy of each
distinct segment of 3. Texts are dealt by document, once for the segments and the
result. The form is the same at all sizes.

Defined cases: a NULL text counts as empty; texts of under 100 bytes lose
nothing; NULL ids come before all others; rows of one id and one text are one
document and get the same result, rows of one id and different texts are taken
in the order of their checksums. Very long and periodic texts are cut into
runs of at most 256 windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import only, ship, shuffle_width, stored, tidy
from quaylake.llm.rolling import hashes, mix, prefix_sums
from quaylake.llm.suffix_array import _words, common_prefix, suffix_array

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
RUN = 256
SHARD_BYTES = 1 << 20
#: distinct segments of one gram that go to a shard together
SEGMENTS_PER_GRAM = 4096
#: lists are not broadcast at any size: they grow with the input, and a form that changes
#: at some size would change the data shuffled per byte; above 0, Spark may choose
BROADCAST_BYTES = 0
#: single windows that are looked at together
WINDOWS = 200_000
FIRST_ID = -(1 << 63)  # stands for a NULL id
COPY, FEW, MANY = 0, 1, 2  # kinds of occurrences


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def least_grams(data: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams, and the least one of each window."""
    grams = hashes(sums, slice(0, len(data) - GRAM + 1), slice(GRAM, len(data) + 1))
    return grams, _sliding(grams, SPAN, np.minimum)


def chosen_places(grams: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places of the grams that are least in a window."""
    edge = np.zeros(SPAN - 1, np.uint64)
    return np.flatnonzero(grams == _sliding(np.concatenate([edge, least, edge]), SPAN, np.maximum))


def looping(grams: np.ndarray, least: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Runs that may hold their gram twice; in others, no window repeats. Two places of a
    run's gram have no other chosen gram between them."""
    at = chosen_places(grams, least)
    same = grams[at[1:]] == grams[at[:-1]]
    one, two = at[:-1][same], np.append(at[1:][same], len(grams) + RUN)
    return two[np.searchsorted(one, begin)] < end + SPAN - 1


def window_runs(least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least gram, first and last-plus-one window start of each run (texts of
    ``LENGTH`` bytes at least)."""
    begin = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    end = np.append(begin[1:], len(least))
    if (end - begin).max() > RUN:
        pieces = -(-(end - begin) // RUN)
        run = np.repeat(np.arange(len(begin)), pieces)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, last = begin[run] + nth * RUN, end[run]
        end = np.minimum(begin + RUN, last)
    return least[begin], begin, end


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode()


# unit: the gram, or for known copies any number; at: start << 32, windows << 2, loops << 1, again
_OCCURRENCE = "unit long, segment long, doc_id long, crc long, at long"


def _marked(parts: list[tuple]):
    """Occurrences as rows: gram, segment, document, crc, start, stop and loops of each
    part, arrays but for the document and its crc. Rows of one place are one, and
    those of a segment that comes earlier among these rows are marked."""
    import pyarrow as pa

    n = [len(p[0]) for p in parts]
    gram, segment, start, stop, loops = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 4, 5, 6))
    doc, crc = (np.repeat(np.array([p[i] for p in parts], np.int64), n) for i in (2, 3))
    by = np.lexsort((start, crc, doc, segment, gram))
    same = [c[by][1:] == c[by][:-1] for c in (gram, segment, doc, crc, start)]
    known = same[0] & same[1]
    new = np.append(True, ~(known & same[2] & same[3] & same[4]))
    # a place is there once, so a row after one of its segment comes later in the texts
    again = np.empty(len(by), bool)
    again[by] = np.append(False, known)
    # as in the texts: neighbours of a document pack well
    rows = np.sort(by[new])
    gram, segment, doc, crc, start, stop, loops, again = (c[rows] for c in (gram, segment, doc, crc, start, stop, loops, again))
    place = (crc.astype(np.uint64) << np.uint64(32)) | start.astype(np.uint64)
    unit = np.where(again, mix(mix(place) + doc.view(np.uint64)), gram).view(np.int64)
    at = (start.astype(np.int64) << 32) | ((stop - start).astype(np.int64) << 2) | (loops.astype(np.int64) << 1) | again
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (unit, segment.view(np.int64), doc, crc, at)], [f.split()[0] for f in _OCCURRENCE.split(", ")])


def _occurrences(batches: Iterator) -> Iterator:
    """All runs: gram, hash of the segment, document and place."""
    for batch in batches:
        parts = []
        for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = _bytes_of(t)
            data = np.frombuffer(raw, np.uint8)
            if len(data) < LENGTH:
                continue
            sums = prefix_sums(data)
            grams, least = least_grams(data, sums)
            gram, start, stop = window_runs(least)
            segment = mix(hashes(sums, start, stop + LENGTH - 1) + (stop - start).astype(np.uint64))
            parts.append((gram, segment, doc, zlib.crc32(raw), start, stop, looping(grams, least, start, stop)))
        if parts:
            yield _marked(parts)


_PLACE = ("doc_id", "crc", "at")


def _copy() -> Column:
    """Whether a place comes after the first one of its segment."""
    known = F.col("at").bitwiseAND(F.lit(1)) == 1
    return known | (F.rank().over(Window.partitionBy("unit", "segment").orderBy(*_PLACE)) > 1)


def _with_kinds(occurrences: DataFrame) -> DataFrame:
    """Occurrences that matter (kind, gram, place): copies, and first ones whose gram has
    other segments (few or many) or loops."""
    segment = Window.partitionBy("unit", "segment").orderBy(*_PLACE)
    rows = occurrences.repartition("unit").select("*", _copy().alias("copy"), F.row_number().over(segment).alias("row"))
    rows = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("unit").orderBy("segment")))
    rows = rows.withColumn("segments", F.max("nth").over(Window.partitionBy("unit")))
    several = (F.col("segments") > 1) | (F.col("at").bitwiseAND(F.lit(2)) > 0)
    kind = F.when(F.col("copy"), COPY).when((F.col("row") == 1) & several, F.when(F.col("segments") > SEGMENTS_PER_GRAM, MANY).otherwise(FEW))
    rows = rows.withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("kind", F.when(F.col("kind") != COPY, F.col("unit")).alias("gram"), *_PLACE)


def _start() -> Column:
    return F.shiftright("at", 32)


def _windows() -> Column:
    return F.shiftright(F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)), 2)


def _spans(copies: DataFrame) -> DataFrame:
    start = _start().cast("int")
    return copies.select("doc_id", "crc", start.alias("start"), (start + _windows().cast("int") + LENGTH - 1).alias("end"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("crc"))


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """docs (doc_id, text) with their ``places``, by a shuffle at all sizes: the exchange
    of the texts is the same in all such joins of a query, which Spark runs once."""
    lists = lists if BROADCAST_BYTES > 0 else lists.hint("merge")
    return _keyed(docs).join(lists, ["doc_id", "crc"], how).select("doc_id", "crc", "text", "places")


def _listed(rows: DataFrame, value: Column) -> DataFrame:
    """The longs of each document. A list is bounded by the length of its text."""
    return rows.groupBy("doc_id", "crc").agg(F.collect_set(value).alias("places"))


def _cut_segments(batches: Iterator) -> Iterator:
    """The text of listed segments. A place holds shard, windows and start."""
    import pyarrow as pa

    for batch in batches:
        shard, doc_ids, crcs, starts, texts = [], [], [], [], []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "crc", "text", "places")]
        for doc, crc, t, places in zip(*columns, strict=True):
            raw = _bytes_of(t)
            for p in places:
                start, n = p & 0xFFFFFFFF, (p >> 32) & 0x1FF
                shard.append(p >> 41)
                starts.append(start)
                texts.append(raw[start : start + n + LENGTH - 1])
            doc_ids += [doc] * len(places)
            crcs += [crc] * len(places)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(crcs, pa.int64()), pa.array(starts, pa.int32()), pa.array(texts, pa.binary())],
            ["shard", "doc_id", "crc", "start", "text"],
        )


def repeated_windows(segments: list[bytes], place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment number, first and end offset of the removed spans of one shard.

    ``place`` is a number per segment that rises with document and start, in such
    a way that adding a window's offset gives the order of windows.
    """
    length = np.array([len(s) for s in segments])
    begin = np.cumsum(length + 1) - (length + 1)
    # a separator after each segment, then the end symbol
    raw = np.frombuffer(b"\xff".join([*segments, b"\xfe"]), np.uint8)
    present = np.bincount(raw, minlength=256) > 0
    present[[255, 254]] = False
    code = np.zeros(256, np.uint8)
    code[present] = np.arange(2, 2 + present.sum())
    code[255] = 1
    text = code[raw]
    array = suffix_array(text, int(present.sum()) + 2, LENGTH)
    owner = np.repeat(np.arange(len(segments)), length + 1)
    offset = np.arange(len(owner)) - begin[owner]
    whole = offset <= length[owner] - LENGTH  # a full window begins here
    at = array[array < len(owner)]
    at = at[whole[at]]
    if len(at) < 2:
        return (np.empty(0, np.int64),) * 3
    words = _words(text)
    # the permuted common prefixes: of each window and the one before it in the array
    permuted = np.zeros(len(text), np.int32)
    permuted[at[1:]] = common_prefix(words, at[1:], at[:-1], LENGTH)
    heads = np.flatnonzero(permuted[at] < LENGTH)
    order = place[owner[at]] + offset[at]
    first = np.minimum.reduceat(order, heads)
    group = np.cumsum(permuted[at] < LENGTH) - 1
    removed = np.sort(at[order > first[group]])
    if not len(removed):
        return (np.empty(0, np.int64),) * 3
    # windows that touch make one span
    apart = np.append(True, (removed[1:] - removed[:-1] > LENGTH) | (owner[removed[1:]] != owner[removed[:-1]]))
    lo = removed[apart]
    hi = removed[np.append(np.flatnonzero(apart)[1:] - 1, len(removed) - 1)]
    return owner[lo], offset[lo], offset[hi] + LENGTH


def _sort_shards(batches: Iterator) -> Iterator:
    """Removed spans of the segments of each shard; rows come sorted by shard."""
    import pyarrow as pa

    held: list[pa.RecordBatch] = []

    def solve() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        doc, crc, start = (table.column(c).to_numpy() for c in ("doc_id", "crc", "start"))
        by = np.lexsort((crc, doc))
        step = np.append(0, (doc[by][1:] != doc[by][:-1]) | (crc[by][1:] != crc[by][:-1]))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(step)
        which, lo, hi = repeated_windows(table.column("text").to_pylist(), (rank << 32) + start)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[which]), pa.array(crc[which]), pa.array((start[which] + lo).astype(np.int32)), pa.array((start[which] + hi).astype(np.int32))],
            ["doc_id", "crc", "start", "end"],
        )

    now = None
    for batch in batches:
        shards = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and shards[a] != now:
                yield solve()
                held = []
            now = shards[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield solve()


def _single_windows(batches: Iterator) -> Iterator:
    """Every window of listed segments as an occurrence of its own."""
    for batch in batches:
        parts, held = [], 0
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "crc", "text", "places")]
        for doc, crc, t, places in zip(*columns, strict=True):
            sums = prefix_sums(np.frombuffer(_bytes_of(t), np.uint8))
            starts = np.concatenate([np.arange(p & 0xFFFFFFFF, (p & 0xFFFFFFFF) + (p >> 32)) for p in places])
            one = hashes(sums, starts, starts + LENGTH)
            two = mix(hashes(sums, starts, starts + LENGTH // 2) ^ hashes(sums, starts + 7, starts + LENGTH))
            parts.append((one, two, doc, crc, starts, starts + 1, np.zeros(len(starts), bool)))
            held += len(starts)
            if held > WINDOWS:
                yield _marked(parts)
                parts, held = [], 0
        if parts:
            yield _marked(parts)


def _merge_places(batches: Iterator) -> Iterator:
    """Joins overlapping and touching spans of each document."""
    import pyarrow as pa

    for batch in batches:
        merged = []
        for places in batch.column(2):
            p = np.sort(places.values.to_numpy())
            lo, hi = p >> 32, p & 0xFFFFFFFF
            reach = np.maximum.accumulate(hi)
            new = np.append(True, lo[1:] > reach[:-1])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)
            merged.append((lo[new] << 32) | reach[last])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(merged, pa.list_(pa.int64()))], ["doc_id", "crc", "places"])


def removed_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, crc, places) of documents that lose bytes: merged spans, each packed
    as start and end of 32 bits. ``docs``: doc_id (long, no NULL) and text."""
    found = docs.select("doc_id", "text").mapInArrow(tidy(_occurrences), _OCCURRENCE)
    found = stored(_with_kinds(found), "occurrences")
    spans = _spans(found.filter(F.col("kind") == COPY))

    few = found.filter(F.col("kind") == FEW)
    size = few.agg(F.sum(_windows() + LENGTH)).first()[0] or 0
    shards = min(max(1, size // SHARD_BYTES), 1 << 20)
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    packed = F.shiftleft(_windows(), 32).bitwiseOR(_start())
    cut = _with_lists(docs, _listed(few, F.shiftleft(shard, 41).bitwiseOR(packed)), "inner")
    cut = cut.mapInArrow(tidy(_cut_segments), "shard long, doc_id long, crc long, start int, text binary")
    sorted_rows = cut.repartition(shuffle_width(docs.sparkSession), "shard").sortWithinPartitions("shard")
    spans = spans.unionByName(sorted_rows.mapInArrow(tidy(_sort_shards), "doc_id long, crc long, start int, end int"))

    many = found.filter(F.col("kind") == MANY)
    if not many.isEmpty():
        single = _with_lists(docs, _listed(many, packed), "inner").mapInArrow(tidy(_single_windows), _OCCURRENCE)
        spans = spans.unionByName(_spans(single.withColumn("copy", _copy()).filter("copy")))

    span = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    return _listed(spans, span).mapInArrow(tidy(_merge_places), "doc_id long, crc long, places array<long>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``spans`` (array of removed start
    and end byte offsets) and ``kept`` (binary: the bytes that stay)."""
    import pyarrow as pa

    ship(docs.sparkSession)
    rows = only(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    both = _with_lists(rows, removed_spans(rows), "left")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            kept, spans = [], []
            for t, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, at, parts, mine = t.encode(), 0, [], []
                for p in places or ():
                    parts.append(raw[at : p >> 32])
                    at = p & 0xFFFFFFFF
                    mine.append({"start": p >> 32, "end": at})
                kept.append(b"".join([*parts, raw[at:]]) if parts else raw)
                spans.append(mine)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "spans", "kept"])

    out = both.select("doc_id", "text", "places").mapInArrow(tidy(run), "doc_id long, spans array<struct<start: long, end: long>>, kept binary")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select(
        F.when(F.col("doc_id") != FIRST_ID, F.col("doc_id")).alias("doc_id"),
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        "spans",
        "kept",
    )
