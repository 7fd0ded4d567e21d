"""Source divergence audit: how the word use of sources of a language differs.

1. Terms are runs of letters and non-ASCII characters, A-Z in lower case. A task
   joins texts to chunks of some megabytes and finds all terms in array
   operations. Terms of up to 8 bytes are packed into one 64-bit word, those of
   up to 16 bytes into two; these are radix-sorted by 16-bit digits and counted
   by runs. Longer terms are sorted as byte strings, one bucket per length. The
   sort is stable and texts of a group stand together, so one pass over the runs
   gives the occurrences per group and term and the documents that hold it.
2. The chunks' counts are added up by (lang, source, term). A language keeps the
   terms that ``min_docs`` of its documents hold.
3. Shares are integers in billionths with one added to every count:
   ``p = 1 + floor(10^9 (count+1) / (N + V))``; the divergence of p from q at a
   term is ``floor((p-q)^2 / q)``. All arithmetic is exact.
4. Part ``term``: the terms that a source uses more than its language, the highest
   divergences first, ``top`` at most.
5. Part ``pair``: the divergence of a source from each other one of its language,
   over all kept terms. Terms are dealt to slices and sources to blocks; a task
   has the counts of one slice for two blocks as a matrix and gives one number
   per pair of sources. Terms that neither block holds count by a constant.

No text is shuffled, and neither a frequent term nor a large source meets in one
task: both come as one row per task that read it. Work on pairs grows with terms
times pairs, as does the result with the pairs.

Defined cases: NULL text, language and source count as empty text; a group
without terms takes part with counts of 0; a language without kept terms has
divergence 0 in all its pairs; rows of one id count each; an empty table gives no
rows. A text is counted in one piece, whatever its length. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import only, ship, stored, tidy
from quaylake.plans.broadcast import join_small

MIN_DOCS = 3
TOP = 200
#: bytes of text that a task counts at once (a longer text is a chunk of its own)
CHUNK_BYTES = 4 << 20
#: sources of a block; a task holds the sums of one block against another
SOURCES_PER_BLOCK = 256
#: rows of a slice, on average
ROWS_PER_SLICE = 200_000
#: cells of a matrix of counts
CELLS = 1 << 20
BROADCAST_BYTES = 32 << 20
BILLION = 1_000_000_000


def _byte_table() -> np.ndarray:
    """Each byte as part of a term (A-Z in lower case), or 0 for what separates."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    separators = np.r_[0x00:0x41, 0x5B:0x61, 0x7B:0x80]
    table[separators] = 0
    return table


_BYTES = _byte_table()


# ------------------------------------------------------------------ terms of a chunk
def _find(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, and start, length and text number of every term."""
    joined = _BYTES[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = np.zeros(len(joined) + 1, np.int8)
    inside[1:] = joined != 0
    edges = np.diff(inside, append=0)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    first_byte = np.cumsum([0] + [len(t) + 1 for t in texts])
    return joined, start, end - start, np.searchsorted(first_byte, start, side="right") - 1


def _packed(joined: np.ndarray, start: np.ndarray, length: np.ndarray, skip: int) -> np.ndarray:
    """Bytes ``skip`` to ``skip + 7`` of each term as one word, zeros behind its end."""
    word = np.zeros(len(start), np.uint64)
    last = len(joined) - 1
    for j in range(skip, skip + 8):
        byte = np.where(j < length, joined[np.minimum(start + j, last)], 0)
        word = (word << np.uint64(8)) | byte.astype(np.uint64)
    return word


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by the words, the first one first: least digit first, 16 bits at a
    time (numpy sorts these by counting)."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(new_term: np.ndarray, group: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of terms in order: first place of each (term, group), occurrences, texts."""
    new_group = new_term.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_text = new_group.copy()
    new_text[1:] |= text[1:] != text[:-1]
    first = np.flatnonzero(new_group)
    return first, np.diff(first, append=len(group)), np.add.reduceat(new_text.astype(np.int64), first)


def _changes(*columns: np.ndarray) -> np.ndarray:
    changed = np.zeros(len(columns[0]), bool)
    changed[0] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return changed


def count_terms(texts: list[bytes], groups: list[int]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group of each, occurrences, texts) of a chunk, by classes of length.
    ``groups`` must not fall from one text to the next."""
    joined, start, length, text = _find(texts)
    group = np.asarray(groups, np.int64)[text]
    for low, high in ((1, 8), (9, 16)):
        at = np.flatnonzero((length >= low) & (length <= high))
        if not len(at):
            continue
        words = [_packed(joined, start[at], length[at], skip) for skip in range(0, high, 8)]
        order = radix_order(words)
        words, at = [w[order] for w in words], at[order]
        first, n, docs = _runs(_changes(*words), group[at], text[at])
        terms = np.stack([w[first] for w in words], axis=1).astype(">u8").view(f"S{high}").ravel()
        yield terms.tolist(), group[at[first]], n, docs
    long = np.flatnonzero(length > 16)
    for size in np.unique(length[long]):
        at = long[length[long] == size]
        terms = joined[start[at][:, None] + np.arange(size)].view(f"S{size}").ravel()
        order = np.argsort(terms, kind="stable")
        terms, at = terms[order], at[order]
        first, n, docs = _runs(_changes(terms), group[at], text[at])
        yield terms[first].tolist(), group[at[first]], n, docs


def _count_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    names = ["lang", "source", "term", "n", "docs"]

    def flush(rows: list[tuple[str, str, bytes]]) -> Iterator:
        rows.sort(key=lambda r: r[:2])  # stable, by group
        keys = sorted({r[:2] for r in rows})
        number = {k: i for i, k in enumerate(keys)}
        for terms, group, n, docs in count_terms([r[2] for r in rows], [number[r[:2]] for r in rows]):
            at = pa.array(group)
            langs, sources = (pa.array([k[i] for k in keys], pa.string()).take(at) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([langs, sources, pa.array(terms, pa.binary()), pa.array(n), pa.array(docs)], names)

    rows, size = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            rows.append(row)
            size += len(row[2])
            if size >= CHUNK_BYTES:
                yield from flush(rows)
                rows, size = [], 0
    if rows:
        yield from flush(rows)


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (rows with it)."""
    ship(docs.sparkSession)
    plain = only(docs, lang=lang_col, source=source_col, text=text_col)
    empty = F.lit("")
    texts = plain.select(
        F.coalesce(F.col("lang").cast("string"), empty).alias("lang"),
        F.coalesce(F.col("source").cast("string"), empty).alias("source"),
        F.coalesce(F.col("text"), empty).cast("binary").alias("text"),
    )
    counted = texts.mapInArrow(tidy(_count_batches), "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ------------------------------------------------------------------------ divergence
def _share(n: Column, total: Column, v: Column) -> Column:
    """p of a count, exact at any size (the quotient of decimals is a whole number)."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide(n + 1) * F.lit(BILLION).cast("decimal(10,0)"), wide(total + v))


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The same of arrays: division digit by digit (base 1000), so that no product
    leaves 64 bits; ``total`` includes the terms."""
    rest, out = n + 1, np.zeros_like(n)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return out + 1


def _kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """Counts of the kept terms, with ``lang_n`` and ``first`` (1 in one row a term)."""
    of_term = Window.partitionBy("lang", "term")
    told = counts.withColumn("lang_docs", F.sum("docs").over(of_term)).withColumn("lang_n", F.sum("n").over(of_term))
    told = told.withColumn("first", (F.row_number().over(of_term.orderBy("source")) == 1).cast("long"))
    return told.filter(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first")


def _groups(docs: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Each (lang, source): ``total``, and ``v``, ``lang_total`` and ``rows`` of the lang;
    ``at`` numbers the sources of a lang."""
    empty = F.lit("")
    plain = only(docs, lang=lang_col, source=source_col)
    all_groups = plain.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.sum("first").alias("v"), F.sum(F.col("first") * F.col("lang_n")).alias("lang_total"), F.count(F.lit(1)).alias("rows")
    )
    lang = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return all_groups.join(sums, ["lang", "source"], "left").select(
        "lang",
        "source",
        zero("total").alias("total"),
        *[F.sum(zero(c)).over(lang).alias(c) for c in ("v", "lang_total", "rows")],
        (F.row_number().over(lang.orderBy("source")) - 1).alias("at"),
        F.count(F.lit(1)).over(lang).alias("sources"),
    )


def _term_part(kept: DataFrame, top: int) -> DataFrame:
    p = _share(F.col("n"), F.col("total"), F.col("v"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    more = kept.withColumn("p", p).withColumn("q", q).filter("p > q")
    valued = more.select("lang", "source", F.col("term").cast("string").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _matrix_sums(key, table):
    """One row per pair of sources of two blocks: divergence over the terms seen."""
    import pyarrow as pa

    lang, row_block, col_block = key[0].as_py(), key[1].as_py(), key[2].as_py()
    is_head = table.column("term").is_null().to_numpy(zero_copy_only=False)
    at, n, total = (table.column(c).to_numpy() for c in ("at", "n", "total"))
    head = np.flatnonzero(is_head)
    head = head[np.argsort(at[head], kind="stable")]
    known, known_total = at[head], total[head]
    body = np.flatnonzero(~is_head)
    term = table.column("term").combine_chunks().take(pa.array(body)).dictionary_encode()
    seen = len(term.dictionary)
    code = term.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    code, n, column = code[order], n[body][order], np.searchsorted(known, at[body][order])
    # `at` and the block size name the block of a source
    size = table.column("block_size")[0].as_py()
    rows, cols = (np.flatnonzero(known // size == b) for b in (row_block, col_block))
    sums = np.zeros((len(rows), len(cols)), np.int64)
    step = max(1, CELLS // max(1, len(known)))
    for lo in range(0, seen, step):
        a, b = np.searchsorted(code, [lo, lo + step])
        counts = np.zeros((min(step, seen - lo), len(known)), np.int64)
        counts[code[a:b] - lo, column[a:b]] = n[a:b]
        share = shares(counts, known_total[None, :])
        q = share[:, cols]
        for i, r in enumerate(rows):
            gap = share[:, r, None] - q
            sums[i] += (gap * gap // q).sum(axis=0)
    one, two = np.repeat(known[rows], len(cols)), np.tile(known[cols], len(rows))
    size = len(one)
    return pa.table(
        {
            "lang": pa.array([lang] * size, pa.string()),
            "at": pa.array(one, pa.int32()),
            "other": pa.array(two, pa.int32()),
            "part_sum": pa.array(sums.ravel()),
            "seen": pa.array(np.full(size, seen, np.int64)),
        }
    )


def _pair_part(kept: DataFrame, groups: DataFrame, block_size: int, rows_per_slice: int) -> DataFrame:
    blocks = F.ceil(F.col("sources") / F.lit(block_size)).cast("int")
    # a row meets 2 blocks - 1 of the blocks x blocks tasks of a slice
    per_task = F.col("rows") * (2 * F.col("blocks") - 1) / (F.col("blocks") * F.col("blocks"))
    slices = F.greatest(F.lit(1), F.ceil(per_task / F.lit(rows_per_slice))).cast("int")
    block = F.floor(F.col("at") / F.lit(block_size)).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tasks = F.array_distinct(
        F.concat(
            F.transform(others, lambda b: F.struct(F.col("block").alias("i"), b.alias("j"))),
            F.transform(others, lambda b: F.struct(b.alias("i"), F.col("block").alias("j"))),
        )
    )

    def dealt(rows: DataFrame, number: Column) -> DataFrame:
        rows = rows.withColumn("blocks", blocks).withColumn("block", block).withColumn("slices", slices)
        rows = rows.withColumn("slice", number).withColumn("task", F.explode(tasks))
        total = (F.col("total") + F.col("v")).alias("total")
        return rows.select("lang", F.col("task.i").alias("i"), F.col("task.j").alias("j"), "slice", "at", "term", "n", total)

    heads = groups.filter("v > 0").withColumn("term", F.lit(None).cast("binary")).withColumn("n", F.lit(0).cast("long"))
    heads = dealt(heads, F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    body = dealt(kept, F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    both = body.unionByName(heads).withColumn("block_size", F.lit(block_size))
    sums = both.groupBy("lang", "i", "j", "slice").applyInArrow(_matrix_sums, "lang string, at int, other int, part_sum long, seen long")
    sums = sums.groupBy("lang", "at", "other").agg(F.sum("part_sum").alias("part_sum"), F.sum("seen").alias("seen"))

    other = groups.select("lang", F.col("at").alias("other"), F.col("source").alias("item"), F.col("total").alias("other_total"))
    pairs = groups.select("lang", "source", "at", "total", "v").join(other, "lang").filter("at != other")
    valued = pairs.join(sums, ["lang", "at", "other"], "left")
    nothing = F.lit(0).cast("long")
    apart = _divergence(_share(nothing, F.col("total"), F.col("v")), _share(nothing, F.col("other_total"), F.col("v")))
    unseen = F.col("v") - F.coalesce("seen", nothing)
    value = F.when(F.col("v") == 0, nothing).otherwise(F.coalesce("part_sum", nothing) + unseen * apart)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    block_size: int = SOURCES_PER_BLOCK,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` (long) and
    ``rank`` (int, from 1 per group and part)."""
    counts = term_counts(docs, lang_col, source_col, text_col)
    kept = stored(_kept_terms(counts, min_docs), "divergence-terms")
    groups = stored(_groups(docs, kept, lang_col, source_col), "divergence-groups")
    known = join_small(kept, groups, ["lang", "source"], max_bytes=BROADCAST_BYTES)
    parts = {"pair": _pair_part(known, groups, block_size, rows_per_slice), "term": _term_part(known, top)}
    found = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, df in parts.items()]
    return found[0].unionByName(found[1])
