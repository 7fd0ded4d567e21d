"""Repeated runs of lines, found with a suffix array over line ids.

Each document is the sequence of its lines' ids (64-bit hashes). A run that
begins earlier as well (in a document of smaller id, or earlier in the same
one) and has ``min_words`` words is deleted where it comes again, to its first
and last line: a line goes if any such run holds it. Two questions a line decide
that exactly, the shortest run with that many words from the line on and the
shortest that ends with it. Each line of a longer run lies in one of these inside
the run: in its own forward one, in its own backward one, or, where neither side
has the words, in the forward one of the run's first line.

Prefix doubling, distributed: rank 0 of a suffix is the place of its first line
among all repeated lines in order of id; rank ``k + 1`` orders suffixes by the
pair of rank ``k`` here and rank ``k`` after ``2^k`` lines. A rank is the position
at which the group of equal suffixes begins in the suffix array, so a group is
an interval of suffixes with a common prefix of ``2^k`` lines. Intervals of one
suffix hold no repeat and leave the array. A run of ``e`` lines lies between
two powers: the interval of its common prefix is the pair of the intervals of
its first and of its last ``2^k`` lines. Doubling ends when ``2^k`` passes the
longest run in question.

Ranks come from counts, never from a global sort: groups of equal pairs are
counted with map-side aggregation and numbered inside slices of a group, slices
by a running total. A line that a third of all documents hold is one row
there. Only DataFrame expressions are used.

Defined cases: a NULL text counts as empty (one empty line, no words); lines are
separated by line feeds and compared exactly; words are what single blanks
separate; rows of one id and one text are one document and get the same result;
rows of one id and different texts are taken in the order of their hashes; NULL
ids come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.llm.common import fewer, only, position, stored
from quaylake.plans.broadcast import join_small

#: words in a run, at least
MIN_WORDS = 30
#: measured size up to which lists are broadcast; beyond it the join is a shuffle
BROADCAST_BYTES = 32 << 20
FIRST_ID = -(1 << 63)
#: slices of the numbering: by leading bits of the ids, and by this many ranks
LEADING_BITS = 13
SLICE = 1 << 16

_DOC = ("doc_id", "text_hash")


def _line_words(line: Column) -> Column:
    blanks = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(blanks + 1).cast("long")


def _key(doc_id: Column, text: Column) -> list[Column]:
    return [
        F.coalesce(doc_id.cast("long"), F.lit(FIRST_ID)).alias("doc_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
    ]


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line: document, number, id and words."""
    rows = only(docs, id=id_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    rows = rows.select(*_key(F.col("id"), F.col("text")), F.posexplode(F.split(text, "\n")).alias("i", "line"))
    return rows.select(*_DOC, "i", F.xxhash64("line").alias("id"), _line_words(F.col("line")).alias("words"))


def _runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc, i, e): the shortest runs of ``e`` lines with ``min_words`` words that
    begin or end with some line, all their lines among ``lines``."""
    doc = Window.partitionBy(*_DOC)
    stretch = F.col("i") - F.row_number().over(doc.orderBy("i"))
    rows = lines.withColumn("_stretch", stretch)
    block = Window.partitionBy(*_DOC, "_stretch")
    before = F.sum("words").over(block.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    rows = rows.withColumn("_before", before)

    def event(at: Column, kind: int, j: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), j.alias("j"))

    # the first line start that has so many words before it, for runs that begin
    # with a line: line starts (and the end of the stretch) and the questions pass
    # in falling order of words; for runs that end with it, the last line start
    # with so many words up to the end of the line, in rising order
    after = F.col("_before") + F.col("words")
    start = event(F.col("_before"), 2, F.col("i"))
    end = event(after, 2, F.col("i") + 1)
    onward = event(F.col("_before") + min_words, 1, F.col("i"))
    back = event(after - min_words, 0, F.col("i"))
    events = rows.select(*_DOC, "_stretch", "i", F.explode(F.array(start, end, onward, back)).alias("e"))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    down = block.orderBy(F.desc("e.at"), F.desc("e.kind"), F.desc("e.j")).rowsBetween(*so_far)
    up = block.orderBy("e.at", F.desc("e.kind"), "e.j").rowsBetween(*so_far)
    passed = F.when(F.col("e.kind") == 2, F.col("e.j"))
    found = events.withColumn("_end", F.last(passed, ignorenulls=True).over(down))
    found = found.withColumn("_start", F.last(passed, ignorenulls=True).over(up)).filter("e.kind < 2")
    onward_asked = F.col("e.kind") == 1
    first = F.when(onward_asked, F.col("i")).otherwise(F.col("_start"))
    stop = F.when(onward_asked, F.col("_end")).otherwise(F.col("i") + 1)
    runs = found.select(*_DOC, first.alias("i"), (stop - first).cast("long").alias("e"))
    return runs.filter("e IS NOT NULL").distinct()


def _first_ranks(rows: DataFrame) -> DataFrame:
    """Rank 0: how many suffixes begin with a line of smaller id."""
    counts = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("_slice", F.shiftright("id", 64 - LEADING_BITS))
    totals = counts.groupBy("_slice").agg(F.sum("n").alias("n"))  # at most 2^LEADING_BITS rows
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_slice").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(offsets), "_slice")
    return ranks.select("id", (F.col("_offset") + F.col("_inside")).alias("rank"))


def _next_ranks(pairs: DataFrame) -> DataFrame:
    """(rank, then, next): the interval of each pair that occurs twice or more."""
    groups = pairs.groupBy("rank", "then").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = groups.withColumn("_slice", F.floor(F.col("then") / SLICE))
    inside = Window.partitionBy("rank", "_slice").orderBy("then").rowsBetween(Window.unboundedPreceding, -1)
    slices = groups.groupBy("rank", "_slice").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("rank").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("rank", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = groups.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(slices, ["rank", "_slice"])
    return numbered.select("rank", "then", (F.col("rank") + F.col("_offset") + F.col("_inside")).alias("next"))


def _at(suffixes: DataFrame, ahead: Column, name: str) -> DataFrame:
    """The ranks of the suffixes that begin ``ahead`` lines further on."""
    return suffixes.select(*_DOC, (F.col("i") - ahead).alias("i"), F.col("rank").alias(name))


def deleted_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, i, e): runs of ``e`` lines from line ``i`` that begin
    earlier as well and have ``min_words`` words."""
    often = lines.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    some = join_small(lines, fewer(often), "id", "left_semi", max_bytes=BROADCAST_BYTES)
    some = stored(some.dropDuplicates([*_DOC, "i"]), "repeated-lines")
    runs = stored(_runs(some, min_words), "line-runs")
    longest, asked_rows = runs.agg(F.max("e"), F.count(F.lit(1))).first()
    rows = some.count()
    suffixes = stored(some.join(_first_ranks(some), "id").select(*_DOC, "i", "rank"), "suffixes-0", rows)
    found: DataFrame | None = None
    k = 0
    while longest is not None and (1 << k) <= longest:
        span = 1 << k
        # runs of span .. 2 span - 1 lines: by the intervals of their two ends
        asked = runs.filter((F.col("e") >= span) & (F.col("e") < 2 * span)).select(*_DOC, "i", "e")
        head = asked.join(suffixes, [*_DOC, "i"])
        tail = head.withColumn("_last", F.col("i") + F.col("e") - span).join(
            suffixes.select(*_DOC, F.col("i").alias("_last"), F.col("rank").alias("last")), [*_DOC, "_last"]
        )
        group = ["e", "rank", "last"]
        first = tail.groupBy(*group).agg(F.min(F.struct(*_DOC, "i")).alias("first"))
        later = tail.join(first, group).filter(F.struct(*_DOC, "i") > F.col("first")).select(*_DOC, "i", "e")
        later = stored(later, "deleted-runs", asked_rows)
        found = later if found is None else found.unionByName(later)
        if 2 * span <= longest:
            pairs = suffixes.join(_at(suffixes, F.lit(span), "then"), [*_DOC, "i"])
            ranks = _next_ranks(pairs)
            moved = pairs.join(ranks, ["rank", "then"]).select(*_DOC, "i", F.col("next").alias("rank"))
            suffixes = stored(moved, f"suffixes-{k + 1}", rows)
        k += 1
    return found if found is not None else runs.filter(F.lit(False)).select(*_DOC, "i", "e")


def _islands(runs: DataFrame) -> DataFrame:
    """Maximal deleted runs per document: sorted ``removed`` (start, end)."""
    doc = Window.partitionBy(*_DOC).orderBy("i", "e")
    reach = F.max(F.col("i") + F.col("e")).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("_new", F.when(F.col("i") <= reach, 0).otherwise(1))
    numbered = marked.withColumn("_island", F.sum("_new").over(doc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    island = numbered.groupBy(*_DOC, "_island").agg(F.min("i").alias("start"), F.max(F.col("i") + F.col("e")).alias("end"))
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    return island.groupBy(*_DOC).agg(F.array_sort(F.collect_list(span)).alias("removed"))


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` replaced by the lines that stay, and
    ``n_lines`` and ``removed`` (array of start and end line numbers); columns of
    these two names are replaced."""
    names = [c for c in docs.columns if c not in ("n_lines", "removed")]
    places = [docs.columns.index(c) for c in names]
    spans = fewer(_islands(deleted_runs(lines_of(docs, id_col, text_col), min_words)))
    id_at, text_at = (F.col(f"_c{position(docs, c)}") for c in (id_col, text_col))
    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    both = join_small(plain.select("*", *_key(id_at, text_at)), spans, list(_DOC), "left", max_bytes=BROADCAST_BYTES)
    lines = F.split(F.coalesce(text_at, F.lit("")), "\n")
    zero, n = F.array(F.lit(0)), F.array(F.size(lines))
    begins = F.concat(zero, F.transform("removed", lambda s: s["end"]))
    ends = F.concat(F.transform("removed", lambda s: s["start"]), n)
    kept = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, b - a)))
    new_text = F.when(F.col("removed").isNull(), text_at).otherwise(F.concat_ws("\n", kept))
    at = position(docs, text_col)
    columns = [(new_text if i == at else F.col(f"_c{i}")).alias(c) for i, c in zip(places, names, strict=True)]
    return both.select(
        *columns,
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("removed", F.expr("CAST(array() AS array<struct<start: int, end: int>>)")).alias("removed"),
    )
