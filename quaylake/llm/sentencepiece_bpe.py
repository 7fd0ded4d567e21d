"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they would form, the leftmost first among equal scores, and merges the
best pair until no pair of neighbours forms a piece. Symbols that are no piece
fall back to their bytes. Short segments of one length have their agendas in a
matrix of ranks, a row each, and all rows merge their best pair at once; any
other segment has a heap.

No piece of such a vocabulary has a word-start mark behind another character,
so no merge crosses a space; a line feed that is in no longer piece separates
likewise. Texts are therefore encoded segment by segment, and equal segments
are encoded once per batch and kept in a bounded table of two generations: a
full one replaces the one before, and what is used again moves on. Both
conditions are read off the vocabulary when it is loaded; without them a text
is one segment.

Check against the library, in each Arrow batch: every segment that the agenda
encoded for the first time is encoded by the ``sentencepiece`` library as
well, and the first whole text of each chunk is encoded and decoded by it; a
difference raises.

Defined cases: a NULL text counts as empty, and an empty text is the begin and
end ids alone. Any length is allowed; the work is ``n log n`` in the longest
segment. Only the text column is read; all other columns pass through.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quaylake.llm.common import position, ship, tidy, worker_state

MARK = "▁"
#: segments of a generation kept by a worker, and the longest one kept
CACHE_SEGMENTS = 200_000
CACHE_CHARS = 64
#: segments of up to so many characters have their agendas in a matrix
SHORT = 64
#: rank of a pair that forms no piece
_NEVER = 1 << 30
_PAIR_BITS = 20
#: symbols of a matrix
_CELLS = 1 << 19
#: code points of texts encoded together
CHUNK_CHARS = 2_000_000


class MergeVocabulary:
    """Pieces, scores and byte fallback of a sentencepiece BPE model file."""

    def __init__(self, model_path: str, check: bool = True):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.sp, self.check = sp, check
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes_id: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.text: list[bytes] = []
        for i, piece in enumerate(pieces):
            if sp.is_byte(i):
                self.bytes_id[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i):
                self.text.append(b"")
            elif sp.is_unknown(i):
                self.text.append(" ⁇ ".encode())
            else:
                if sp.is_unused(i):
                    raise ValueError("unused pieces are not supported")
                self.ids[piece] = i
                self.cost[piece] = -sp.get_score(i)
                self.text.append(piece.replace(MARK, " ").encode())
        self.controls = frozenset(i for i in range(size) if sp.is_control(i))
        self.unk, self.bos, self.eos = sp.unk_id(), sp.bos_id(), sp.eos_id()
        self.by_words = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.by_lines = self.by_words and not any("\n" in p for p in self.ids)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._rank_pairs()

    def _rank_pairs(self) -> None:
        """Sorted keys of the pairs of pieces that form one, with the rank of its
        score. Symbols are single characters or pieces, so no other pair ever
        merges. Pieces of equal score have no rank of their own; a segment that
        could hold one (by the characters they are made of) is left to the heap."""
        ids = self.ids
        by_score = sorted(ids, key=lambda p: (self.cost[p], ids[p]))
        self.of_rank = np.array([ids[p] for p in by_score] or [0], np.int32)
        self.ranked = len(self.text) < 1 << _PAIR_BITS and all(c in ids for p in ids for c in p)
        pairs = {}
        for rank, piece in enumerate(by_score if self.ranked else ()):
            for at in range(1, len(piece)):
                a, b = ids.get(piece[:at]), ids.get(piece[at:])
                if a is not None and b is not None:
                    pairs[a << _PAIR_BITS | b] = rank
        keys = np.array(sorted(pairs) + [1 << 62])
        self.pair_keys = keys
        self.pair_ranks = np.array([pairs.get(k, _NEVER) for k in keys.tolist()], np.int32)
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        formed = [p for p in by_score if len(p) > 1]
        even = [x for p, q in zip(formed, formed[1:], strict=False) if self.cost[p] == self.cost[q] for x in (p, q)]
        self.even_chars = sorted({ord(c) for p in even for c in p})
        self.even_length = min(map(len, even), default=1)

    # ------------------------------------------------------------ encoding
    def merge_all(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment (its spaces already written as marks), four bytes each."""
        out: list[bytes | None] = [None] * len(segments)
        if self.ranked:
            by_length: dict[int, list[int]] = {}
            for at, s in enumerate(segments):
                if len(s) <= SHORT:
                    by_length.setdefault(len(s), []).append(at)
            for length, places in by_length.items():
                step = max(1, _CELLS // max(1, length))
                for lo in range(0, len(places), step):
                    self._merge_matrix(segments, length, places[lo : lo + step], out)
        return [np.array(self._merge_heap(s), "<u4").tobytes() if x is None else x for s, x in zip(segments, out, strict=True)]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs (a, b)."""
        wanted = a.astype(np.int64) << _PAIR_BITS | b
        at = np.searchsorted(self.pair_keys, wanted)
        return np.where(self.pair_keys[at] == wanted, self.pair_ranks[at], np.int32(_NEVER))

    def _merge_matrix(self, segments: list[str], length: int, places: list[int], out: list) -> None:
        """Ids of segments of one length, at their places in ``out``; those with unknown
        characters or pieces of equal score are passed over."""
        if not length:
            return
        code = np.frombuffer("".join([segments[p] for p in places]).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length)
        sym = self.char_ids[code]
        fit = (sym >= 0).all(axis=1)
        if self.even_chars:
            fit &= np.isin(code, self.even_chars).sum(axis=1) < self.even_length
        sym, row = sym[fit], np.array(places)[fit]
        agenda = self._rank(sym[:, :-1], sym[:, 1:])
        while len(row):
            if not agenda.shape[1]:
                done = np.ones(len(row), bool)
            else:
                i = agenda.argmin(axis=1)  # the leftmost of the best
                best = np.take_along_axis(agenda, i[:, None], 1)[:, 0]
                done = best == _NEVER
            raw, width = sym[done].astype("<u4").tobytes(), 4 * sym.shape[1]
            for n, p in enumerate(row[done].tolist()):
                out[p] = raw[n * width : (n + 1) * width]
            if done.all():
                return
            sym, agenda, row, i, best = sym[~done], agenda[~done], row[~done], i[~done], best[~done]
            # each row loses one symbol and one pair
            here, n = np.arange(len(row)), sym.shape[1] - 1
            piece = self.of_rank[best]
            cols = np.arange(n)
            sym = np.take_along_axis(sym, cols + (cols > i[:, None]), 1)
            sym[here, i] = piece
            cols = np.arange(n - 1)
            agenda = np.take_along_axis(agenda, cols + (cols >= i[:, None]), 1) if n > 1 else agenda[:, :0]
            left, right = i > 0, i < n - 1
            agenda[here[left], i[left] - 1] = self._rank(sym[here[left], i[left] - 1], piece[left])
            agenda[here[right], i[right]] = self._rank(piece[right], sym[here[right], i[right] + 1])

    def _merge_heap(self, segment: str) -> list[int]:
        cost, sym = self.cost, list(segment)
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            c = cost.get(sym[i] + sym[i + 1])
            if c is not None:
                agenda.append((c, i, 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, length = heapq.heappop(agenda)
            left = sym[i]
            j = after[i]
            if not left or j >= n or len(left) + len(sym[j]) != length:
                continue  # one of the two has been merged meanwhile
            left = sym[i] = left + sym[j]
            sym[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                c = cost.get(left + sym[k])
                if c is not None:
                    heapq.heappush(agenda, (c, i, length + len(sym[k])))
            h = before[i]
            if h >= 0:
                c = cost.get(sym[h] + left)
                if c is not None:
                    heapq.heappush(agenda, (c, h, len(sym[h]) + length))
        out: list[int] = []
        for s in sym:
            if s:
                i = self.ids.get(s)
                if i is not None:
                    out.append(i)
                elif self.bytes_id:
                    out.extend(self.bytes_id[b] for b in s.encode())
                else:
                    out.append(self.unk)
        return out

    def segments(self, text: str) -> list[str]:
        """Keys of the segments: a word that a space (or the start) precedes,
        or a line feed and what follows it. Keys that begin with a mark stand
        for themselves (runs of spaces, marks in the text)."""
        if not self.by_words:
            return [MARK + text.replace(" ", MARK)]
        plain = not (MARK in text or "  " in text or text[0] == " ")
        if plain and self.by_lines:
            return text.replace("\n", " \n").split(" ") if "\n" in text else text.split(" ")
        return [s for s in re.findall(f"{MARK}*[^{MARK}]*", MARK + text.replace(" ", MARK)) if s]

    def key_text(self, key: str) -> str:
        if key[:1] == MARK or (key[:1] == "\n" and self.by_lines):
            return key
        return MARK + key

    def learn(self, keys: set[str]) -> dict[str, bytes]:
        """Encode segments not seen before; each is checked with the library."""
        new = list(keys)
        found = self.merge_all([self.key_text(k) for k in new])
        if self.check and new:
            # the library writes a mark before whatever it is given
            asked = [k[1:].replace(MARK, " ") if k[:1] == MARK else k for k in new]
            theirs = self.sp.encode(asked, num_threads=1)
            for n, k in enumerate(new):
                if k[:1] == "\n" and self.by_lines:
                    theirs[n] = theirs[n][1:]
                elif k in ("", MARK):
                    theirs[n] = [self.ids[MARK]]  # the library encodes an empty text as nothing
            sizes = [4 * len(x) for x in theirs]
            flat = np.fromiter(chain.from_iterable(theirs), "<u4", sum(sizes) // 4)
            if sizes != list(map(len, found)) or flat.tobytes() != b"".join(found):
                told = [np.array(x, "<u4").tobytes() for x in theirs]
                k = next(k for k, x, y in zip(new, found, told, strict=True) if x != y)
                raise ValueError(f"segment {k!r} differs from the library's encoding")
        return dict(zip(new, found, strict=True))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without begin and end."""
        if len(self.known) > CACHE_SEGMENTS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        parts = [self.segments(t) if t else [] for t in texts]
        new = set().union(*parts).difference(known)
        if older:
            again = [s for s in new if s in older]
            known.update((s, older[s]) for s in again)
            new.difference_update(again)
        learnt = self.learn(new)
        once = {k: v for k, v in learnt.items() if len(k) > CACHE_CHARS}
        known.update((k, v) for k, v in learnt.items() if len(k) <= CACHE_CHARS)
        if once:
            out = [b"".join([once[s] if s in once else known[s] for s in p]) for p in parts]
        else:
            out = [b"".join(map(known.__getitem__, p)) for p in parts]
        if self.check:
            self._check_whole(next(((t, ids) for t, ids in zip(texts, out, strict=True) if t), None))
        return out

    def _check_whole(self, encoded: tuple[str, bytes] | None) -> None:
        """Encoding and decoding of one whole text, by the library."""
        if encoded is None:
            return
        ids = [int.from_bytes(encoded[1][i : i + 4], "little") for i in range(0, len(encoded[1]), 4)]
        if self.sp.encode(encoded[0]) != ids:
            raise ValueError("a whole text differs from the library's encoding")
        if self.sp.decode(ids) != self.decode(ids):
            raise ValueError("a whole text differs from the library's decoding")

    # ------------------------------------------------------------ decoding
    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library's ``decode``."""
        try:
            # a control piece ends a run of byte pieces, though it has no text
            broken = not self.controls.isdisjoint(ids[1:-1])
            out = self._decode_loose(ids) if broken else b"".join(map(self.text.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            out = self._decode_loose(ids)
        first = next((i for i in ids if self.text[i]), None)
        if first is not None and out[:1] == " " and not self.sp.is_byte(first) and first != self.unk:
            out = out[1:]  # the mark that encoding put before the text
        return out

    def _decode_loose(self, ids: list[int]) -> str:
        """Bytes that form no character become one replacement character each."""
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for width in (4, 3, 2, 1):
                    try:
                        c = bytes(run[at : at + width]).decode()
                    except UnicodeDecodeError:
                        continue
                    if len(c) == 1:
                        out.append(c)
                        at += len(c.encode())
                        break
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if self.sp.is_byte(i):
                run += self.text[i]
            else:
                flush()
                out.append(self.text[i].decode())
        flush()
        return "".join(out)


def vocabulary(model_path: str, check: bool = True) -> MergeVocabulary:
    """The vocabulary of a model file, loaded once per worker."""
    return worker_state(("pieces", model_path, check), lambda: MergeVocabulary(model_path, check))


def _chunks(batch, text_at: int) -> Iterator:
    """Slices of an Arrow batch with a bounded amount of text (one row at least)."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.utf8_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > begin and total + n > CHUNK_CHARS:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if batch.num_rows > begin:
        yield batch.slice(begin)


def encode_texts(
    df: DataFrame,
    model_path: str,
    text_col: str = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
    check: bool = True,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Encode ``text_col`` with begin and end ids and decode the ids again.

    ``outputs`` names the added columns: ``ids`` (array of int), ``n_tokens``,
    ``ids_sha256``, ``decoded``, ``decoded_sha256``. A column of that name in the
    input is replaced; the others pass through (or only those in ``keep``).
    """
    import pyarrow as pa

    ship(df.sparkSession)
    kinds = {
        "ids": T.ArrayType(T.IntegerType()),
        "n_tokens": T.LongType(),
        "ids_sha256": T.StringType(),
        "decoded": T.StringType(),
        "decoded_sha256": T.StringType(),
    }
    fields = df.schema.fields
    places = [i for i, f in enumerate(fields) if f.name not in outputs and (keep is None or f.name in keep)]
    kept = [fields[i] for i in places]
    text_at = position(df, text_col)
    # columns go through the tasks by place, whatever their names are
    inner = [f"_c{i}" for i in range(len(kept))]
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(inner, kept, strict=True)])
    schema = T.StructType(schema.fields + [T.StructField(o, kinds[o]) for o in outputs])
    want_text = bool({"decoded", "decoded_sha256"} & set(outputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path, check)
        begin, end = v.bos.to_bytes(4, "little"), v.eos.to_bytes(4, "little")
        for whole in batches:
            for batch in _chunks(whole, text_at):
                cols: dict[str, list] = {o: [] for o in outputs}
                for ids in v.encode_batch(batch.column(text_at).to_pylist()):
                    ids = begin + ids + end
                    decoded = v.decode(np.frombuffer(ids, "<u4").tolist()) if want_text else ""
                    for o in outputs:
                        cols[o].append(
                            ids
                            if o == "ids"
                            else len(ids) // 4
                            if o == "n_tokens"
                            else sha256(ids).hexdigest()
                            if o == "ids_sha256"
                            else decoded
                            if o == "decoded"
                            else sha256(decoded.encode()).hexdigest()
                        )
                arrays = [batch.column(i) for i in places]
                for o in outputs:
                    if o == "ids":
                        offsets = np.cumsum([0, *(len(x) // 4 for x in cols[o])]).astype(np.int32)
                        numbers = np.frombuffer(b"".join(cols[o]), "<i4")
                        arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers)))
                    else:
                        arrays.append(pa.array(cols[o], pa.int64() if o == "n_tokens" else pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [*inner, *outputs])

    plain = df.toDF(*[f"_c{i}" for i in range(len(fields))])
    return plain.mapInArrow(tidy(run), schema).toDF(*[f.name for f in kept], *outputs)
