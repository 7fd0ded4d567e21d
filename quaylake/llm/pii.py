"""Personal data in texts: exact base patterns and a BiLSTM-CRF tagger.

Base spans (e-mail, IP, card, phone) come from fixed patterns. A character
level bidirectional LSTM with CRF transitions is trained in numpy on labelled
spans of a bounded sample of documents: the pattern matches, and the same
documents with their matches rewritten in ways that the patterns miss. The
rewriting (``varied``) is a seeded generator: words or brackets for the signs of
an address, blanks around dots, dashes, slashes or dots inside numbers, national
prefixes. The tagger adds such spans where they pass the check of their kind
(form of an address, numbers of digits, Luhn sum, byte range). It reads
overlapping windows: every window that holds a digit, an ``@`` or a word for it
(no span of the four kinds is without one), so whole texts are covered. Each
character takes its tag from the window in which it is most central, the tags
of a text are joined to spans, and a span that touches a base span of its
kind gives way to it.

Offsets are code points, the end exclusive. All searches are linear in the
text, also for very long runs of one character class.

Defined cases: a NULL text counts as empty and has no spans; without any match
in the sample there is no model and only base spans are found; repeated
rows are tagged alike.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import only, ship, tidy

# Fixed values of the contract: kinds in their order, and the patterns below.
KINDS = ("email", "ip", "card", "phone")
#: documents looked at for training, and training windows, at most
SAMPLE_DOCS = 20_000
SAMPLE_WINDOWS = 8_000
WINDOW, STRIDE = 64, 32
HIDDEN = 24
STEPS = 800
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({]\s?(?:at|AT)\s?[\])}]| AT ")
_AT = r"(?:@|[\[({]\s?(?:at|AT)\s?[\])}]|(?<= )AT(?= ))"
_DOT = r"(?:\.|[\[({]\s?(?:dot|DOT)\s?[\])}]|(?<= )DOT(?= ))"
_ADDRESS = re.compile(rf"[A-Za-z0-9._%+-]+ ?{_AT} ?[A-Za-z0-9-]+(?: ?{_DOT} ?[A-Za-z0-9-]+)+")

Span = tuple[int, int, int]  # kind, start, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1  # no match can reach across this sign
        at = text.find("@", max(done, at + 1))


def holds(kind: int, found: str) -> bool:
    """The check that a span of a kind has to pass."""
    if kind == 0:
        return _ADDRESS.fullmatch(found) is not None
    parts = re.findall("[0-9]+", found)
    if kind == 1:
        return len(parts) == 4 and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in parts)
    digits = "".join(parts)
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def _vary(kind: int, found: str, rng: random.Random) -> str:
    """A span rewritten so that its pattern misses it."""
    if kind == 0:
        at, dot = rng.choice([("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" AT ", " DOT "), ("{at}", "."), (" @ ", "."), (" (at) ", "."), (" @ ", " . ")])
        local, domain = found.split("@", 1)
        return local + at + domain.replace(".", dot)
    parts = re.findall("[0-9]+", found)
    if kind == 1:
        return rng.choice([" . ", "-", " .", ". ", "[.]", "(.)"]).join(parts)
    digits = "".join(parts)
    if kind == 2:
        return rng.choice([".", "/", "  ", " - ", "_"]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
    head, groups = digits[:2], [g for g in (digits[2:5], digits[5:8], digits[8:]) if g]
    if len(digits) > 13 or rng.random() < 0.3:
        return "+" + "/".join([head, *groups])  # other signs after a plus are in the pattern
    return "00" + rng.choice(["-", " ", "/", "."]).join([head, *groups])


def _fresh(kind: int, rng: random.Random) -> str:
    """A new value of a kind."""
    some = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    letters = "abcdefghijklmnopqrstuvwxyz"
    if kind == 0:
        local = some(rng.randint(1, 8), letters) + rng.choice(["", ".", "_", "-", "9", "42"]) + some(rng.randint(1, 6), letters)
        return local + "@" + ".".join([some(rng.randint(2, 9), letters) + rng.choice(["", "7"])] + rng.choice([["com"], ["org"], ["co", "uk"], ["example", "net"]]))
    if kind == 1:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        head = some(rng.choice([12, 14, 15, 15, 15, 18]), "0123456789")
        return next(head + c for c in "0123456789" if _luhn(head + c))
    return "+" + some(1, "123456789") + some(rng.randint(8, 11), "0123456789")


#: what stands near numbers and is no personal data
_DECOYS = ("in 2024", "12 pages", "1. 2", "(3)", "10:30", "200 000", "3.5 %", "no. 7,", "1-2", "at noon", "1999/2000")


def varied(text: str, spans: list[Span], seed: int) -> tuple[str, list[Span]]:
    """The text with its spans rewritten, half of them with a new value, some between
    other numbers, and where they are then; of spans that overlap the first is
    taken. Rewritten spans that the patterns still match are labelled like any
    other."""
    rng = random.Random(seed)
    out, labels, at, size = [], [], 0, 0

    def put(part: str) -> None:
        nonlocal size
        out.append(part)
        size += len(part)

    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < at:
            continue
        put(text[at:s])
        if rng.random() < 0.3:
            put(rng.choice(_DECOYS) + " ")
        new = _vary(kind, _fresh(kind, rng) if rng.random() < 0.5 else text[s:e], rng)
        labels.append((kind, size, size + len(new)))
        put(new)
        if rng.random() < 0.5:
            put(rng.choice([",", ".", ")", ";", "\n", " " + rng.choice(_DECOYS), ", " + rng.choice(_DECOYS)]))
        at = e
    return "".join(out) + text[at:], labels


def pattern_spans(text: str) -> list[Span]:
    """All matches of the fixed patterns, by kind and start, whether they pass
    the checks or not."""
    if not _TRIGGER.search(text):
        return []
    spans: list[Span] = [(0, s, e) for s, e in _emails(text)]
    spans += [(1, *m.span()) for m in _IP.finditer(text)]
    spans += [(2, *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13]
    spans += [(3, *m.span()) for m in _PHONE.finditer(text)]
    return spans


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns that pass the check of their kind."""
    return [x for x in pattern_spans(text) if x[0] == 0 or holds(x[0], text[x[1] : x[2]])]


# ------------------------------------------------------------------------- windows
_SINGLE = "@.-+() \n\t_%:/,\"'=[]{}ATDOatdo"


def char_classes(text: str) -> np.ndarray:
    """Class of each code point: padding 0, digit, lower, upper, other letters and
    signs beyond ASCII, signs and letters of their own, other ASCII."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _CLASS[np.minimum(codes, 128)]


def _class_table() -> np.ndarray:
    table = np.full(129, 5, np.uint8)
    table[48:58], table[97:123], table[65:91], table[128] = 1, 2, 3, 4
    for i, c in enumerate(_SINGLE):
        table[ord(c)] = 6 + i
    return table


_CLASS = _class_table()
CLASSES = 6 + len(_SINGLE)


def window_starts(text: str) -> list[int]:
    """Starts of the windows (multiples of the stride) that hold a trigger in
    their span or in the one beside it, so that every trigger has a window
    around it on both sides."""
    near = {m.start() // STRIDE for m in _TRIGGER.finditer(text)}
    blocks = {b + d for b in near for d in (-1, 0)}
    return sorted(b * STRIDE for b in blocks)


def windows_of(classes: np.ndarray, starts: list[int]) -> np.ndarray:
    padded = np.concatenate([np.zeros(STRIDE, np.uint8), classes, np.zeros(WINDOW, np.uint8)])
    at = np.asarray(starts)[:, None] + STRIDE + np.arange(WINDOW)[None, :]
    return padded[at]


def tag_array(n: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(n, np.uint8)
    for kind, s, e in spans:
        if not tags[s:e].any():
            tags[s:e] = 2 + 2 * kind
            tags[s] = 1 + 2 * kind
    return tags


# --------------------------------------------------------------------------- model
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def init_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {}
    for d in "fb":
        p["x" + d] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN))
        p["h" + d] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        p["c" + d] = np.zeros(4 * HIDDEN)
        p["c" + d][HIDDEN : 2 * HIDDEN] = 1.0  # remember by default
    p["out"] = rng.normal(0, 0.2, (2 * HIDDEN, TAGS))
    p["bias"] = np.zeros(TAGS)
    p["move"] = np.zeros((TAGS, TAGS))
    p["first"] = np.zeros(TAGS)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _lstm(p: dict, d: str, x: np.ndarray, keep: bool):
    """States over time (rows of ``x`` are steps); ``keep`` also returns what the
    backward pass needs."""
    steps, batch = x.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    c = np.zeros((batch, HIDDEN), np.float32)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    tape = []
    lifted, weight = p["x" + d] + p["c" + d], p["h" + d]
    for t in range(steps):
        z = lifted[x[t]] + h @ weight
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, h_before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            tape.append((i, f, o, g, before, tc, h_before))
    return out, tape


def _lstm_back(p: dict, d: str, x: np.ndarray, tape: list, dout: np.ndarray, grads: dict) -> None:
    steps, batch = x.shape
    dh = np.zeros((batch, HIDDEN), np.float32)
    dc = np.zeros((batch, HIDDEN), np.float32)
    dz_all = np.empty((steps, batch, 4 * HIDDEN), np.float32)
    gh = np.zeros_like(p["h" + d])
    weight = p["h" + d].T
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h_before = tape[t]
        dh = dh + dout[t]
        dct = dc + dh * o * (1 - tc * tc)
        dz = dz_all[t]
        dz[:, :HIDDEN] = dct * g * i * (1 - i)
        dz[:, HIDDEN : 2 * HIDDEN] = dct * before * f * (1 - f)
        dz[:, 2 * HIDDEN : 3 * HIDDEN] = dh * tc * o * (1 - o)
        dz[:, 3 * HIDDEN :] = dct * i * (1 - g * g)
        gh += h_before.T @ dz
        dh = dz @ weight
        dc = dct * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    hot = np.eye(CLASSES, dtype=np.float32)[x.reshape(-1)]
    grads["x" + d] = hot.T @ flat
    grads["c" + d] = flat.sum(0)
    grads["h" + d] = gh


def emissions(p: dict, windows: np.ndarray, keep: bool = False):
    """Tag scores (steps, batch, tags) of windows (batch, steps)."""
    x = windows.T.astype(np.int64)
    hf, tape_f = _lstm(p, "f", x, keep)
    hb, tape_b = _lstm(p, "b", x[::-1], keep)
    states = np.concatenate([hf, hb[::-1]], axis=2)
    return states @ p["out"] + p["bias"], (x, states, tape_f, tape_b)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def loss_and_grads(p: dict, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Negative log-likelihood per window of the tag sequences, and gradients."""
    e, (x, states, tape_f, tape_b) = emissions(p, windows, keep=True)
    steps, batch, _ = e.shape
    y = tags.T.astype(np.int64)
    alpha = np.empty_like(e)
    alpha[0] = p["first"] + e[0]
    for t in range(1, steps):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + p["move"][None], 1) + e[t]
    log_z = _lse(alpha[-1], 1)
    beta = np.zeros_like(e)
    d_move = np.zeros_like(p["move"])
    for t in range(steps - 2, -1, -1):
        onward = p["move"][None] + (e[t + 1] + beta[t + 1])[:, None, :]
        beta[t] = _lse(onward, 2)
        d_move += np.exp(alpha[t][:, :, None] + onward - log_z[:, None, None]).sum(0)
    marginal = np.exp(alpha + beta - log_z[None, :, None])
    rows = np.arange(batch)
    gold = p["first"][y[0]] + e[0][rows, y[0]]
    d_e = marginal
    first = marginal[0].sum(0)
    for t in range(steps):
        if t:
            gold = gold + p["move"][y[t - 1], y[t]] + e[t][rows, y[t]]
            np.add.at(d_move, (y[t - 1], y[t]), -1)
        d_e[t][rows, y[t]] -= 1
    first -= np.bincount(y[0], minlength=TAGS)
    grads = {"move": d_move / batch, "first": first / batch}
    d_e = (d_e / batch).astype(np.float32)
    grads["out"] = np.tensordot(states, d_e, axes=([0, 1], [0, 1]))
    grads["bias"] = d_e.sum((0, 1))
    d_states = d_e @ p["out"].T
    _lstm_back(p, "f", x, tape_f, d_states[:, :, :HIDDEN], grads)
    _lstm_back(p, "b", x[::-1], tape_b, d_states[::-1, :, HIDDEN:], grads)
    return float((log_z - gold).mean()), grads


def fit(windows: np.ndarray, tags: np.ndarray, steps: int = STEPS, batch: int = 48, seed: int = 7) -> dict:
    """Train by Adam; windows with spans make up half of each batch."""
    rng = np.random.default_rng(seed)
    p = init_model(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    with_span = np.flatnonzero(tags.any(1))
    without = np.flatnonzero(~tags.any(1))
    for step in range(1, steps + 1):
        some = rng.choice(with_span, batch // 2 if len(without) else batch)
        if len(without):
            some = np.concatenate([some, rng.choice(without, batch // 2)])
        _, grads = loss_and_grads(p, windows[some], tags[some])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / steps)) * min(1.0, 5 / max(norm, 1e-9))
        for k, g in grads.items():
            m[k] += 0.1 * (g - m[k])
            v2[k] += 0.01 * (g * g - v2[k])
            p[k] = p[k] - (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


def decode(p: dict, windows: np.ndarray, chunk: int = 512) -> np.ndarray:
    """Best tag sequence (Viterbi) of each window."""
    found = []
    for at in range(0, len(windows), chunk):
        e, _ = emissions(p, windows[at : at + chunk])
        steps, batch, _ = e.shape
        best = p["first"] + e[0]
        back = np.empty((steps, batch, TAGS), np.uint8)
        for t in range(1, steps):
            options = best[:, :, None] + p["move"][None]
            back[t] = options.argmax(1)
            best = options.max(1) + e[t]
        tags = np.empty((batch, steps), np.uint8)
        tags[:, -1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(batch), tags[:, t]]
        found.append(tags)
    return np.concatenate(found) if found else np.empty((0, WINDOW), np.uint8)


# ------------------------------------------------------------------- reconciliation
def reconcile(n: int, starts: list[int], tags: np.ndarray) -> list[Span]:
    """Spans of a text of ``n`` code points from the tags of its windows: each
    character is read in the window in which it is most central."""
    quarter = (WINDOW - STRIDE) // 2
    have = set(starts)
    spans: list[Span] = []
    kind, begun, last = -1, 0, -2

    def close(end: int) -> None:
        nonlocal kind
        if kind >= 0:
            spans.append((kind, begun, end))
        kind = -1

    for s, row in zip(starts, tags, strict=True):
        lo = 0 if s - STRIDE not in have else quarter
        hi = WINDOW if s + STRIDE not in have else WINDOW - quarter
        if last != s + lo:
            close(last)
        part = row[lo:hi]
        if not part.any():
            close(s + lo)
            last = s + hi
            continue
        for i, tag in enumerate(part.tolist(), s + lo):
            if i < 0 or i >= n:
                close(min(max(i, 0), n))
                continue
            k = (tag - 1) // 2 if tag else -1
            if tag == 0 or tag % 2 == 1 or k != kind:
                close(i)
                if tag % 2 == 1:
                    kind, begun = k, i
        last = s + hi
    close(min(last, n))
    return spans


def merge_spans(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    """All base spans, and found ones that pass the check of their kind and touch
    no base span of it."""
    by_kind: dict[int, list[tuple[int, int]]] = {}
    for k, s, e in base:
        by_kind.setdefault(k, []).append((s, e))
    added = [
        (k, s, e)
        for k, s, e in found
        if holds(k, text[s:e]) and not any(s < be and bs < e for bs, be in by_kind.get(k, ()))
    ]
    return sorted(base + added)


def find_spans(texts: list[str | None], model: dict | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    out: list[tuple[list[Span], list[Span]]] = []
    waiting: list[tuple[int, str, list[int]]] = []
    stacks: list[np.ndarray] = []
    for t in texts:
        t = t or ""
        base = base_spans(t)
        starts = window_starts(t) if model is not None else []
        if starts:
            waiting.append((len(out), t, starts))
            stacks.append(windows_of(char_classes(t), starts))
        out.append((base, base))
    if waiting:
        tags, at = decode(model, np.concatenate(stacks)), 0
        for i, t, starts in waiting:
            base = out[i][0]
            out[i] = (base, merge_spans(t, base, reconcile(len(t), starts, tags[at : at + len(starts)])))
            at += len(starts)
    return out


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


# --------------------------------------------------------------------------- Spark
def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """Fit the tagger on spans of the documents with the smallest id hashes."""
    import pyarrow as pa

    ship(docs.sparkSession)
    rows = only(docs, id=id_col, text=text_col)
    ids = rows.select("id").filter("id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)  # bounded by the parameter
    rows = rows.join(F.broadcast(chosen), "id").select("id", "text")

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            xs, ys = [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                spans = pattern_spans(t)
                good = [x for x in spans if holds(x[0], t[x[1] : x[2]])]
                forms = [(t, spans)] + ([varied(t, good, zlib.crc32(t.encode()) + i) for i in range(6)] if good else [])
                for text, labels in forms:
                    starts = window_starts(text)
                    if starts:
                        tags = tag_array(len(text), labels)
                        xs += [w.tobytes() for w in windows_of(char_classes(text), starts)]
                        ys += [w.tobytes() for w in windows_of(tags, starts)]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary())], ["x", "y"])

    cuts = rows.mapInArrow(tidy(cut), "x binary, y binary").distinct()
    kept = cuts.orderBy(F.xxhash64("x", "y"), "x", "y").limit(SAMPLE_WINDOWS).collect()  # bounded likewise
    if not kept:
        return None
    x = np.stack([np.frombuffer(bytes(r["x"]), np.uint8) for r in kept])
    y = np.stack([np.frombuffer(bytes(r["y"]), np.uint8) for r in kept])
    return fit(x, y) if y.any() else None


def tag_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the number of base spans of each kind, and
    ``base_spans`` and ``spans`` (arrays of kind, start, end)."""
    import pyarrow as pa

    ship(docs.sparkSession)
    rows = only(docs, id=id_col, text=text_col)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            found = find_spans(batch.column(1).to_pylist(), model)
            as_rows = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in spans]
            counts = [[sum(k == i for k, _, _ in base) for base, _ in found] for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array(c, pa.int64()) for c in counts]
                + [pa.array([as_rows(b) for b, _ in found], span), pa.array([as_rows(a) for _, a in found], span)],
                ["id", *[f"n_{k}" for k in KINDS], "base_spans", "spans"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    spans = "array<struct<kind: string, start: long, end: long>>"
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    tagged = rows.mapInArrow(tidy(run), f"id {kind}, {counted}, base_spans {spans}, spans {spans}")
    return tagged.withColumnRenamed("id", id_col)
