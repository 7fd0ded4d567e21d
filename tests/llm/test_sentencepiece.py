"""The merge agenda against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest

from quaylake.llm.catalog import op8_sentencepiece
from quaylake.llm.sentencepiece_bpe import MergeVocabulary, encode_texts

from ..conftest import SF0001

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return MergeVocabulary(MODEL, check=False)


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


HARD = ["", " ", "  a", "a  ", "▁", "▁x ▁▁ y▁z", "<s>hi</s><unk><0x41>", "a\nb", "\n", "\n\n x", "a \nb", "\x00\x01", "é😀梦", "a\t b\r\n", "aaaa" * 60, "no " * 5]


def test_hard_texts(vocabulary):
    for t, raw in zip(HARD, vocabulary.encode_batch(HARD)):
        assert ids_of(raw) == vocabulary.sp.encode(t), repr(t)
        whole = [1, *ids_of(raw), 2]
        assert vocabulary.decode(whole) == vocabulary.sp.decode(whole), repr(t)


def test_random_texts_and_ids(vocabulary):
    rng = random.Random(4)
    texts = ["".join(rng.choice(" \n▁aàe.tTh1😀梦") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    assert [ids_of(r) for r in vocabulary.encode_batch(texts)] == vocabulary.sp.encode(texts)
    for _ in range(1500):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 7))]
        assert vocabulary.decode(ids) == vocabulary.sp.decode(ids), ids


def test_matrix_and_heap_agree_with_the_library(vocabulary):
    rng = random.Random(8)
    words = ["".join(rng.choice("eeeeaattnhrsé") for _ in range(rng.randint(1, 75))) for _ in range(4000)]
    words += ["a" * n for n in range(1, 80)] + ["x梦y", "😀"]
    keys = [vocabulary.key_text(w) for w in words]
    merged = [ids_of(x) for x in vocabulary.merge_all(keys)]
    assert vocabulary.ranked and merged == vocabulary.sp.encode(words) == [vocabulary._merge_heap(k) for k in keys]
    odd = ["▁" * n for n in range(1, 60)] + ["", "\n\n", "▁▁a", "a▁▁", "▁" * 17 + "b", "\ud800"]
    got = [None] * len(odd)
    for n, s in enumerate(odd):
        vocabulary._merge_matrix(odd, len(s), [n], got)
    assert all(x is None or ids_of(x) == vocabulary._merge_heap(s) for s, x in zip(odd, got))
    assert got[0] is not None and got[1:59] == [None] * 58  # runs of marks have equal scores


def test_two_generations_of_segments(vocabulary, monkeypatch):
    monkeypatch.setattr("quaylake.llm.sentencepiece_bpe.CACHE_SEGMENTS", 20)
    v = MergeVocabulary(MODEL)
    asked = []
    learn = v.learn
    v.learn = lambda keys: asked.append(len(keys)) or learn(keys)
    for n in range(12):
        texts = ["common words here " + " ".join(f"w{n}x{i}" for i in range(15))]
        assert [ids_of(r) for r in v.encode_batch(texts)] == v.sp.encode(texts)
        assert len(v.known) + len(v.older) <= 2 * (20 + 19)
    assert asked[0] >= 18 and set(asked[1:]) == {15}  # the common words are never learnt again


def test_a_wrong_decoding_raises():
    v = MergeVocabulary(MODEL)
    v.text[v.ids["▁this"]] = b"that"
    with pytest.raises(ValueError, match="decoding"):
        v.encode_batch(["is this so"])


def test_very_long_segment(vocabulary):
    text = "ab" * 20000
    assert ids_of(vocabulary.encode_batch([text])[0]) == vocabulary.sp.encode(text)


def test_a_difference_raises():
    v = MergeVocabulary(MODEL)
    v.cost, v.pair_ranks = {}, v.pair_ranks[::-1].copy()
    with pytest.raises(ValueError, match="library"):
        v.encode_batch(["this that"])


def test_defined_cases(spark, docs_of, clashing):
    rows = [(1, None), (2, ""), (2, ""), (None, "Hello\nworld")]
    got = encode_texts(clashing(rows), MODEL).collect()
    assert sorted((str(r["doc_id"]), list(r["ids"])[:2], r["decoded"]) for r in got) == sorted(
        [("1", [1, 2], ""), ("2", [1, 2], ""), ("2", [1, 2], ""), ("None", list(got[[r["doc_id"] for r in got].index(None)]["ids"])[:2], "Hello\nworld")]
    )
    assert got[0]["count"] == "count"
    assert encode_texts(docs_of([]), MODEL).count() == 0


def test_query(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    rows = op8_sentencepiece(spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = sp.encode(docs[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
