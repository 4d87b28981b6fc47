"""Piece ids against the sentencepiece library, and round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from podium.llm import piece_codec
from podium.llm.piece_codec import PieceCodec, decode_documents, encode_documents

from .helpers import awkward, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return PieceCodec(PATH)


ODD = [
    "  a", "a  ", "\n\n x", "日本語 テキスト 😀😀 ￿ a", "▁▁x ▁", "\0a b", "é" * 300, "aaaa" * 50, "x" * 1000 + " y",
    " ", "     ", "<s> </s> <unk> <0x41>", "ﬁ ①", "a\tb", "ー" * 70, "��", "", None, "tail ", "the" * 4000,
]


def random_texts(n=600):
    r = random.Random(1)
    return ["".join(r.choice("ab ▁\n日😀theing'.,é́") for _ in range(r.randrange(1, 200))) for _ in range(n)]


def ids_of(found):
    ids, ends, wrong = found
    assert not wrong
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_ids_equal_the_library(own, library):
    texts = ODD + random_texts()
    want = library.encode([t or "" for t in texts])
    assert ids_of(own.encode_batch(texts, check=True)) == want
    regular = [t for t in texts if t is None or not t or ("  " not in t and t[-1] != " " and "▁" not in t)]
    assert ids_of(own.encode_batch(regular, check=True)) == library.encode([t or "" for t in regular])
    assert ids_of(own.encode_batch([])) == [] and ids_of(own.encode_batch([None, ""])) == [[], []]
    # From the cache.
    assert ids_of(own.encode_batch(texts, check=True)) == want


def test_the_check_finds_differing_parts(monkeypatch):
    own = PieceCodec(PATH)
    right = own._encode_segments
    monkeypatch.setattr(
        own, "_encode_segments", lambda parts: [b"\5\0\0\0" if p == "▁cat" else ids for p, ids in zip(parts, right(parts))]
    )
    for _ in range(2):
        wrong = own.encode_batch(["a dog", "a cat, a dog", "cat"], check=True)[2]
        assert wrong == {1, 2} and "▁cat" not in own.parts


def test_the_heap_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "_WIDTHS", (1,))
    texts = random_texts(150) + ["a long word of allmostanything"]
    assert ids_of(PieceCodec(PATH).encode_batch(texts)) == library.encode(texts)


def test_a_small_cache_gives_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHE_PARTS", 2)
    small = PieceCodec(PATH)
    for text in ["the cat and the dog", "dog and cat", "the bird"] * 4:
        assert ids_of(small.encode_batch([text])) == library.encode([text])


def test_any_ids_decode_as_the_library_does(own, library):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.randrange(len(own.text)) if r.random() < 0.5 else r.randrange(262) for _ in range(r.randrange(12))]
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids), ids


@pytest.mark.parametrize("check", ["parts", "texts"])
def test_documents_round_trip(spark, library, check):
    rows = awkward() + [(100 + k, t) for k, t in enumerate(ODD)]
    docs = frame(spark, rows, clashes=True)
    out = decode_documents(encode_documents(docs, PATH, check=check), PATH)
    assert out.columns == [*docs.columns, "ids", "ids_agree", "decoded", "text_agrees"]
    got = sorted((str(r.doc_id), r.text or "", tuple(r.ids), r.decoded) for r in out.collect())
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((str(i), t or "", tuple(ids), library.decode(ids)))
    assert got == sorted(want)
    assert out.where("NOT (ids_agree AND text_agrees)").count() == 0


def test_no_check_and_no_documents(spark):
    out = decode_documents(encode_documents(frame(spark, [(1, "a b")]), PATH, check=None), PATH, check=False)
    row = out.head()
    assert row.decoded == "a b" and row.ids_agree is None and row.text_agrees is None
    assert decode_documents(encode_documents(frame(spark, []), PATH), PATH).count() == 0


def test_a_null_list_decodes_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r.decoded for r in decode_documents(df, PATH).collect()] == ["", ""]


def test_query_digests(spark, library, tmp_path):
    from podium.llm.queries import QUERIES

    rows = [(1, "Hello  world\n"), (2, None), (3, "é日")]
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op13_piece_codec"](spark, str(tmp_path)).collect()}
    for i, t in rows:
        ids = library.encode(t or "")
        assert got[i].n_tokens == len(ids) and got[i].agrees
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
