"""Token files and packing: exact round trips against the library."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from podium.llm import packing
from podium.llm.token_files import read_token_files, token_files, write_token_files
from podium.llm.tokens import WordEncoder
from tokenizers import Tokenizer

from .helpers import awkward, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


ODD = [
    "a  b", "  a", " a\n b", "\n\na b", "a \nb c\n\n\nd", "it's we'll, don't. o'", "<|endoftext|> x",
    "x\ty \t z", "a,.\nb!! ñ,, 1,2 3.4-5 12,", "a\n", "\na", "ab.,\n cd", "é.\n\nÉ", "a\r\nb c\r\n", "",
    "x1, y2. z²! ª, a_ _b,", "日本。 語, x", "a  b   c", None,
]


def test_word_cache_equals_the_library(plain):
    encoder = WordEncoder(PATH, 2, "<u2")
    for text in ODD * 2:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == plain(text), text


def test_a_small_cache_gives_the_same_ids(plain, monkeypatch):
    monkeypatch.setattr("podium.llm.tokens.CACHE_WORDS", 3)
    encoder = WordEncoder(PATH, 2, "<u4")
    for text in ["the cat, the dog and the cat. sat", "dog, the\ncat sat on"] * 3:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain(text)


def test_files_hold_all_ids_in_order(spark, plain, tmp_path):
    rows = awkward()
    manifest = write_token_files(frame(spark, rows, clashes=True), str(tmp_path), PATH, 2)
    parts = sorted(manifest.collect())
    ids = np.concatenate([np.fromfile(f"{tmp_path}/{p.path}.bin", "<u2") for p in parts])
    docs = np.concatenate([np.fromfile(f"{tmp_path}/{p.path}.idx", "<i8").reshape(-1, 3) for p in parts])
    order = [None if null else i for i, null, _ in docs.tolist()]
    assert order == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    read = {(r.doc_id, r.start): r for r in read_token_files(manifest, str(tmp_path)).collect()}
    assert len(read) == len(rows)
    want, got = Counter(), Counter()
    for i, t in rows:
        want[(i, tuple(plain(t)))] += 1
    for (i, start), r in read.items():
        own = ids[start : start + r.n_tokens]
        assert r.ids_crc32 == zlib.crc32(own.astype("<u4").tobytes())
        got[(i, tuple(own.tolist()))] += 1
    assert got == want
    assert sum(r.n_tokens for r in read.values()) == len(ids)


def test_no_documents_no_files(spark):
    assert token_files(frame(spark, []), PATH).count() == 0
    assert packing.pack_documents(frame(spark, []), PATH).count() == 0


def test_piece_lengths():
    for n in (1, 5, 1023, 1024, 1025, 2048, 5000):
        pieces = packing.piece_lengths(n)
        assert sum(pieces) == n and all(p == 1024 for p in pieces[1:]) and 0 < pieces[0] <= 1024


def test_bounds_hold_and_certify():
    rng = random.Random(2)
    for trial in range(60):
        lengths = np.array([rng.randint(1, 1024) for _ in range(rng.randint(1, 300))])
        bins, offsets, fill = packing.best_fit_decreasing(lengths)
        bound = packing.lower_bound(lengths)
        assert bound <= len(fill) and fill.max() <= 1024
        assert bound >= -(-lengths.sum() // 1024)
    # 600 alone in each sequence, whatever the sum says.
    assert packing.lower_bound(np.full(10, 600)) == 10
    assert packing.lower_bound(np.full(9, 342)) == 5


def check_packing(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return sequences


def test_documents_are_packed_whole(spark, plain):
    rows = awkward()
    packed = packing.pack_documents(frame(spark, rows, clashes=True), PATH).collect()
    check_packing(packed)
    want, got = Counter(), Counter()
    for i, t in rows:
        ids, start = plain(t), 0
        for piece, length in enumerate(packing.piece_lengths(len(ids))):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            want[(i, piece, start, length, crc)] += 1
            start += length
    for r in packed:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    assert got == want


@pytest.mark.parametrize("per_partition", [10, 40, 10_000])
def test_exchange_between_partitions_saves_sequences(spark, per_partition):
    rng = random.Random(1)
    lengths = [rng.randint(1, 1024) for _ in range(600)]
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing._PIECES)
    alone = len(check_packing(packing.best_fit_pack(pieces, per_partition=per_partition, rounds=0).collect()))
    packed = packing.best_fit_pack(pieces, per_partition=per_partition).collect()
    assert sorted(r.rid for r in packed) == list(range(600))
    together = len(check_packing(packed))
    bound = packing.lower_bound(np.array(lengths))
    assert bound <= together <= alone
    assert together <= 1.03 * bound + 2 if per_partition >= 40 else True


def test_certificate_and_lengths_that_fit_no_sequence(spark):
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate([600] * 9 + [424] * 9 + [1024] * 2)]
    packed = packing.best_fit_pack(spark.createDataFrame(rows, packing._PIECES), per_partition=7)
    n = len(check_packing(packed.collect()))
    assert packing.certificate(packed) == (n, 11) and n <= 13
    whole = packing.best_fit_pack(spark.createDataFrame(rows, packing._PIECES))
    assert packing.certificate(whole) == (11, 11)
    assert {r.partition_gap for r in whole.collect()} == {0}
    assert packing.certificate(whole.limit(0)) == (0, 0)
    for wrong in (None, 0, 1025):
        bad = spark.createDataFrame([*rows, (99, 99, 0, 0, wrong, 0)], packing._PIECES)
        with pytest.raises(ValueError, match="1 pieces"):
            packing.best_fit_pack(bad)


def test_every_round_keeps_all_pieces(spark):
    rng = random.Random(3)
    rows = [(i, i, 0, 0, rng.choice([200, 300, 350, 500, 700, 900]), 0) for i in range(500)]
    pieces = spark.createDataFrame(rows, packing._PIECES)
    totals = []
    for rounds in (0, 1, 3, 40):
        packed = packing.best_fit_pack(pieces, per_partition=25, rounds=rounds).collect()
        assert sorted(r.rid for r in packed) == list(range(500))
        totals.append(len(check_packing(packed)))
    assert totals == sorted(totals, reverse=True)
