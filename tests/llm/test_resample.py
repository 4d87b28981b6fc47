"""Importance resampling against a plain version, and the selection against a sort."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from podium.llm import resample

from .helpers import awkward, frame, lower, prose

BUCKETS = 10_000


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def plain_buckets(text):
    w = plain_words(text)
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % BUCKETS for r in runs]


def plain_ranks(rows, target, percent=5):
    source, wanted = Counter(), Counter()
    features = [plain_buckets(t) for _, t in rows]
    for f in features:
        source.update(f)
    for t in target:
        wanted.update(plain_buckets(t))
    n_source, n_wanted = sum(source.values()), sum(wanted.values())

    def gain(b):
        ratio = (wanted[b] + 1) * (n_source + BUCKETS) / ((source[b] + 1) * (n_wanted + BUCKETS))
        return math.floor(1000 * math.log(ratio))

    out = []
    for (i, t), f in zip(rows, features):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, f))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
    may = [k for k, (_, t) in enumerate(rows) if len(plain_words(t)) >= 20]
    may.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for rank, k in enumerate(may[: percent * len(may) // 100], 1):
        out[k][4] = rank
    return out


def as_rows(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def documents(seed=3, n=300):
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randrange(1, 60), 60)) for i in range(100, 100 + n)]
    # Copies: equal weights, told apart by their ids' noise.
    rows += [(1000 + i, rows[0][1] + " " + rows[1][1]) for i in range(60)]
    return rows + [r for r in awkward() if r[0] is not None or r[1] != "no id at all"]


def test_ranks_equal_the_plain_version(spark):
    rng = random.Random(9)
    rows = documents()
    # An id and a text that repeat tie in all: which row has which rank does not show.
    target = [prose(rng, 40, 30) for _ in range(12)] + [None, "", "Ünï W1 W1 w1"]
    docs = frame(spark, rows, clashes=True)
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = as_rows(resample.importance_ranks(docs, items, percent=20))
    assert got == sorted(map(tuple, plain_ranks(rows, target, 20)), key=str)


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert resample.importance_ranks(none, items).count() == 0
    rows = documents(n=40)
    got = as_rows(resample.importance_ranks(frame(spark, rows), items))
    assert got == sorted(map(tuple, plain_ranks(rows, [])), key=str)


def test_drawn_documents_keep_their_columns(spark):
    rows = documents()
    rows += [rows[0]] * 30
    rows = [(i, f"{t} " * 3 if t else t) for i, t in rows]
    docs = frame(spark, rows, clashes=True)
    items = spark.createDataFrame([(0, rows[3][1])], "item_id bigint, text string")
    drawn = resample.resampled(docs, items, percent=30)
    assert drawn.columns == [*docs.columns, "rank"]
    got = drawn.collect()
    texts = Counter(rows)
    assert all(n <= texts[k] for k, n in Counter((r.doc_id, r.text) for r in got).items())
    n = sum(len(plain_words(t)) >= 20 for _, t in rows)
    assert sorted(r["rank"] for r in got) == list(range(1, 30 * n // 100 + 1))


def test_checksums_of_grams():
    texts = ["a", "Ab " * 3, None, "", "x" * 300 + " y " + "é" * 80 + " z", "1.2-3 — ok", "-", "q\x00r"]
    texts.append("long" * 5000 + " tail word")
    grams, _, first = resample.gram_buckets(pa.array(texts, pa.string()), 1 << 31)
    got = Counter(np.concatenate(grams).tolist())
    want = Counter()
    for t in texts:
        w = plain_words(t)
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                want[zlib.crc32(" ".join(w[i : i + n]).encode()) % (1 << 31)] += 1
    assert got == want
    assert np.diff(first).tolist() == [len(plain_words(t)) for t in texts]


@pytest.mark.parametrize("kind", ["spread", "one score", "two scores"])
def test_quickselect_finds_every_place(spark, tmp_path, kind):
    rng = random.Random(4)
    score = {"spread": lambda: rng.randrange(-(10**9), 10**9), "one score": lambda: 7, "two scores": lambda: rng.choice([1, 2])}
    n = 3000
    rows = [(-score[kind](), i % 40 == 0, None if i % 40 == 0 else rng.randrange(300), rng.randrange(5), i) for i in range(n)]
    keys = spark.createDataFrame(rows, "below bigint, no_id boolean, doc_id bigint, tie bigint, row_no bigint")
    keys = keys.repartition(5).cache()
    in_order = sorted(rows, key=resample._sortable)
    for number, k in enumerate([1, 2, 1499, n]):
        assert resample.kth_key(keys, n, k, f"{tmp_path}/{number}") == in_order[k - 1]
