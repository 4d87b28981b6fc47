from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from podium.llm import set_join
from podium.llm.components import components
from pyspark.sql import functions as F

from .helpers import CLASHES, awkward, brute_components, frame, prose, shingles


def near_copies(seed, bases=6, copies=14, length=120):
    """Groups of near copies, with similarities on both sides of the limits."""
    rng = random.Random(seed)
    texts = []
    for _ in range(bases):
        base = prose(rng, length, 900).split()
        for k in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                words[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
            cut = rng.choice([0, 0, 3])
            texts.append(" ".join(words[cut:]))
    rng.shuffle(texts)
    return list(enumerate(texts))


def expected(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    label = brute_components(sets, percent)
    smallest = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            smallest[c] = min(smallest.get(c, i), i)
    return Counter(
        (i, len(s), smallest.get(c) if s else i) for (i, _), s, c in zip(rows, sets, label)
    )


def got(df, n, percent):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in set_join.set_components(df, n, percent).collect())


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2)])
def test_components_equal_brute_force(spark, n, percent, seed):
    rows = near_copies(seed) + [(i + 500 if i is not None else None, t) for i, t in awkward()]
    want = expected(rows, n, percent)
    assert len({c for _, _, c in want}) > 20
    assert got(frame(spark, rows, clashes=True), n, percent) == want


def test_long_lists_are_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(set_join, "CELL", 4)
    monkeypatch.setattr(set_join, "_LEADERS", 0)
    rows = near_copies(3, bases=2, copies=20)
    assert got(frame(spark, rows), 3, 90) == expected(rows, 3, 90)


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 6), (5, 80, 7), (3, 100, 8)])
def test_long_lists_are_indexed_by_differences(spark, monkeypatch, n, percent, seed):
    monkeypatch.setattr(set_join, "HOT", 2)
    monkeypatch.setattr(set_join, "_LEADERS", 0)
    rows = near_copies(seed, bases=3, copies=20) + [(i + 500 if i is not None else None, t) for i, t in awkward()]
    assert got(frame(spark, rows), n, percent) == expected(rows, n, percent)


@pytest.mark.parametrize("with_base", [True, False])
def test_pairs_of_a_large_group_just_under_the_limit(spark, monkeypatch, with_base):
    rng = random.Random(9)
    base = prose(rng, 100, 900).split()
    texts = [" ".join(base)] * with_base
    for k in range(400):
        words = list(base)
        for at in rng.sample(range(100), rng.choice([1, 2, 2, 3])):
            words[at] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    made, write = Counter(), set_join.materialize

    def counted(df, name, **options):
        out = write(df, name, **options)
        made[name] = max(made[name], out.count())
        return out

    monkeypatch.setattr(set_join, "materialize", counted)
    assert got(frame(spark, rows), 3, 90) == expected(rows, 3, 90)
    # A group of 400 has 79800 pairs.
    assert made["pairs"] < 4000
    assert made["candidates"] < 4000


def test_unrelated_sets_of_a_long_list_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(set_join, "HOT", 8)
    monkeypatch.setattr(set_join, "_LEADERS", 0)
    # No n-gram counts as frequent, so all sets have some of the common ones in their prefixes.
    monkeypatch.setattr(set_join, "frequent_grams", lambda docs, n: np.zeros(0, np.uint64))
    rng = random.Random(12)
    common, texts = prose(rng, 30, 900), []
    for k in range(120):
        # Some are twenty times as long as others.
        own = [f"w{rng.randrange(10**9)}" for _ in range(60 if k % 10 else 1200)]
        texts.append(" ".join([common, *own]))
        if k % 4 == 0:
            own[30] = "other"
            texts.append(" ".join([common, *own]))
    rows = list(enumerate(texts))
    made, write = Counter(), set_join.materialize

    def counted(df, name, **options):
        out = write(df, name, **options)
        made[name] += out.count()
        return out

    monkeypatch.setattr(set_join, "materialize", counted)
    assert got(frame(spark, rows), 3, 90) == expected(rows, 3, 90)
    # Each list has 150 sets, of which one is near the reference at most.
    assert made["hot-lists"] > 0 and made["differences"] < 30
    assert made["candidates"] < 100


@pytest.mark.parametrize("n, m, shared", [(90, 90, 88), (700, 650, 600), (3000, 40, 30), (5, 1, 0)])
def test_sketches_differ_no_more_than_sets(n, m, shared):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n + m, dtype=np.uint64)
    a, b = keys[:n], np.concatenate([keys[:shared], keys[n : n + m - shared]])
    x, y = set_join._sketch(a), set_join._sketch(b)
    for size in (min(len(x), len(y)), set_join.ENTRY_SKETCH):
        differ = np.bitwise_count(set_join._folded(x, size) ^ set_join._folded(y, size)).sum()
        assert differ <= n + m - 2 * shared
    assert len(set_join._folded(x, set_join.ENTRY_SKETCH)) == set_join.ENTRY_SKETCH
    # Sets that share nothing are told apart.
    assert np.bitwise_count(x ^ set_join._sketch(keys[:n] ^ np.uint64(1))).sum() > 0.7 * n


def test_frequent_grams_change_no_result(spark, monkeypatch):
    monkeypatch.setattr(set_join, "FREQUENT", 3)
    rows = near_copies(4, bases=2)
    assert got(frame(spark, rows), 3, 90) == expected(rows, 3, 90)


def test_one_of_each_group_stays(spark):
    rows = near_copies(2) + [(i + 500 if i is not None else None, t) for i, t in awkward()]
    df = frame(spark, rows, clashes=True)
    kept = set_join.keep_one(df, 5, 80)
    assert kept.columns == df.columns
    out = kept.collect()
    assert all(r[c] == f"own {c}" for r in out for c in CLASHES)
    sets = [shingles(t, 5) for _, t in rows]
    label = brute_components(sets, 80)
    empty = Counter((i, t) for (i, t), s in zip(rows, sets) if not s)
    assert Counter((r.doc_id, r.text) for r in out if not shingles(r.text, 5)) == empty
    groups = {}
    for (i, t), s, c in zip(rows, sets, label):
        if s:
            groups.setdefault(c, []).append((i is None, i or 0, t))
    firsts = sorted(min(g)[:2] for g in groups.values())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out if shingles(r.text, 5)) == firsts


def peak_mb(fn):
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def cell_of(sizes):
    """One cell of sets in different components; a block for each size, of so many sets."""
    n = np.concatenate([np.full(count, size) for size, count in sizes.items()])
    ids = np.arange(len(n))
    same = {c: 0 for c in ("reference", "gram", "cell_a", "cell_b", "own", "pos")}
    return pd.DataFrame({**same, "n": n, "size": n, "cid": ids, "component": ids})


@pytest.mark.parametrize("held", [1, 7, 50, 1 << 18])
def test_pairs_of_a_cell_come_in_parts(monkeypatch, held):
    monkeypatch.setattr(set_join, "PAIRS", held)
    frames = list(set_join._block_pairs(cell_of({100: 9, 101: 1, 104: 30, 300: 2}), 80))
    got = Counter((a, b) for f in frames for a, b in zip(f["a"], f["b"]))
    want = [(a, b) for b in range(40) for a in range(b)] + [(40, 41)]
    assert got == Counter(want)
    # A row is not cut: its pairs are at most those of the largest block.
    assert max(map(len, frames)) < 2 * max(held, 30)


def test_pairs_of_a_long_list_are_not_held_together():
    rows, count = cell_of({100: 2000, 101: 1500}), []
    assert peak_mb(lambda: count.extend(map(len, set_join._block_pairs(rows, 80)))) < 60
    assert sum(count) == 3500 * 3499 // 2


def test_workers_hold_little_beside_a_batch():
    rng = random.Random(11)
    texts = [prose(rng, 400, 10**6) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array(texts)], names=["doc_id", "text"])
    frequent, seen = set_join.Lookup(np.zeros(0, np.uint64)), []
    assert peak_mb(lambda: seen.extend(len(k) for _, k in set_join._sets(batch, 5, frequent))) < 30
    assert seen == [396] * 1500


def test_counted_grams_are_those_met_often_enough(spark, monkeypatch):
    texts = ["a b c", "a b c d", "x a b c", "b c d", "b c d b c d", "q r s", "q r s", None, ""]
    df = frame(spark, enumerate(texts)).coalesce(1)
    words, first = set_join.word_hashes(pa.array(["a b c", "b c d", "q r s"]))
    a, b, _ = set_join.ngram_hashes(words, first, 3)[0]
    assert set_join.frequent_grams(df, 3).tolist()[0] == b and set(set_join.frequent_grams(df, 3)) == {a, b}
    # All are held apart, and a text that has more is counted by itself.
    monkeypatch.setattr(set_join, "_COUNTED", 1)
    monkeypatch.setattr(set_join, "SLICE_BYTES", 1)
    again = frame(spark, [(1, "a b c " * 4), (2, "b c d"), (3, "b c d"), (4, "b c d")]).coalesce(1)
    assert a in set_join.frequent_grams(again, 3) and b not in set_join.frequent_grams(again, 3)


def test_empty_table(spark):
    assert set_join.set_components(frame(spark, [])).count() == 0
    assert set_join.keep_one(frame(spark, [])).count() == 0


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 50)]
    edges += [(300, 300), (302, 301), (301, 302), (None, 4), (5, None)]
    df = spark.createDataFrame(edges, "x bigint, y bigint")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {
        **{i: 0 for i in range(61)}, **{200 + i: 200 for i in range(50)}, 301: 301, 302: 301}
    assert components(df.where(F.lit(False))).count() == 0
