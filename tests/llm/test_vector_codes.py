"""Vector codes against Lloyd rounds that compare every entry."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from podium.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows if fine(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        own = [[nearest(p, c[p])[1] for c in cut] for p in range(parts)]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own[p]) if o == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    text = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, sum(x for x, r in zip(errors, kept) if r[2] == label), digest)
        for (i, _, label), f, e in zip(kept, found, errors)
    ]


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.selectExpr("*", "'own' AS id", "'own' AS code", "1 AS error", "2 AS n")
    out = vc.coded_with_errors(df, **options)
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, dim, seed=1, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("n, dim, spread", [(400, 8, 0.3), (300, 16, 0.01), (3, 4, 1.0), (260, 4, 0.002)])
def test_codes_equal_the_plain_version(spark, n, dim, spread):
    rows = vectors(n, dim, spread=spread)
    assert coded(spark, rows) == sorted(plain(rows), key=str)


def test_awkward_vectors(spark):
    rows = vectors(120, 8)
    rows += [(500, None, 1), (501, [], 1), (502, [1.0] * 7 + [None], 0), (503, [1.0] * 7 + [float("nan")], 0)]
    rows += [(504, [1.0] * 7 + [float("inf")], 0), (505, [1.0] * 4, 0), (None, [0.5] * 8, None), (7, [0.25] * 8, 1)]
    # Copies, ties between entries, and a label with a third of all rows.
    rows += [(600 + k, rows[3][1], 9) for k in range(60)] + [(700, [0.0] * 8, 1), (701, [-0.0] * 8, 1)]
    rows += [(i, [(i % 2) / 1024.0] * 8, 4) for i in range(800, 830)]
    assert coded(spark, rows, entries=16) == sorted(plain(rows, entries=16), key=str)


def test_no_vectors_and_wrong_shapes(spark):
    assert coded(spark, []) == []
    assert coded(spark, [(1, None, 2)]) == []
    with pytest.raises(ValueError, match="equal parts"):
        coded(spark, [(1, [1.0] * 6, 2)])
    with pytest.raises(ValueError, match="hex"):
        coded(spark, [(1, [1.0] * 4, 2)], entries=300)


@pytest.mark.parametrize("spread", [1, 40, 400])
def test_trees_cover_and_assign_whole_subtrees(spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(-2000, 2000, (20, 3))
    points = centres[rng.integers(0, 20, 3000)] + rng.integers(-spread, spread + 1, (3000, 3))
    tree = vc.CoverTree.build(points)
    assert sorted(tree.order.tolist()) == list(range(3000))
    for i in range(len(tree.start)):
        own = points[tree.order[tree.start[i] : tree.end[i]]]
        assert np.sqrt(((own - own[0]) ** 2).sum(axis=1)).max() <= tree.radius[i] + 1e-9
    entries = np.concatenate([centres, centres[:4], centres[:4] + 1])
    found, ranges = np.full(3000, -1), 0
    for first, last, entry in tree.assign(points, entries):
        ranges += len(first)
        for a, b, e in zip(first, last, entry):
            assert (found[tree.order[a:b]] == -1).all()
            found[tree.order[a:b]] = e
    gaps = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (found == gaps.argmin(axis=1)).all()
    if spread == 40:
        assert ranges < 1500


def test_large_numbers_stay_exact():
    points = np.array([[2**40, 5], [2**40 + 1, 5]])
    assert vc.squared(points, np.array([[2**40, 4]])).tolist() == [[1], [2]]
