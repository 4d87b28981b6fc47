"""Quality classifier and language model."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from podium.llm import brown, nbsvm

from .helpers import CLASHES, awkward, frame, prose, words


def labelled(n=300, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = prose(rng, rng.randrange(10, 80))
        good = rng.random() < 0.7
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "*** "), " ".join([text.split()[0]] * 30)])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    rows, labels = labelled()
    got = nbsvm.classify(frame(spark, rows, clashes=True), label_frame(spark, labels)).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_labels_of_the_held_out_fold_have_no_effect(spark):
    rows, labels = labelled()
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a = nbsvm.classify(frame(spark, rows), label_frame(spark, labels)).collect()
    b = nbsvm.classify(frame(spark, rows), label_frame(spark, flipped)).collect()
    assert {r.doc_id: r.score for r in a} == pytest.approx({r.doc_id: r.score for r in b})


def test_awkward_documents_and_labels(spark):
    rows, labels = labelled(60)
    rows = [(i + 1000, t) for i, t in rows] + awkward()
    labels = [(i + 1000, q, t) for i, q, t in labels]
    labels += [(None, 1, 0), (5, None, 0), (1003, 0, 1), (1003, 1, 0), (99999, 1, 0)]
    got = nbsvm.classify(frame(spark, rows, clashes=True), label_frame(spark, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    df = frame(spark, rows, clashes=True)
    kept = nbsvm.keep_good(df, label_frame(spark, labels))
    assert kept.columns == df.columns
    assert all(r[c] == f"own {c}" for r in kept.collect() for c in CLASHES)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0), (3, 1, 0)]])
def test_without_two_classes_all_score_the_share(spark, labels):
    got = nbsvm.classify(frame(spark, awkward()), label_frame(spark, labels)).collect()
    assert len({r.score for r in got}) == 1
    assert nbsvm.classify(frame(spark, []), label_frame(spark, labels)).count() == 0


def test_descent_reaches_the_hinge_optimum():
    """On separable data the margins of the fitted model have the labels' signs."""
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 200)
    own = [np.unique(np.r_[rng.integers(10, 400, 20), y]).astype(np.int32) for y in labels]
    model = nbsvm.fit(own, labels)
    margin = [model.weights[x].sum() / np.sqrt(model.squares[x].sum()) + model.bias for x in own]
    assert np.mean((np.array(margin) > 0) == labels) > 0.97


_LEFT_BEHIND = """
import io
import re
import numpy as np
import pyarrow as pa
from podium.llm import nbsvm

def held():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\\s+(\\d+)", f.read())[1]) / 1024

rng = np.random.default_rng(0)
labels = rng.integers(0, 2, 8000)
stream = io.BytesIO()
with pa.ipc.new_stream(stream, pa.schema({"own": pa.binary()})) as writer:
    for _ in range(16):
        own = [rng.integers(0, nbsvm.FEATURES, 1000, np.int32).tobytes() for _ in range(500)]
        writer.write_batch(pa.record_batch({"own": pa.array(own, pa.binary())}))
stream = stream.getvalue()
del own, writer
before = held()
sample = pa.ipc.open_stream(io.BytesIO(stream)).read_all()
indicators = nbsvm._indicators(sample["own"])
assert all(a.tobytes() == b.as_py() for a, b in zip(indicators, sample["own"]))
del sample
nbsvm.fit(indicators, labels)
del indicators
print(held() - before)
"""


def test_fitting_leaves_no_memory_with_the_driver():
    """The pipeline's later stages run in the same driver process."""
    run = subprocess.run([sys.executable, "-c", _LEFT_BEHIND], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(nbsvm.__file__)) + "/..", check=True)
    assert float(run.stdout) < 16


def test_indicators_of_empty_documents_and_tables():
    column = pa.chunked_array([pa.array([b"", np.arange(3, dtype=np.int32).tobytes(), b""], pa.binary())])
    assert [x.tolist() for x in nbsvm._indicators(column)] == [[], [0, 1, 2], []]
    assert nbsvm._indicators(pa.chunked_array([], pa.binary())) == []


# --- language model ----------------------------------------------------------


def test_base_scores_equal_the_formula(spark):
    rows = awkward() + [(100 + i, prose(random.Random(i), 60)) for i in range(40)]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*words(t), "\0end"])
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        tokens = [*words(t), "\0end"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want[(i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6))] += 1
    got = Counter()
    for r in brown.score_documents(frame(spark, rows, clashes=True)).collect():
        got[(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))] += 1
        assert r.score < 0 and math.isfinite(r.score)
    assert got == want


def test_rare_counts_are_joined_alike(spark, monkeypatch):
    """With hardly any word broadcast, all else the same, scores do not change."""
    rows = [(i, prose(random.Random(i), 60)) for i in range(60)]
    monkeypatch.setattr(brown, "CLUSTERED", 20)
    a = {r.doc_id: r for r in brown.score_documents(frame(spark, rows)).collect()}
    # Counts are close together: some words are above the bin that this admits, others below.
    monkeypatch.setattr(brown, "FREQUENT", 200)
    b = {r.doc_id: r for r in brown.score_documents(frame(spark, rows)).collect()}
    for i, r in a.items():
        assert (r.n_known, r.n_tokens) == (b[i].n_known, b[i].n_tokens)
        assert r.base_score == pytest.approx(b[i].base_score) and r.score == pytest.approx(b[i].score)


def test_rare_words_of_awkward_texts_are_joined_alike(spark, monkeypatch):
    """Empty texts, repeated ids and rare words that occur often in one text."""
    rows = awkward() + [(100 + i, f"once{i} w1 twice{i} once{i} w2 " * 3) for i in range(40)]
    monkeypatch.setattr(brown, "CLUSTERED", 20)

    def scored():
        got = brown.score_documents(frame(spark, rows)).collect()
        return sorted(
            (r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
            for r in got
        )

    want = scored()
    monkeypatch.setattr(brown, "FREQUENT", 60)
    assert scored() == want and len(want) == len(rows)


def test_rows_are_joined_to_classes_without_the_hashes_of_their_words(spark, monkeypatch):
    """The rows' join moves places and classes only, and no other join runs beside it."""
    rows = [(i, prose(random.Random(i), 60) + f" once{i}") for i in range(30)]
    monkeypatch.setattr(brown, "CLUSTERED", 30)
    monkeypatch.setattr(brown, "FREQUENT", 100)
    written, keep = {}, brown.materialize

    def spy(df, name, **options):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        out = keep(df, name, **options)
        written[name] = (df.columns, plan, out.inputFiles())
        return out

    monkeypatch.setattr(brown, "materialize", spy)
    assert brown.score_documents(frame(spark, rows)).count() == 30
    columns, plan, _ = written["classed"]
    assert columns == ["doc_id", "held_out", "places", "joined"]
    # Once, in the list of the file's columns.
    assert plan.count("rare#") == 1 and plan.count("Join ") == 1 and "Aggregate" not in plan
    for name in ("coded", "classed"):
        assert written[name][2] and all(".zstd." in f for f in written[name][2])


def test_classes_beat_single_words_on_held_out_text(spark):
    """Two kinds of words that alternate: their classes predict each other."""
    rng = random.Random(0)
    rows = []
    for i in range(200):
        line = [f"{'ab'[k % 2]}{rng.randrange(40)}" for k in range(80)]
        rows.append((i, " ".join(line)))
    got = [r for r in brown.score_documents(frame(spark, rows)).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    gain = (sum(r.score for r in got) - sum(r.base_score for r in got)) / tokens
    assert gain > 0.25  # log10 2 = 0.30 is what knowing the kind is worth


def test_probabilities_of_a_context_sum_to_one(spark):
    rows = [(i, prose(random.Random(i), 60)) for i in range(30)]
    model, counts = brown.fit(frame(spark, rows))
    assert np.allclose((10.0 ** model.transitions).sum(1), 1)
    for shape in range(brown.SHAPES):
        own = [r.c for r in counts.collect() if r["shape"] == shape]
        clustered = [c for c, s in zip(model.counts[: len(model.classes)], model.shapes) if s == shape]
        rare = list((Counter(own) - Counter(clustered)).elements())
        c = np.array([0, *rare])
        assert (10 ** model.emission(c, np.full(len(c), shape))).sum() == pytest.approx(1)


def held_out_gain(spark, rows):
    got = [r for r in brown.score_documents(frame(spark, rows)).collect() if r.held_out]
    return sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)


@pytest.mark.parametrize("frequent", [250, 300_000])
def test_words_beyond_the_clustered_ones_get_classes_by_exchange(spark, monkeypatch, frequent):
    """Kinds alternate and all words have one shape: only exchange tells a rarer word's kind."""
    monkeypatch.setattr(brown, "CLUSTERED", 180)
    monkeypatch.setattr(brown, "FREQUENT", frequent)
    rng = random.Random(0)
    pick = lambda: rng.randrange(10, 100) if rng.random() < 0.6 else rng.randrange(100, 400)
    rows = [(i, " ".join(f"{'ab'[k % 2]}{pick()}" for k in range(80))) for i in range(400)]
    assert held_out_gain(spark, rows) > 0.2


def test_clusters_sum_to_one_with_words_of_all_counts(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTERED", 30)
    monkeypatch.setattr(brown, "FREQUENT", 100)
    rows = [(i, prose(random.Random(i), 60) + f" once{i}") for i in range(30)]
    model, _, joined = brown._fit(frame(spark, rows).selectExpr("doc_id", "false held_out", "text"))
    share, seen = Counter(), {}
    for batch in joined.toArrow().to_batches():
        c, _, own, first = model.words.of(batch)
        texts = dict(rows)
        for k, i in enumerate(batch.column(0).to_pylist()):
            for j, w in zip(range(first[k], first[k + 1]), words(texts[i])):
                seen[w] = (c[j], own[j])
    assert Counter({w: c for w, (c, _) in seen.items()}) == Counter(w for _, t in rows for w in words(t))
    for c, own in seen.values():
        assert own < brown.CLASSES
        share[own] += 10 ** model.emission(np.array(c), np.array(own))
    assert all(v == pytest.approx(1) for v in share.values())


def test_the_best_cluster_of_a_word_is_that_of_the_whole_likelihood():
    rng = np.random.default_rng(1)
    table = rng.integers(0, 30, (brown._N, brown._N)).astype(float)

    def likelihood(t):
        x = lambda v: (v * np.log(np.maximum(v, 1e-9))).sum()
        return x(t) - x(t.sum(1)) - x(t.sum(0))

    owner = np.repeat(np.arange(30), rng.integers(1, 60, 30))
    before, after = rng.integers(0, brown._END, (2, len(owner))) // rng.integers(1, 20, (2, len(owner)))
    want = []
    for w in range(30):
        own = owner == w
        scores = []
        for k in range(brown.CLASSES):
            t = table.copy()
            np.add.at(t, (before[own], k), 1)
            np.add.at(t, (k, after[own]), 1)
            scores.append(likelihood(t) - likelihood(table))
        want.append(np.array(scores))
    # Rows and columns of the word's own neighbours grow alike for all clusters, but for those among them.
    gains = brown._Gains(table)
    gains.AT_ONCE = 64
    best, counts = gains.best(owner, (before + 256 * after).astype("<u2"))
    assert list(counts) == list(np.bincount(owner))
    for w, k in enumerate(best):
        own = owner == w
        margin = np.zeros(brown.CLASSES)
        # The neighbours' own margins, which the move of one word does not change.
        for side, axis in ((before[own], 1), (after[own], 0)):
            sums = table.sum(axis)
            for j in range(brown.CLASSES):
                grown = sums.copy()
                np.add.at(grown, side, 1)
                own_sums = sums.copy()
                own_sums[j] += own.sum()
                both = grown.copy()
                both[j] += own.sum()
                f = lambda v: (v * np.log(np.maximum(v, 1e-9))).sum()
                margin[j] += f(both) - f(own_sums)
        fixed = want[w] + margin
        assert fixed[k] >= fixed.max() - 1e-6


def test_words_of_one_count_beyond_the_list_are_clustered(spark, monkeypatch):
    """No list of all words from some count on is short enough; the first ones still move together."""
    monkeypatch.setattr(brown, "CLUSTERED", 150)
    monkeypatch.setattr(brown, "FREQUENT", 160)
    rng = random.Random(0)
    rows = []
    for i in range(200):
        kinds = [rng.sample(range(10, 100), 90) for _ in "ab"]
        rows.append((i, " ".join(f"a{x} b{y}" for x, y in zip(*kinds))))
    assert held_out_gain(spark, rows) > 0.2


def test_no_training_rows(spark):
    assert brown.score_documents(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = brown.score_documents(frame(spark, [(held, "a b")])).head()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == 0
