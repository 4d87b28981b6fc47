"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A document's features are which n-grams it has: words and word pairs as they
are, and the shapes of one to three words in a row (case, last character,
repeat of the word before). An indicator is scaled by the logarithm of the
ratio of its smoothed counts in the two classes; on the scaled vectors, brought
to unit length, a linear hinge-loss model is fitted by dual coordinate descent.
(Wang and Manning, "Baselines and Bigrams", 2012; Hsieh et al., "A Dual
Coordinate Descent Method for Large-scale Linear SVM", 2008.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.llm.tables import map_batches
from podium.llm.words import chunks, hash_words, mix, text_bytes, words_of
from podium.operators import free_name

# Labelled documents that a model is fitted on at most; about 4 KB each on the driver.
MAX_FIT_DOCUMENTS = 8_000
# Indicators are hashed to so many features.
FEATURES = 1 << 18
THRESHOLD = 0.3
_SMOOTHING = 1.0
_COST = 1.0
_EPOCHS = 12
# Share of the weights in the interpolation with their mean size.
_BETA = 0.5


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts


def _classes_of_bytes() -> np.ndarray:
    kind = np.full(256, 6, np.uint64)  # beyond ASCII
    kind[:128] = 5  # other ASCII
    kind[ord("0") : ord("9") + 1] = 1
    kind[ord("a") : ord("z") + 1] = 2
    kind[ord("A") : ord("Z") + 1] = 3
    for i, c in enumerate(b".,!?;:*&%$#|-_@/"):
        kind[c] = 8 + i
    return kind


_KIND = _classes_of_bytes()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature of every n-gram, repeats included, and where each text's start, plus the end."""
    raw, offsets = text_bytes(texts)
    starts, ends, first = words_of(raw, offsets)
    words = hash_words(raw, starts, ends)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    follows = np.zeros(len(words), bool)
    follows[1:] = text[1:] == text[:-1]
    repeats = np.zeros(len(words), np.uint64)
    if len(words) > 1:
        repeats[1:] = (words[1:] == words[:-1]) & follows[1:]
    shapes = np.zeros(0, np.uint64)
    if len(words):
        second = np.minimum(starts + 1, ends - 1)
        before_last = np.maximum(ends - 2, starts)
        shapes = mix(
            _KIND[raw[starts]]
            + np.uint64(32) * _KIND[raw[second]]
            + np.uint64(1024) * _KIND[raw[before_last]]
            + np.uint64(32768) * _KIND[raw[ends - 1]]
            + np.uint64(1 << 20) * repeats
        )
    every: list[np.ndarray] = []
    owner: list[np.ndarray] = []

    def add(hashes: np.ndarray, of: np.ndarray, view: int) -> None:
        every.append((mix(hashes + np.uint64(view)) % np.uint64(FEATURES)).astype(np.int32))
        owner.append(of)

    pairs = follows[1:] if len(words) else follows
    triples = pairs[1:] & pairs[:-1] if len(words) > 1 else follows[:0]
    three = np.uint64(3)
    add(words, text, 1)
    add((words[:-1] * three + words[1:])[pairs], text[1:][pairs], 2)
    add(shapes, text, 3)
    add((shapes[:-1] * three + shapes[1:])[pairs], text[1:][pairs], 4)
    add(
        ((shapes[:-2] * three + shapes[1:-1]) * three + shapes[2:])[triples], text[2:][triples], 5
    )
    flat, of = np.concatenate(every), np.concatenate(owner)
    order = np.argsort(of, kind="stable")
    return flat[order], np.searchsorted(of[order], np.arange(len(counts) + 1))


def _distinct(indices: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """The distinct values, by where each was seen last; ``stamp`` is scratch space."""
    at = np.arange(len(indices), dtype=np.int32)
    stamp[indices] = at
    return indices[stamp[indices] == at]


@dataclass(frozen=True)
class Model:
    """Scaled weights, squared scales, and the logistic curve over the margin."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: pa.Array, stamp: np.ndarray) -> np.ndarray:
        flat, first = features(texts)
        out = np.empty(len(first) - 1)
        for i in range(len(out)):
            own = _distinct(flat[first[i] : first[i + 1]], stamp)
            length = np.sqrt(float(self.squares[own].sum())) or 1.0
            out[i] = float(self.weights[own].sum()) / length + self.bias
        return out

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1 given the margin (Platt)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (target - p))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def _views(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Views of so many values each. One large array goes back to the system as soon as it is
    free; thousands of small ones stay with the driver's process for good."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return [flat[end - size : end] for end, size in zip(ends, sizes)]


def _indicators(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The distinct feature indices of each document, copied out of Arrow's buffers."""
    sizes = (pc.binary_length(column).to_numpy() // 4).tolist()
    views = _views(np.empty(sum(sizes), np.int32), sizes)
    for view, own in zip(views, column):
        view[:] = np.frombuffer(own.as_buffer(), np.int32)
    return views


def fit(indicators: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on distinct feature indices per document and labels 0 and 1.

    Four fifths give the ratios and the weights, one fifth the logistic curve.
    With labels of one class only, or none, every document scores their smoothed share.
    """
    labels = np.asarray(labels, np.int64)
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        zero = np.zeros(FEATURES, np.float32)
        return Model(zero, zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    for_curve = np.arange(len(labels)) % 5 == 4
    if len(np.unique(labels[~for_curve])) < 2 or len(np.unique(labels[for_curve])) < 2:
        for_curve = np.ones(len(labels), bool)
    train = np.flatnonzero(~for_curve) if not for_curve.all() else np.arange(len(labels))

    counts = np.full((2, FEATURES), _SMOOTHING)
    for i in train:
        counts[labels[i], indicators[i]] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    # A feature that no document has tells nothing.
    ratios[(counts == _SMOOTHING).all(axis=0)] = 0.0

    sign = 2.0 * labels - 1.0
    share = np.bincount(labels[train], minlength=2) / len(train)
    cost = _COST * 0.5 / share[labels]
    weights, bias = np.zeros(FEATURES), 0.0
    alpha = np.zeros(len(labels))
    rows = _views(np.empty(sum(len(indicators[i]) for i in train)), [len(indicators[i]) for i in train])
    rows = dict(zip(train, rows))
    for i in train:
        x = ratios[indicators[i]]
        np.divide(x, np.sqrt(x @ x) or 1.0, out=rows[i])
    rng = np.random.default_rng(0)
    for _ in range(_EPOCHS):
        for i in rng.permutation(train):
            own, x = indicators[i], rows[i]
            gradient = sign[i] * (weights[own] @ x + bias) - 1.0
            now = min(max(alpha[i] - gradient / (x @ x + 1.0), 0.0), cost[i])
            if now != alpha[i]:
                step = (now - alpha[i]) * sign[i]
                weights[own] += step * x
                bias += step
                alpha[i] = now
    weights = (1 - _BETA) * np.abs(weights).sum() / max(1, np.count_nonzero(weights)) + _BETA * weights
    scaled = (weights * ratios).astype(np.float32)
    squares = (ratios * ratios).astype(np.float32)
    model = Model(scaled, squares, bias, 1.0, 0.0)
    held = np.flatnonzero(for_curve)
    margins = np.array(
        [
            scaled[own].sum() / (np.sqrt(float(squares[own].sum())) or 1.0) + bias
            for own in (indicators[i] for i in held)
        ]
    )
    slope, offset = _logistic(margins, labels[held])
    return Model(model.weights, model.squares, bias, slope, offset)


def train(
    docs: DataFrame, labels: DataFrame, *, folds: int = 5, most: int = MAX_FIT_DOCUMENTS
) -> Model:
    """Fit ``labels.quality`` on the text of ``docs`` outside of fold 0.

    At most ``most`` labelled documents, those with the smallest hashes of
    their ids, are joined by broadcast and read whole. Null labels and ids are
    left out; an id with several labels has the smallest.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("quality").alias("_quality"))
        .where(F.col("_id").isNotNull())
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))

    def indicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stamp = np.zeros(FEATURES, np.int32)
        for batch in batches:
            for part in chunks(batch):
                flat, first = features(part.column(part.schema.get_field_index("text")))
                own = [
                    np.sort(_distinct(flat[first[i] : first[i + 1]], stamp)).tobytes()
                    for i in range(part.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        part.column(part.schema.get_field_index("_quality")),
                        pa.array(own, pa.binary()),
                    ],
                    names=["doc_id", "quality", "own"],
                )

    # Rows that repeat an id are in the sample as often; it is cut again below.
    sample = rows.mapInArrow(indicate, "doc_id bigint, quality int, own binary")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("own")).limit(most).toArrow()
    indicators, marks = _indicators(sample["own"]), (sample["quality"].to_numpy() > 0).astype(np.int64)
    del sample
    return fit(indicators, marks)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, the chance of label 1; any columns, such named ones replaced.

    Only ``text`` is an input of the score; a null text scores as an empty one,
    by the bias alone. One pass, no exchange.
    """
    return _scored(docs.drop("score"), model, "score")


def _scored(docs: DataFrame, model: Model, name: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, stamp = shared.value, np.zeros(FEATURES, np.int32)
        for batch in batches:
            for part in chunks(batch):
                texts = part.column(part.schema.get_field_index("text"))
                values = pa.array(own.scores(own.margins(texts, stamp)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, values], names=[*part.schema.names, name]
                )

    return map_batches(docs, add, [T.StructField(name, T.DoubleType())])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row: 1 at a score of ``THRESHOLD`` or more."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, on: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, with their own columns.

    The model is fitted on ``on`` (default ``docs``).
    """
    model = train(docs if on is None else on, labels)
    name = free_name(docs.columns, "_score")
    return _scored(docs, model, name).where(F.col(name) >= THRESHOLD).drop(name)
