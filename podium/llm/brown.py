"""Class-based bigram language model with exchange clustering.

All words are assigned to classes by exchange: each moves to the class that
most raises the likelihood of the class bigrams. The most frequent words do so
together, round after round, a part of them at a time, on the driver; each
other word does so on the executors, against the bigrams of their classes. All
bigrams count, with text starts and ends; a word that has no class yet counts
as one of its shape. A word's probability is the probability of its class after
the class before, times its share of its class. Every word leaves a part of its
count to unseen words of its shape, which are classes of their own. (Brown et
al., "Class-Based n-gram Models of Natural Language", 1992; Uszkoreit and
Brants, "Distributed Word Clustering", 2008.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.frequent import most_frequent
from podium.llm.nbsvm import fold
from podium.llm.words import Lookup, chunks, hash_words, lower_bytes, text_bytes, words_of
from podium.sources import materialize, scratch_scope

# Words whose counts and classes are broadcast, 14 bytes each. Those of the others are joined.
FREQUENT = 300_000
# Words that move together, on the driver, and the classes of all words.
CLUSTERED = 8_192
CLASSES = 64
ROUNDS = 12
# A round moves one of so many parts of a permutation; the next permutation follows the last part.
_PARTS = 4
# Classes of unseen words, by shape.
SHAPES = 16
# Classes: clusters, shapes, the end; the start of a text is a context of its own.
_END = CLASSES + SHAPES
_START = _END + 1
_N = _END + 2
_HELD = 4_000_000
_DISCOUNT = 0.75
_TRANSITION = 0.1
# Shares of a token are whole multiples of one in so many, so that their sums are exact.
_UNITS = 1 << 12


def shapes_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape of each word: 0 to 15, from its last byte, length and bytes beyond ASCII."""
    if not len(starts):
        return np.zeros(0, np.int64)
    wide = np.concatenate([[0], np.cumsum(raw >= 128)])
    last = raw[ends - 1]
    mark = np.select(
        [(last == ord(",")), (last == ord(".")), (last < 48) | ((last > 57) & (last < 65))], [1, 2, 3], 0
    )
    return mark + 4 * (wide[ends] > wide[starts]) + 8 * (ends - starts > 8)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every word, and each text's first word plus the end."""
    raw, offsets = text_bytes(texts)
    raw = lower_bytes(raw)
    starts, ends, first = words_of(raw, offsets)
    return hash_words(raw, starts, ends), shapes_of(raw, starts, ends), first


def count_words(train: DataFrame) -> DataFrame:
    """(word, shape, c): how often each word occurs in ``train`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shapes, n_held = [], [], 0

        def counted() -> pa.RecordBatch:
            words, at, times = np.unique(
                np.concatenate(held), return_index=True, return_counts=True
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(words.view(np.int64)),
                    pa.array(np.concatenate(shapes)[at].astype(np.int32)),
                    pa.array(times.astype(np.int64)),
                ],
                names=["word", "shape", "c"],
            )

        for batch in batches:
            for part in chunks(batch):
                words, shape, _ = _words(part.column(part.schema.get_field_index("text")))
                held.append(words)
                shapes.append(shape)
                n_held += len(words)
                if n_held >= _HELD:
                    yield counted()
                    held, shapes, n_held = [], [], 0
        if held:
            yield counted()

    counts = train.select("text").mapInArrow(count, "word bigint, shape int, c bigint")
    return counts.groupBy("word", "shape").agg(F.sum("c").alias("c"))


def _packed(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The bytes of each text's values, which begin at ``first``."""
    offsets = (first * values.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, buffers)


def _unpacked(column: pa.Array, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``_packed`` took: all values, and each text's first plus the end."""
    raw, offsets = text_bytes(column.cast(pa.large_binary()).view(pa.large_string()))
    size = np.dtype(dtype).itemsize
    return np.frombuffer(raw.tobytes(), dtype), offsets // size


def _code(docs: DataFrame, frequent: Lookup) -> DataFrame:
    """(rid, doc_id, held_out, places, rare) of each row of ``docs`` (doc_id, held_out, text).

    ``rid`` numbers the rows; ``places`` has the place of each word in the list,
    or -1 less its shape; ``rare`` the hashes of the words that the list lacks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words, shape, first = _words(part.column(part.schema.get_field_index("text")))
                place = shared.value.find(words)
                out = place < 0
                n_out = np.concatenate([[0], np.cumsum(out)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.get_field_index(c)) for c in ("rid", "doc_id", "held_out")),
                        _packed(np.where(out, -1 - shape, place).astype(np.int32), first),
                        _packed(words[out].view(np.int64), n_out[first]),
                    ],
                    names=["rid", "doc_id", "held_out", "places", "rare"],
                )

    columns = "rid bigint, doc_id bigint, held_out boolean, places binary, rare binary"
    rid = F.monotonically_increasing_id().alias("rid")
    return docs.select(rid, "doc_id", "held_out", "text").mapInArrow(code, columns)


def _sequence(own: np.ndarray, first: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every token with the ends put in, the token before each (``end`` + 1: none), and where words are."""
    ends = np.cumsum(np.diff(first) + 1) - 1
    tokens = np.full(len(own) + len(ends), end)
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word] = own
    context = np.concatenate([[end + 1], tokens[:-1]])
    context[ends[:-1] + 1] = end + 1
    return tokens, context[: len(tokens)], np.flatnonzero(is_word)


def _by_shape(places: np.ndarray, values: np.ndarray, shapes: np.ndarray, above: int) -> np.ndarray:
    """Values of the words that have some, ``above`` and the shape for all others."""
    known = np.concatenate([values, above + shapes[len(values) :], [0]])
    return np.where(places >= 0, known[np.maximum(places, -1)], above - 1 - places)


def _pairs(train: DataFrame, n_words: int, shapes: np.ndarray) -> DataFrame:
    """(left, right, c): all bigrams of coded texts.

    Behind the places of the first ``n_words`` frequent words come the shapes
    of all other words, the end and the start.
    """
    shared = train.sparkSession.sparkContext.broadcast(shapes)
    end = n_words + SHAPES
    size = end + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def counted() -> pa.RecordBatch:
            pairs, times = np.unique(np.concatenate(held), return_counts=True)
            left, right = np.divmod(pairs, size)
            return pa.RecordBatch.from_arrays(
                [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(times)],
                names=["left", "right", "c"],
            )

        for batch in batches:
            for part in chunks(batch, "places"):
                places, first = _unpacked(part.column(0), np.int32)
                own = _by_shape(places, np.arange(n_words), shared.value, n_words)
                tokens, context, _ = _sequence(own, first, end)
                held.append(context * size + tokens)
                n_held += len(tokens)
                if n_held >= _HELD:
                    yield counted()
                    held, n_held = [], 0
        if held:
            yield counted()

    pairs = train.select("places").mapInArrow(count, "left int, right int, c bigint")
    return pairs.groupBy("left", "right").agg(F.sum("c").alias("c"))


def _neighbours(pairs: DataFrame, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each word precedes, and follows, a word of each class."""
    shared = pairs.sparkSession.sparkContext.broadcast(classes)
    n = len(classes)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        sums = np.zeros(2 * n * _N)
        for frame in frames:
            left, right, c = (frame[x].to_numpy(np.int64) for x in ("left", "right", "c"))
            np.add.at(sums, left * _N + own[right], c)
            np.add.at(sums, (n + right) * _N + own[left], c)
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"at": at, "c": sums[at].astype(np.int64)})

    cells = pairs.mapInPandas(add, "at bigint, c bigint").groupBy("at").agg(F.sum("c").alias("c"))
    got = cells.toArrow()
    sums = np.zeros(2 * n * _N)
    sums[got["at"].to_numpy()] = got["c"].to_numpy()
    before, after = sums.reshape(2, n, _N)
    return before, after


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def _table(classes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """How often each class precedes each class."""
    member = np.zeros((len(classes), _N))
    member[np.arange(len(classes)), classes] = 1.0
    return member.T @ before


def _exchange(
    classes: np.ndarray, before: np.ndarray, after: np.ndarray, movable: np.ndarray
) -> np.ndarray:
    """Move each movable word, one after the other, to the cluster with the largest likelihood.

    The likelihood is the sum of n log n over class bigrams less that over the
    classes as left and as right context; a move touches one row and one column
    of the bigram table for the old and the new class. The table follows each
    move; what the words' neighbours are counts from the start of the round.
    """
    classes = classes.copy()
    table = _table(classes, before)
    for w in movable:
        own, out, into = classes[w], before[w], after[w]
        table[own] -= out
        table[:, own] -= into
        table = np.maximum(table, 0.0)
        rows, columns = table[:CLASSES].sum(1), table[:, :CLASSES].sum(0)
        right, left = np.flatnonzero(out), np.flatnonzero(into)
        # Cells that the word adds nothing to make no difference.
        behind, ahead = table[:CLASSES, right], table[left, :CLASSES]
        gain = (_xlogx(behind + out[right]) - _xlogx(behind)).sum(1)
        gain += (_xlogx(ahead + into[left, None]) - _xlogx(ahead)).sum(0)
        gain -= _xlogx(rows + out.sum()) - _xlogx(rows)
        gain -= _xlogx(columns + into.sum()) - _xlogx(columns)
        best = int(gain.argmax())
        # Ties and rounding leave a word where it is.
        best = best if gain[best] > gain[own] + 1e-6 else own
        table[best] += out
        table[:, best] += into
        classes[w] = best
    return classes


def cluster(pairs: DataFrame, n_words: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each of the first words, by exchange, and the table of class bigrams.

    ``pairs`` is a written table of ``_pairs``. Each round, the executors count
    every word's neighbours by class, and a quarter of the words, which is at
    most ``CLUSTERED`` / 4, moves; four rounds go through all words.
    """
    classes = np.concatenate([np.arange(n_words) % CLASSES, CLASSES + np.arange(SHAPES + 2)])
    rng = np.random.default_rng(0)
    for i in range(rounds if n_words else 0):
        if i % _PARTS == 0:
            order = rng.permutation(n_words)
        before, after = _neighbours(pairs, classes)
        classes = _exchange(classes, before, after, order[i % _PARTS :: _PARTS])
    return classes[:n_words], _table(classes, _neighbours(pairs, classes)[0])


def _surroundings(train: DataFrame, hashes: np.ndarray, shapes: np.ndarray, classes: np.ndarray) -> DataFrame:
    """(word, around): the classes before and after each occurrence of all words but the clustered."""
    shared = train.sparkSession.sparkContext.broadcast((hashes, shapes, classes))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, shapes, classes = shared.value
        held, around, n_held = [], [], 0

        def grouped() -> pa.RecordBatch:
            words, pairs = np.concatenate(held), np.concatenate(around)
            order = np.argsort(words)
            words, at = np.unique(words[order], return_index=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(words), _packed(pairs[order], np.append(at, len(order)))],
                names=["word", "around"],
            )

        for batch in batches:
            for part in chunks(batch, "places"):
                places, first = _unpacked(part.column(0), np.int32)
                tokens, context, at = _sequence(_by_shape(places, classes, shapes, CLASSES), first, _END)
                words = np.append(hashes.view(np.int64), 0)[np.maximum(places, -1)]
                words[places < 0] = _unpacked(part.column(1), np.int64)[0]
                out = (places < 0) | (places >= len(classes))
                held.append(words[out])
                around.append((context[at[out]] + 256 * tokens[at[out] + 1]).astype("<u2"))
                n_held += len(held[-1])
                if n_held >= _HELD:
                    yield grouped()
                    held, around, n_held = [], [], 0
        if n_held:
            yield grouped()

    return train.select("places", "rare").mapInArrow(collect, "word bigint, around binary")


class _Gains:
    """What each cluster gains by a word, from how often the word has which class before or after it."""

    FEW = 16  # Gains of up to so many occurrences are looked up.
    AT_ONCE = 1 << 15  # Pairs of a word and a class that are weighed together.

    def __init__(self, table: np.ndarray) -> None:
        # Contexts before the word, then those after it.
        self.cells = np.concatenate([table[:, :CLASSES], table[:CLASSES].T])
        self.sums = np.stack([table[:CLASSES].sum(1), table[:, :CLASSES].sum(0)])
        few = np.arange(1, self.FEW + 1)[:, None]
        self.few = _xlogx(self.cells[:, None] + few) - _xlogx(self.cells)[:, None]
        # All words that fit nowhere would meet in an empty cluster, as each is weighed on its own.
        self.empty = self.sums.sum(0) == 0

    def best(self, owner: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best cluster and the count of each word; ``owner`` is the word of each occurrence, in order."""
        counts = np.bincount(owner)
        places = np.concatenate([around & 255, _N + (around >> 8)]).astype(np.int64)
        keys, times = np.unique(np.tile(owner, 2) * (2 * _N) + places, return_counts=True)
        word, place = np.divmod(keys, 2 * _N)
        starts = np.searchsorted(word, np.arange(len(counts) + 1))
        best = np.empty(len(counts), np.int32)
        w = 0
        while w < len(counts):
            end = max(w + 1, int(np.searchsorted(starts, starts[w] + self.AT_ONCE, "right")) - 1)
            cut = slice(starts[w], starts[end])
            own, n = place[cut], times[cut]
            gain = self.few[own, np.minimum(n, self.FEW) - 1]
            many = n > self.FEW
            cells = self.cells[own[many]]
            gain[many] = _xlogx(cells + n[many, None]) - _xlogx(cells)
            gain = np.add.reduceat(gain, starts[w:end] - starts[w], axis=0)
            c, at = np.unique(counts[w:end], return_inverse=True)
            gain -= (_xlogx(self.sums[:, None] + c[:, None]) - _xlogx(self.sums)[:, None]).sum(0)[at]
            gain[:, self.empty] = -np.inf
            best[w:end] = gain.argmax(1)
            w = end
        return best, counts


def assign(surroundings: DataFrame, table: np.ndarray) -> DataFrame:
    """(word, class, c) of each word of ``_surroundings``: the cluster that gains most by it, its count.

    ``table`` counts these words by their shapes. Each is weighed against it on
    its own, so the result does not depend on order or partitions.
    """
    shared = surroundings.sparkSession.sparkContext.broadcast(_Gains(table))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def weighed(words: np.ndarray, own: list[np.ndarray]) -> pa.RecordBatch:
            distinct, owner = np.unique(words, return_inverse=True)
            best, counts = shared.value.best(np.repeat(owner, [len(x) for x in own]), np.concatenate(own))
            return pa.RecordBatch.from_arrays(
                [pa.array(distinct), pa.array(best), pa.array(counts)], names=["word", "class", "c"]
            )

        held, around = np.zeros(0, np.int64), []
        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy()])
            values, first = _unpacked(batch.column(1), "<u2")
            around += np.split(values, first[1:-1])
            # The last word may go on in the next batch.
            done = int(np.searchsorted(held, held[-1])) if len(held) else 0
            if done:
                yield weighed(held[:done], around[:done])
                held, around = held[done:], around[done:]
        if len(held):
            yield weighed(held, around)

    rows = surroundings.repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(weigh, "word bigint, class int, c bigint")


def _rare_classes(coded: DataFrame, classes: DataFrame) -> DataFrame:
    """(rid, joined) of rows of ``coded``: (at, class, c) of all words of ``rare`` that have a class.

    ``at`` has all places of the word in ``rare``.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, first = _unpacked(batch.column(1), np.int64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(first))
            order = np.lexsort((words, row))
            own, words = row[order], words[order]
            new = np.flatnonzero((np.diff(words, prepend=0) != 0) | (np.diff(own, prepend=-1) != 0))
            at = (order - first[own]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own[new])),
                    pa.array(words[new]),
                    _packed(at, np.append(new, len(at))),
                ],
                names=["rid", "word", "at"],
            )

    rare = coded.where(F.length("rare") > 0).select("rid", "rare")
    found = rare.mapInArrow(unpack, "rid bigint, word bigint, at binary").join(classes, "word")
    return found.groupBy("rid").agg(F.collect_list(F.struct("at", "class", "c")).alias("joined"))


def _classed(coded: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, held_out, places, joined) of each row of ``coded``; the hashes of its words stay behind.

    Hashes are half of what a rare word takes, and rows are moved and written
    again here. The size of the files of ``found`` says too little for a broadcast.
    """
    return coded.drop("rare").join(found.hint("merge"), "rid", "left").drop("rid")


def _kept(c: np.ndarray) -> np.ndarray:
    """Units of each token of a word with count ``c`` that its class keeps; all, of an unseen word."""
    return _UNITS - np.where(c > 0, np.rint(_UNITS * _DISCOUNT / np.maximum(c, 1)), 0).astype(np.int64)


@dataclass(frozen=True)
class Words:
    """Counts, shapes and classes of the frequent words."""

    counts: np.ndarray
    shapes: np.ndarray
    classes: np.ndarray

    def of(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Count, shape and class of every word of ``_classed``, and each text's first plus the end."""
        column = lambda name: part.column(part.schema.get_field_index(name))
        places, first = _unpacked(column("places"), np.int32)
        known = np.append(self.counts, 0)[np.maximum(places, -1)]
        shape = _by_shape(places, np.zeros(0, np.int64), self.shapes, 0)
        own = _by_shape(places, self.classes, self.shapes, CLASSES)
        joined = column("joined").flatten()
        if len(joined):
            n_joined = pc.list_value_length(column("joined")).fill_null(0).to_numpy(zero_copy_only=False)
            at, starts = _unpacked(joined.field("at"), np.int32)
            times = np.diff(starts)
            rare = np.flatnonzero(places < 0)
            # Each row's first rare word.
            before = np.repeat(np.searchsorted(rare, first[:-1]), n_joined)
            here = rare[np.repeat(before, times) + at]
            known[here] = np.repeat(joined.field("c").to_numpy(), times)
            own[here] = np.repeat(joined.field("class").to_numpy(), times)
        return known, shape, own, first


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs but the classes of rare words."""

    words: Words
    transitions: np.ndarray  # log10, from class to class
    totals: np.ndarray  # tokens of each class, less what they leave to unseen words
    n_ends: int
    tokens: int  # all training tokens
    vocabulary: int

    counts = property(lambda self: self.words.counts)
    shapes = property(lambda self: self.words.shapes)
    classes = property(lambda self: self.words.classes)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.vocabulary + 1)))

    def emission(self, c: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log10 share of a word with count ``c`` in its class; an unseen word is all of its class."""
        kept = c * _kept(c) / _UNITS
        return np.log10(np.where(c > 0, kept / np.where(c > 0, self.totals[own], 1), 1.0))


def _transitions(joined: DataFrame, words: Words) -> np.ndarray:
    """How often each class follows each; a part of every token counts as an unseen word of its shape."""
    shared = joined.sparkSession.sparkContext.broadcast(words)

    def transit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_N * _N, np.int64)
        for batch in batches:
            for part in chunks(batch, "places"):
                c, shape, own, first = shared.value.of(part)
                tokens, context, at = _sequence(own, first, _END)
                shapes, before, _ = _sequence(CLASSES + shape, first, _END)
                kept = np.full(len(tokens), _UNITS)
                kept[at] = _kept(c)
                kept_before = np.where(context == _START, _UNITS, np.concatenate([[_UNITS], kept[:-1]]))
                for left, n in ((context, kept_before), (before, _UNITS - kept_before)):
                    for right, m in ((tokens, kept), (shapes, _UNITS - kept)):
                        sums += np.bincount(left * _N + right, n * m, _N * _N).astype(np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "c"])

    cells = joined.select("places", "joined").mapInArrow(transit, "at bigint, c bigint")
    # Decimals, since the units of a large table are beyond a long.
    got = cells.groupBy("at").agg(F.sum(F.col("c").cast("decimal(38,0)")).cast("double").alias("c")).toArrow()
    table = np.zeros(_N * _N)
    table[got["at"].to_numpy()] = got["c"].to_numpy()
    return table.reshape(_N, _N) / _UNITS**2


def _fit(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the rows of ``docs`` (doc_id, held_out, text) that are not held out.

    Also the written table of all its word counts, and that of all rows with
    their words' classes.
    """
    spark = docs.sparkSession
    counts = materialize(count_words(docs.where(~F.col("held_out"))), "word-counts")
    top = most_frequent(counts, "word", FREQUENT)
    if top.num_rows < CLUSTERED:
        # Many words of about one count: no list of all from some count on is short enough.
        top = counts.orderBy(F.desc("c"), "word").limit(CLUSTERED).toArrow()
    hashes = top["word"].to_numpy().view(np.uint64)
    shapes = top["shape"].to_numpy().astype(np.int64)
    n_clustered = min(CLUSTERED, len(hashes))
    with scratch_scope(spark, "brown") as folder:
        coded = materialize(_code(docs, Lookup(hashes)), "coded", folder=folder, compact=True)
        train = coded.where(~F.col("held_out"))
        with scratch_scope(spark, "brown-pairs") as short:
            pairs = materialize(_pairs(train, n_clustered, shapes), "word-pairs", folder=short)
            classes, table = cluster(pairs, n_clustered)
        rest = assign(_surroundings(train, hashes, shapes, classes), table)
        rest = materialize(rest, "word-classes", folder=folder)
        if n_clustered < len(hashes):
            least = int(top["c"].to_numpy().min())
            got = rest.where(F.col("c") >= least).toArrow()
            order = np.argsort(got["word"].to_numpy())
            at = np.searchsorted(got["word"].to_numpy()[order], hashes[n_clustered:].view(np.int64))
            classes = np.concatenate([classes, got["class"].to_numpy()[order][at]])
        # One join after the other, so that the shuffle files of the two are not there together.
        found = materialize(_rare_classes(coded, rest), "rare-classes", folder=folder)
        joined = materialize(_classed(coded, found), "classed", compact=True)
    words = Words(top["c"].to_numpy(), shapes, classes.astype(np.int64))
    table = _transitions(joined.where(~F.col("held_out")), words)
    smooth = table + _TRANSITION
    smooth[:, _START] = 0
    size = counts.agg(F.count("*").alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).head()
    n_ends = int(np.rint(table[:, _END].sum()))
    with np.errstate(divide="ignore"):
        transitions = np.log10(smooth / smooth.sum(1, keepdims=True))
    model = Model(words, transitions, table.sum(0), n_ends, size["c"] + n_ends, size["n"] + (n_ends > 0))
    return model, counts, joined


def fit(train: DataFrame) -> tuple[Model, DataFrame]:
    """The model of ``train`` (text), and the written table of all its word counts."""
    rows = train.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(False).alias("held_out"), "text")
    return _fit(rows)[:2]


_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    The model learns from the rows of ``docs`` (doc_id, text) outside of fold 0.
    A null text is an empty one, and an empty one is its end. A null id is in
    the fold of the empty string. Without training rows all words are unseen.
    Other columns are not read. The counts and classes of all words but the
    most frequent are joined to their occurrences, so nothing grows on the driver.
    """
    held_out = (fold(F.col("doc_id"), folds) == 0).alias("held_out")
    model, _, joined = _fit(docs.select("doc_id", held_out, "text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for part in chunks(batch, "places"):
                c, _, own, first = model.words.of(part)
                tokens, context, _ = _sequence(own, first, _END)
                n, lengths = part.num_rows, np.diff(first)
                of = np.repeat(np.arange(n), lengths)
                of_token = np.repeat(np.arange(n), lengths + 1)
                moves = model.transitions[context, tokens]
                end = model.base(np.array(model.n_ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        part.column(part.schema.get_field_index("held_out")),
                        pa.array(lengths + 1),
                        pa.array(np.bincount(of, c > 0, n).astype(np.int64) + (model.n_ends > 0)),
                        pa.array(np.full(n, model.tokens)),
                        pa.array(np.bincount(of, model.base(c), n) + end),
                        pa.array(np.bincount(of, model.emission(c, own), n) + np.bincount(of_token, moves, n)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined.mapInArrow(score, _SCORED)
