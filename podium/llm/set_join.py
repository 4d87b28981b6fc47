"""Exact Jaccard self-join of word n-gram sets, by set relations.

Documents with equal sets are one class. A class's n-grams are ordered from
rare to frequent, and two sets that are similar enough share one of their first
few (the prefix). Prefixes form an index whose lists are sorted by set size and
position and cut into blocks of equal size and position: a pair of blocks whose
sizes or positions rule out the wanted overlap is skipped unread (index-level
skipping). Before that, sets that share a whole-set minimum hash are compared
with one leader each; sets so linked need no pairs among themselves, and the
overlap of two followers of one leader is bounded by their overlaps with it, so
many of their answers follow without reading either set (answer-level
skipping). All other candidates are verified on whole sets.

A list of more than ``HOT`` sets, as a large group of near copies has, gives no
pairs. Its members are compared with one of them, the reference, and indexed
anew by what they have and it lacks, or the reverse: the symmetric difference
of two sets is that of their differences from the reference, so the same
prefix bounds hold there, where near copies share little. Only members that may
be near the reference, by a bit sketch of each set, are compared; a large corpus
has many lists of sets that share just a common n-gram. Those stay in the list,
which gets another reference in the next round and at last gives the pairs that
the sketches leave open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.components import components
from podium.llm.frequent import most_frequent
from podium.llm.skew import join_groups
from podium.llm.words import Lookup, chunks, mix, ngram_hashes, word_hashes
from podium.operators import free_name
from podium.sources import materialize, scratch_scope

# N-grams that one task counts at a time; those it meets at least ``_REPEATS``
# times go into the count of all documents. 32 MB: so large a block goes back to
# the system when it is free, a smaller one may stay with the worker.
_COUNTED = 1 << 22
_REPEATS = 3
# Bytes of text that are made sets of together: about a hundred times that are held
# in all, by each worker of an executor.
SLICE_BYTES = 1 << 18
# Pairs of one task that are held at a time, 16 bytes each and as much again to filter them.
PAIRS = 1 << 18
# Most frequent n-grams that have a place of their own in the order: 12 bytes
# each, broadcast. The order decides only how long the index lists are.
FREQUENT = 500_000
# Entries of an index list that one cell of its self-join holds from each side.
CELL = 4096
_LEADERS = 3
# Entries of an index list that are paired at most; the members of longer ones are
# indexed by their differences from one of them, and so on, ``ROUNDS`` times at most.
HOT = 64
ROUNDS = 3
# Members leave a list that differ from its reference by up to so many times
# what linked sets of its size may differ by, halved: two copies of a set may each
# be at the limit from it.
NEAR = 4
# Bytes of a set's sketch in an index entry; ``describe_sets`` makes none shorter.
ENTRY_SKETCH = 64
# Stands for the empty set, the first reference, among the classes' numbers.
_NO_REFERENCE = -1

_SET = (
    "doc_id bigint, row_key bigint, n_shingles int, s1 bigint, s2 bigint, n_rare int,"
    " prefix array<bigint>, leads array<bigint>, bits binary"
)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of sets of ``n`` and ``m`` with 100 * overlap >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def _grams(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    words, first = word_hashes(batch.column(batch.schema.get_field_index("text")))
    return ngram_hashes(words, first, n)


def frequent_grams(docs: DataFrame, n: int, most: int = FREQUENT) -> np.ndarray:
    """The most frequent n-grams, the most frequent one first.

    All documents are counted. A task leaves out what it meets fewer than
    ``_REPEATS`` times in ``_COUNTED`` n-grams, so what it sends stays small.
    """

    def often(grams: np.ndarray) -> pa.RecordBatch:
        """What is met ``_REPEATS`` times or more, and how often; sorts the array in place."""
        grams.sort()
        last = max(0, len(grams) - _REPEATS + 1)
        at = np.flatnonzero(grams[:last] == grams[_REPEATS - 1 :])
        found = np.unique(grams[at])
        times = np.searchsorted(grams, found, "right") - np.searchsorted(grams, found)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], names=["g", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = np.empty(_COUNTED, np.uint64), 0
        for batch in batches:
            for part in chunks(batch, size=SLICE_BYTES):
                grams = _grams(part, n)[0]
                if n_held + len(grams) > len(held):
                    yield often(held[:n_held])
                    n_held = 0
                if len(grams) > len(held):
                    yield often(grams)
                    continue
                held[n_held : n_held + len(grams)] = grams
                n_held += len(grams)
        if n_held:
            yield often(held[:n_held])

    counts = docs.select("text").mapInArrow(count, "g bigint, c bigint")
    counts = materialize(counts.groupBy("g").agg(F.sum("c").alias("c")), "gram-counts")
    return most_frequent(counts, "g", most)["g"].to_numpy().view(np.uint64)


def _keys(grams: np.ndarray, frequent: Lookup) -> np.ndarray:
    """A number for each n-gram, the same in all documents; rare before frequent."""
    place = frequent.find(grams)
    # The most frequent one has place 0 and comes last.
    return np.where(place < 0, grams >> np.uint64(1), ~place.astype(np.uint64))


def _sets(
    batch: pa.RecordBatch, n: int, frequent: Lookup
) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, sorted distinct keys) of each document of a batch."""
    for part in chunks(batch, size=SLICE_BYTES):
        grams, first = _grams(part, n)
        keys = _keys(grams, frequent)
        ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
        for i, doc_id in enumerate(ids):
            yield doc_id, np.unique(keys[first[i] : first[i + 1]])


def _signature(keys: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        a, b = mix(keys), mix(keys ^ np.uint64(0x9E3779B97F4A7C15))
        return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def _sketch(keys: np.ndarray) -> np.ndarray:
    """Which of some bits, two or more for each key, an odd number of a set's keys falls on, packed.

    Two sets' sketches differ in no more bits than the sets differ in keys. A
    sketch of half the bits is one half xor the other.
    """
    n_bits = max(8 * ENTRY_SKETCH, 1 << (2 * len(keys) - 1).bit_length())
    at = (mix(keys) & np.uint64(n_bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=n_bits) & 1, bitorder="little")


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch as one of ``size`` bytes."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def describe_sets(docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    """Size, signature, prefix, leader hashes and sketch of each document's set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [], [], [], [], [])
            row_keys = batch.column(batch.schema.get_field_index("row_key")).to_pylist()
            for row_key, (doc_id, keys) in zip(row_keys, _sets(batch, n, frequent.value)):
                size = len(keys)
                # An empty set shares nothing: its lists are empty.
                prefix = keys[: prefix_length(size, percent)] if size else keys
                leads = [
                    int(mix(keys ^ np.uint64(7_919 * (k + 1))).min().view(np.int64))
                    for k in range(_LEADERS if size else 0)
                ]
                n_rare = int(np.searchsorted(keys, np.uint64(1 << 63)))
                bits = _sketch(keys).tobytes() if size else b""
                row = (doc_id, row_key, size, *_signature(keys), n_rare, prefix.view(np.int64), leads, bits)
                for column, value in zip(columns, row):
                    column.append(value)
            lists = pa.list_(pa.int64())
            i32, i64 = pa.int32(), pa.int64()
            types = [i64, i64, i32, i64, i64, i32, lists, lists, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "row_key", "n_shingles", "s1", "s2", "n_rare", "prefix", "leads", "bits"],
            )

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(describe, _SET)


def _sets_of(ids: DataFrame, classes: DataFrame, docs: DataFrame, n: int, frequent, folder: str) -> DataFrame:
    """(cid, keys) of the classes ``ids`` (cid), a table written to ``folder``.

    Only documents that stand for one of these classes are read into sets again.
    """
    wanted = classes.join(ids.distinct(), "cid").select("cid", "s1", "s2", "n_shingles", "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, keys in _sets(batch, n, frequent.value):
                rows.append((*_signature(keys), len(keys), keys.tobytes()))
            types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, types)],
                names=["s1", "s2", "n_shingles", "keys"],
            )

    same_id = docs["doc_id"].eqNullSafe(F.col("rep"))
    # Written first: its size decides whether it is broadcast or the texts are exchanged.
    reps = materialize(wanted.select(F.col("doc_id").alias("rep")).distinct(), "reps", true_size=True)
    texts = docs.join(reps, same_id, "left_semi").select("doc_id", "text")
    # A repeated id brings texts that no pair needs: they meet no class, or one twice.
    sets = texts.mapInArrow(read, "s1 bigint, s2 bigint, n_shingles int, keys binary")
    sets = wanted.join(sets, ["s1", "s2", "n_shingles"]).select("cid", "keys")
    return materialize(sets.dropDuplicates(["cid"]), "sets", folder=folder)


def verified(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, frequent, folder: str
) -> DataFrame:
    """(a, b, n_a, overlap, linked) of class pairs (a, b), counted on whole sets, which are in ``folder``."""
    ids = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid")))
    sets = _sets_of(ids, classes, docs, n, frequent, folder)

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            common = np.empty(batch.num_rows, np.int64)
            total = np.empty(batch.num_rows, np.int64)
            size_a = np.empty(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                p = np.frombuffer(x[i].as_buffer(), np.uint64)
                q = np.frombuffer(y[i].as_buffer(), np.uint64)
                common[i] = len(np.intersect1d(p, q, assume_unique=True))
                total[i], size_a[i] = len(p) + len(q), len(p)
            linked = 100 * common >= percent * (total - common)
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(size_a), pa.array(common), pa.array(linked)],
                names=["a", "b", "n_a", "overlap", "linked"],
            )

    left = sets.select(F.col("cid").alias("a"), F.col("keys").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("keys").alias("y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(overlap, "a bigint, b bigint, n_a bigint, overlap bigint, linked boolean")


def _index(entries: DataFrame) -> DataFrame:
    """Prefix entries dealt to cells: a list longer than ``CELL`` is cut into
    groups, and each pair of groups meets in a cell of its own."""
    key = ["reference", "gram"]
    lists = entries.groupBy(*key).agg(F.count("*").alias("entries")).where(F.col("entries") > CELL)
    long_lists = materialize(lists, "long-lists", true_size=True)
    entries = entries.join(long_lists, key, "left")
    groups = F.coalesce(F.ceil(F.col("entries") / CELL), F.lit(1)).cast("int")
    return (
        entries.withColumn("groups", groups)
        .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("groups")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
        .select(
            *key,
            F.least("own", "other").alias("cell_a"),
            F.greatest("own", "other").alias("cell_b"),
            "own",
            "n",
            "size",
            "pos",
            "cid",
            "component",
            "bits",
        )
    )


_CELL_KEY = ["reference", "gram", "cell_a", "cell_b"]


def _block_pairs(rows: pd.DataFrame, percent: int) -> Iterator[pd.DataFrame]:
    """Candidate pairs within the cells of ``rows``, which is sorted by cell, n, size, position,
    about ``PAIRS`` at a time.

    Of two sets whose first common entry stands at the given positions of their
    differences from the reference, all entries before it are in one set only,
    and so are those that the longer rest has more. Sets that are so near to the
    reference that they are linked for certain are both linked with it already.
    Entries with sketches (``bits``) give no pair that these rule out.
    """
    cell = np.zeros(len(rows), np.int64)
    for c in _CELL_KEY:
        cell[1:] |= np.diff(rows[c].to_numpy(np.int64)) != 0
    cell = np.cumsum(cell)
    n, size, pos = (rows[c].to_numpy(np.int64) for c in ("n", "size", "pos"))
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(cell) != 0) | (np.diff(n) != 0) | (np.diff(size) != 0) | (np.diff(pos) != 0)
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(rows)))
    bc, bn, bs, bp = cell[start], n[start], size[start], pos[start]
    own, comp, cid = (rows[c].to_numpy(np.int64) for c in ("own", "component", "cid"))
    diagonal = rows["cell_a"].to_numpy() == rows["cell_b"].to_numpy()
    drawn = rows["bits"].notna().to_numpy() if "bits" in rows else np.zeros(len(rows), bool)
    if drawn.any():
        bits = np.zeros((ENTRY_SKETCH // 8, len(rows)), np.uint64)
        bits[:, drawn] = np.frombuffer(b"".join(rows["bits"][drawn]), np.uint64).reshape(-1, len(bits)).T

    def wanted(firsts: list[np.ndarray], seconds: list[np.ndarray]) -> pd.DataFrame:
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        open_ = (comp[i] != comp[j]) & ((own[i] != own[j]) | diagonal[i])
        i, j = i[open_], j[open_]
        if drawn.any():
            least = np.zeros(len(i), np.int64)
            for part in bits:
                least += np.bitwise_count(part[i] ^ part[j])
            open_ = ~(drawn[i] & drawn[j]) | ((100 + percent) * least <= (100 - percent) * (n[i] + n[j]))
            i, j = i[open_], j[open_]
        i, j = cid[i], cid[j]
        return pd.DataFrame({"a": np.minimum(i, j), "b": np.maximum(i, j)}).drop_duplicates()

    firsts, seconds, held = [], [], 0
    active, d = np.arange(len(start)), 0
    while len(active):
        other = active + d
        inside = other < len(start)
        active, other = active[inside], other[inside]
        # Sizes ascend in a list: past the first that is too large, all are.
        going = (bc[active] == bc[other]) & (100 * bn[active] >= percent * bn[other])
        active, other = active[going], other[going]
        apart = (100 - percent) * (bn[active] + bn[other])
        rests = bs[active] - bp[active] - bs[other] + bp[other]
        open_ = (100 + percent) * (bp[active] + bp[other] + np.abs(rests)) <= apart
        open_ &= (100 + percent) * (bs[active] + bs[other]) > apart
        for a, b in zip(active[open_], other[open_]):
            if a == b and count[a] == 1:
                continue
            # A large block goes by so many of its rows that their pairs are held at once.
            step, end_a = max(1, PAIRS // int(count[b])), start[a] + count[a]
            for begin in range(start[a], end_a, step):
                end = min(begin + step, end_a)
                if a != b:
                    firsts.append(np.repeat(np.arange(begin, end), count[b]))
                    seconds.append(np.tile(np.arange(start[b], start[b] + count[b]), end - begin))
                else:
                    i, j = np.triu_indices(end - begin, 1, end_a - begin)
                    firsts.append(begin + i)
                    seconds.append(begin + j)
                held += len(firsts[-1])
                if held >= PAIRS:
                    yield wanted(firsts, seconds)
                    firsts, seconds, held = [], [], 0
        d += 1
    if held:
        yield wanted(firsts, seconds)


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of classes in different components that may be linked."""
    order = [*_CELL_KEY, "n", "size", "pos", "cid"]

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            # The last cell may go on in the next frame.
            other = np.zeros(len(frame), bool)
            for c in _CELL_KEY:
                values = frame[c].to_numpy()
                other |= values != values[-1]
            whole = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            rest = frame.iloc[whole:]
            if whole:
                yield from _block_pairs(frame.iloc[:whole], percent)
        if rest is not None and len(rest):
            yield from _block_pairs(rest, percent)

    cells = _index(entries).repartition(*_CELL_KEY).sortWithinPartitions(*order)
    return cells.mapInPandas(pair, "a bigint, b bigint").distinct()


def _near_distance(reference, percent: int):
    """Members that differ from a reference of this size by no more leave its list."""
    return NEAR * (100 - percent) * reference // (100 + percent)


def _reach(n: np.ndarray, reference: np.ndarray, percent: int) -> np.ndarray:
    """How much a set of ``n`` may differ from a reference that is linked with it, or
    that is so near to a member linked with it that the member leaves the list."""
    inner = _near_distance(reference, percent)
    # Such a member has up to ``inner`` more n-grams than the reference.
    return inner + (100 - percent) * (reference + inner + n) // (100 + percent)


def _spokes(candidates: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(reference, cid) of those of (reference, cid, n, m), with their sizes, that may
    be within reach of their reference by sizes and sketches; a written table."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            yield batch.filter(pa.array(np.abs(n - m) <= _reach(n, m, percent)))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reference, cid, n, m, x, y = (batch.column(i) for i in range(6))
            least = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                p = np.frombuffer(x[i].as_buffer(), np.uint8)
                q = np.frombuffer(y[i].as_buffer(), np.uint8)
                size = min(len(p), len(q))
                least[i] = np.bitwise_count(_folded(p, size) ^ _folded(q, size)).sum(dtype=np.int64)
            n, m = (side.to_numpy().astype(np.int64) for side in (n, m))
            pairs = pa.RecordBatch.from_arrays([reference, cid], names=["reference", "cid"])
            yield pairs.filter(pa.array(least <= _reach(n, m, percent)))

    sized_ones = candidates.mapInArrow(sized, candidates.schema).distinct()
    sized_ones = materialize(sized_ones, "sized-spokes")
    sketches = full.select("cid", F.col("bits").alias("x"))
    centres = full.select(F.col("cid").alias("reference"), F.col("bits").alias("y"))
    centres = centres.join(sized_ones.select("reference").distinct(), "reference")
    centres = materialize(centres, "centres", true_size=True)
    joined = sized_ones.join(sketches, "cid").join(centres, "reference").select("reference", "cid", "n", "m", "x", "y")
    return materialize(joined.mapInArrow(near, "reference bigint, cid bigint"), "spokes")


def _differences(
    spokes: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, frequent
) -> DataFrame:
    """(reference, cid, n, size, prefix, linked, near) of (reference, cid): how each class differs from
    its reference, on whole sets; a written table.

    ``size`` counts what one of the two sets has and the other lacks; ``prefix`` holds
    the first of that. Rare n-grams that the reference lacks come first, frequent
    ones that only it has follow: a copy's own changes. What the reference itself
    has changed, which all others share, comes last. The order affects speed only.
    """

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reference, cid, x, y = (batch.column(i) for i in range(4))
            sizes, counts, prefixes, linked, near = [], [], [], [], []
            for i in range(batch.num_rows):
                p = np.frombuffer(x[i].as_buffer(), np.uint64)
                q = np.frombuffer(y[i].as_buffer(), np.uint64)
                more = np.setdiff1d(p, q, assume_unique=True)
                less = np.setdiff1d(q, p, assume_unique=True)
                a, b = (int(np.searchsorted(side, np.uint64(1 << 63))) for side in (more, less))
                apart = np.concatenate([more[:a], less[b:], more[a:], less[:b]])
                counts.append(len(p))
                sizes.append(len(apart))
                linked.append((100 + percent) * len(apart) <= (100 - percent) * (len(p) + len(q)))
                near.append(len(apart) <= _near_distance(len(q), percent))
                # Linked sets differ in no more than this, whatever the other's size.
                most = len(p) * (100 - percent) // percent + 1
                prefixes.append(apart[:most].view(np.int64))
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_(), pa.bool_()]
            columns = (counts, sizes, prefixes, linked, near)
            yield pa.RecordBatch.from_arrays(
                [reference, cid, *[pa.array(v, t) for v, t in zip(columns, types)]],
                names=["reference", "cid", "n", "size", "prefix", "linked", "near"],
            )

    ids = spokes.select("cid").unionByName(spokes.select(F.col("reference").alias("cid")))
    with scratch_scope(spokes.sparkSession, "differences") as temp:
        sets = _sets_of(ids, classes, docs, n, frequent, temp)
        of_references = spokes.select(F.col("reference").alias("cid")).distinct().join(sets, "cid")
        of_references = of_references.select(F.col("cid").alias("reference"), F.col("keys").alias("y"))
        of_references = materialize(of_references, "references", true_size=True, folder=temp)
        joined = spokes.join(sets, "cid").join(of_references, "reference")
        schema = "reference bigint, cid bigint, n int, size int, prefix array<bigint>, linked boolean, near boolean"
        joined = joined.select("reference", "cid", F.col("keys").alias("x"), "y")
        return materialize(joined.mapInArrow(differ, schema), "differences")


def _sketched(entries: DataFrame, full: DataFrame) -> DataFrame:
    """Index entries with sketches of ``ENTRY_SKETCH`` bytes."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("bits")
            bits = [_folded(np.frombuffer(x.as_buffer(), np.uint8), ENTRY_SKETCH).tobytes() for x in batch.column(at)]
            yield batch.set_column(at, "bits", pa.array(bits, pa.binary()))

    drawn = entries.drop("bits").join(full.select("cid", "bits"), "cid")
    return drawn.mapInArrow(fold, drawn.schema)


def _open_pairs(
    full: DataFrame, component: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, frequent
) -> tuple[DataFrame, DataFrame]:
    """(a, b) of pairs that may be linked, and (a, b) of links with references; written tables.

    Pairs within a ``component`` of (cid, component) are left out, and lists that lie within one.
    """
    key = ["reference", "gram"]
    grouped = full.join(component, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    rows = grouped.select(
        F.lit(_NO_REFERENCE).cast("bigint").alias("reference"),
        "cid",
        F.col("n_shingles").alias("n"),
        F.col("n_shingles").alias("size"),
        "n_rare",
        "component",
        "prefix",
    )
    no_pairs = rows.sparkSession.createDataFrame([], "a bigint, b bigint")
    pairs, links, left = no_pairs, no_pairs, None
    for last in [*[False] * (ROUNDS - 1), True]:
        entries = rows.select("*", F.posexplode("prefix").alias("pos", "gram")).drop("prefix")
        entries = entries.withColumn("bits", F.lit(None).cast("binary"))
        entries = entries if left is None else entries.unionByName(left)
        if last:
            return materialize(pairs.unionByName(_candidates(entries, percent)).distinct(), "pairs"), links
        counts = entries.groupBy(*key).agg(F.count("*").alias("entries")).where(F.col("entries") > HOT)
        counts = materialize(counts.select(*key), "hot-counts", true_size=True)
        cold = _candidates(entries.join(counts, key, "left_anti"), percent)
        pairs = materialize(pairs.unionByName(cold), "cold-pairs")
        members = materialize(entries.join(counts, key), "hot-entries")
        hot = members.groupBy(*key).agg(
            F.min(F.struct("n_rare", "cid", "n")).alias("l"), F.min("component").alias("low"), F.max("component").alias("high")
        )
        hot = hot.where("low < high").select(*key, F.col("l.cid").alias("next"), F.col("l.n").alias("m"))
        hot = materialize(hot, "hot-lists", true_size=True)
        if hot.isEmpty():
            return materialize(pairs.distinct(), "pairs"), links
        members = members.join(hot, key).where("cid <> next")
        spokes = _spokes(members.select(F.col("next").alias("reference"), "cid", "n", "m"), full, percent)
        apart = _differences(spokes, classes, docs, n, percent, frequent)
        links = links.unionByName(apart.where("linked").select(F.col("reference").alias("a"), F.col("cid").alias("b")))
        # A set that is linked with a near member is compared with the reference too, so the next
        # rounds have the pair by their differences.
        gone = apart.where("near").select(F.col("reference").alias("next"), "cid")
        left = members.join(gone, ["next", "cid"], "left_anti").drop("next", "m")
        left = materialize(_sketched(left, full), "left-entries")
        rows = apart.drop("linked", "near").join(grouped.select("cid", "n_rare", "component"), "cid")


def _judged(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs that may still be linked; ``derived`` ones are for certain, since two
    sets share at least |x & L| + |y & L| - |L|, and at most what they can share
    inside and outside of L, of a common leader L."""
    sides = [
        known.select(F.col("cid").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "leader", "n_leader", "overlap")])
        for s in ("a", "b")
    ]
    rows = pairs.join(sides[0], "a").join(sides[1], "b")
    n = F.col("n_a") + F.col("n_b")
    need = -F.floor(-F.lit(percent) * n / (100 + percent))
    least = F.col("overlap_a") + F.col("overlap_b") - F.col("n_leader_a")
    most = F.least("overlap_a", "overlap_b") + F.least(
        F.col("n_a") - F.col("overlap_a"), F.col("n_b") - F.col("overlap_b")
    )
    same = F.coalesce(F.col("leader_a") == F.col("leader_b"), F.lit(False))
    return rows.where(~same | (most >= need)).select("a", "b", (same & (least >= need)).alias("derived"))


def _prefix_checked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs that may be linked, judged by all of their prefixes.

    Up to the smaller of the two prefixes' last n-grams both sets are known, so
    what they share there is counted; of the rest they share at most all that
    the smaller rest has. Prefixes are a tenth of the sets, or less.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m, x, y = (batch.column(i) for i in range(6))
            n, m = n.to_numpy().astype(np.int64), m.to_numpy().astype(np.int64)
            need, keep = needed(n, m, percent), np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                p = x[i].values.to_numpy().view(np.uint64)
                q = y[i].values.to_numpy().view(np.uint64)
                last = min(p[-1], q[-1])
                p, q = p[: np.searchsorted(p, last, "right")], q[: np.searchsorted(q, last, "right")]
                shared = len(np.intersect1d(p, q, assume_unique=True))
                keep[i] = shared + min(n[i] - len(p), m[i] - len(q)) >= need[i]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    left = full.select(F.col("cid").alias("a"), F.col("n_shingles").alias("n"), F.col("prefix").alias("x"))
    right = full.select(F.col("cid").alias("b"), F.col("n_shingles").alias("m"), F.col("prefix").alias("y"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
    return joined.mapInArrow(check, "a bigint, b bigint")


def _links(
    full: DataFrame, classes: DataFrame, docs: DataFrame, n: int, percent: int, frequent
) -> DataFrame:
    """(a, b): links that connect all classes which any links connect; a written table."""
    # Leaders: of the classes with the same minimum hash, for two hashes or more,
    # the one with the fewest n-grams that others lack, as the original of a group has.
    leads = full.select("cid", "n_shingles", "n_rare", F.explode("leads").alias("lead"))
    central = leads.groupBy("lead").agg(
        F.min(F.struct("n_rare", "cid", "n_shingles")).alias("l"), F.count("*").alias("entries")
    )
    stars = join_groups(leads, materialize(central, "leads"), ["lead"], "entries")
    near = F.least("n_shingles", "l.n_shingles") * 100 >= F.greatest("n_shingles", "l.n_shingles") * percent
    stars = stars.where((F.col("l.cid") != F.col("cid")) & near)
    stars = stars.groupBy(F.col("l.cid").alias("a"), F.col("cid").alias("b")).count()
    stars = materialize(_prefix_checked(stars.where("count > 1"), full, percent), "stars")
    with scratch_scope(full.sparkSession, "led-sets") as temp:
        led = materialize(verified(stars, classes, docs, n, percent, frequent, temp), "led")
    first_links = led.where("linked").select("a", "b")

    component = components(first_links).withColumnRenamed("node", "cid")
    leader = led.groupBy(F.col("b").alias("cid")).agg(
        F.min(F.struct(F.col("a").alias("leader"), F.col("n_a").alias("n_leader"), "overlap")).alias("l")
    )
    pairs, spokes = _open_pairs(full, component, classes, docs, n, percent, frequent)
    known = classes.join(leader, "cid", "left").select("cid", F.col("n_shingles").alias("n"), "l.*")
    # Pairs of a leader are verified already.
    done = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = _judged(pairs, known, percent).join(done, ["a", "b"], "left_anti")
    found = materialize(found, "candidates")
    open_pairs = materialize(_prefix_checked(found.where("not derived"), full, percent), "open-pairs")
    with scratch_scope(full.sparkSession, "open-sets") as temp:
        more = verified(open_pairs, classes, docs, n, percent, frequent, temp)
        every = first_links.unionByName(spokes).unionByName(found.where("derived").select("a", "b")).unionByName(
            more.where("linked").select("a", "b")
        )
        return materialize(every, "links")


def _labelled_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, component, component_id); ``component`` is a
    number of its own, null for an empty set."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    frequent = spark.sparkContext.broadcast(Lookup(frequent_grams(docs, n)))
    key = ["s1", "s2", "n_shingles"]
    with scratch_scope(spark, "set-join") as temp:
        with scratch_scope(spark, "described-sets") as rows_temp:
            described = materialize(describe_sets(docs, n, percent, frequent), "described", folder=rows_temp)
            rows = materialize(described.select("doc_id", "row_key", *key), "rows")
            # Rows of a class have the same lists: any of them will do.
            grouped = (
                described.where("n_shingles > 0")
                .groupBy(*key)
                .agg(
                    F.min("doc_id").alias("doc_id"),
                    F.count("*").alias("rows"),
                    F.first("n_rare").alias("n_rare"),
                    F.first("prefix").alias("prefix"),
                    F.first("leads").alias("leads"),
                    F.first("bits").alias("bits"),
                )
                .withColumn("cid", F.monotonically_increasing_id())
            )
            full = materialize(grouped, "full", folder=temp)
        classes = materialize(full.drop("n_rare", "prefix", "leads", "bits"), "classes")
        links = _links(full, classes, docs, n, percent, frequent)
    linked = components(links)

    labelled = classes.select(*key, "cid", "rows", "doc_id").join(
        linked.withColumnRenamed("node", "cid"), "cid", "left"
    )
    labelled = labelled.withColumn("component", F.coalesce("component", "cid"))
    smallest = labelled.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.count("*").alias("classes")
    )
    named = join_groups(
        materialize(labelled.drop("doc_id"), "labelled"),
        materialize(smallest, "smallest"),
        ["component"],
        "classes",
    )
    named = materialize(named.select(*key, "rows", "component", "component_id"), "named")
    out = join_groups(rows.where("n_shingles > 0"), named, key, "rows")
    alone = rows.where("n_shingles = 0").select(
        "*", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("component_id")
    )
    columns = ["doc_id", "row_key", "n_shingles", "component", "component_id"]
    return out.select(columns).unionByName(alone.select(columns))

def set_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z as a-z. A set holds
    the distinct ``n``-word shingles; a text with fewer words is one shingle;
    without words or text the set is empty and linked with nothing. Two rows
    link when 100 * intersection >= ``percent`` * union; ``component_id`` is
    the smallest id reachable. Rows that repeat an id stand in one component
    for each of their texts; null ids do not count as smallest unless there is
    no other. No rows, no result rows. Other columns are not read.
    """
    labelled = _labelled_rows(docs, n, percent)
    return labelled.select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: the smallest id's.

    A null id comes after all others; of equal ids the text with the smaller
    hash stays, of rows with equal ids and texts any one. Texts without words
    are in no component and all stay.
    """
    labelled = materialize(_labelled_rows(docs, n, percent), "labelled-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = labelled.where("component is not null").groupBy("component").agg(F.min(order).alias("f"))
    own_id, own_key, row_key = (free_name(docs.columns, c) for c in ("_id", "_key", "_row_key"))
    first = first.select(F.col("f.doc_id").alias(own_id), F.col("f.row_key").alias(own_key))
    first = materialize(first, "firsts").hint("shuffle_hash")
    keyed = docs.withColumn(row_key, F.xxhash64("doc_id", "text"))
    same = (F.col(row_key) == F.col(own_key)) & F.col("doc_id").eqNullSafe(F.col(own_id))
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = keyed.where(has_word).join(first, same, "left_semi")
    repeated = labelled.where("component is not null").groupBy("doc_id", "row_key").count()
    if not repeated.where("count > 1").isEmpty():
        # Rows that repeat an id and its text: one row for each key, any of them.
        kept = kept.dropDuplicates([row_key])
    return kept.drop(row_key).unionByName(docs.where(~has_word))
