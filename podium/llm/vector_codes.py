"""Product codes of vectors, learned by Lloyd rounds over cover trees.

Vectors become integers and are cut into equal parts; each part position has a
codebook. The vectors of a task are cut into blocks, and for each block and
part position a cover tree is built once and written: every node has a centre,
the distance to its farthest point, and, over an order in which each subtree is
one range, cumulative sums. A round walks the trees from the top. By the
triangle inequality, a whole subtree belongs to the entry nearest to its centre
if no other entry is less than two radii farther away; its sum and count are
then read off. Entries that are farther than that are left out below. Only
ambiguous nodes descend, down to exact comparisons of single points. Sums are
aggregated over all tasks; the codebooks, of bounded size, are all that the
driver holds. Distances are compared as whole numbers, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.skew import join_groups
from podium.sources import materialize, scratch_scope

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Components must be smaller, so that errors fit 64 bits.
LARGEST = 65_536
# Vectors of one block, whose trees are worked on together.
BLOCK = 8_192
# A node of so many points is not cut further: its points are compared one by one.
_LEAF = 24
# Nodes whose distances to all entries are held at a time.
_AT_ONCE = 2_048


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points and entries, a row for each point.

    Whole numbers below 2**53 are exact as doubles; larger ones are Python integers.
    """
    largest = max((int(np.abs(x).max()) for x in (points, entries) if x.size), default=0)
    if 4 * largest * largest * max(1, points.shape[1]) < 1 << 53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p * p).sum(axis=1)[:, None] - 2.0 * (p @ e.T) + (e * e).sum(axis=1)[None, :]
    out = np.zeros((len(points), len(entries)), object)
    for k in range(points.shape[1]):
        d = points[:, k].astype(object)[:, None] - entries[:, k].astype(object)[None, :]
        out += d * d
    return out


def _root(distances: np.ndarray) -> np.ndarray:
    return np.sqrt(distances.astype(np.float64))


class CoverTree:
    """A cover tree over the rows of ``points``.

    Node ``i`` covers ``order[start[i]:end[i]]``; its first point is the centre.
    ``child[i]:child[i] + children[i]`` are its children, none for a leaf, whose
    points are compared singly. A child's centre is farther than the level's
    radius from those of the children before it, and covers its points within
    that radius; the radius halves from level to level.
    """

    def __init__(self, order, start, end, radius, child, children) -> None:
        self.order, self.start, self.end = order, start, end
        self.radius, self.child, self.children = radius, child, children

    @staticmethod
    def build(points: np.ndarray) -> CoverTree:
        n = len(points)
        order = np.arange(n)
        distance = _root(squared(points, points[:1]))[:, 0]
        start, end, radius = [0], [n], [float(distance.max())]
        child, children = [0], [0]
        todo = [(0, distance)]
        while todo:
            node, distance = todo.pop()
            first, last = start[node], end[node]
            # Equal points stay together: one comparison settles them.
            if last - first <= _LEAF or radius[node] == 0.0:
                continue
            cover = radius[node] / 2
            rest, rest_distance = order[first:last], distance
            at, groups = first, []
            while len(rest):
                near = rest_distance <= cover
                groups.append((rest[near], rest_distance[near]))
                rest = rest[~near]
                if len(rest):
                    rest_distance = _root(squared(points[rest], points[rest[:1]]))[:, 0]
            child[node], children[node] = len(start), len(groups)
            for own, own_distance in groups:
                # The centre, the only one sure to be at no distance, comes first.
                order[at : at + len(own)] = own
                todo.append((len(start), own_distance))
                start.append(at)
                end.append(at + len(own))
                radius.append(float(own_distance.max()))
                child.append(0)
                children.append(0)
                at += len(own)
        as_int = [np.array(x, np.int64) for x in (start, end, child, children)]
        return CoverTree(order, as_int[0], as_int[1], np.array(radius), as_int[2], as_int[3])

    def arrays(self) -> list[np.ndarray]:
        return [self.order, self.start, self.end, self.radius, self.child, self.children]

    def assign(self, points: np.ndarray, entries: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(first, last, entry): ranges of ``order`` and the entry that all their points belong to.

        The nearest entry, the one with the lower number among equals. Ranges do not overlap
        and cover all points.
        """
        nodes = np.zeros(1, np.int64)
        open_ = np.ones((1, len(entries)), bool)
        while len(nodes):
            next_nodes, next_open = [np.zeros(0, np.int64)], [np.zeros((0, len(entries)), bool)]
            for cut in range(0, len(nodes), _AT_ONCE):
                own, candidates = nodes[cut : cut + _AT_ONCE], open_[cut : cut + _AT_ONCE]
                centres, radius = self.order[self.start[own]], self.radius[own]
                exact = np.where(candidates, squared(points[centres], entries), np.inf)
                nearest = exact.argmin(axis=1)
                rows = np.arange(len(own))
                distance = _root(exact)
                # Rounding of the roots must not exclude an entry that ties.
                limit = (distance[rows, nearest] + 2 * radius) * (1 + 1e-12) + 1e-9
                candidates = distance <= limit[:, None]
                sure = (radius == 0.0) | (candidates.sum(axis=1) == 1)
                yield self.start[own[sure]], self.end[own[sure]], nearest[sure]
                own, candidates = own[~sure], candidates[~sure]
                is_leaf = self.children[own] == 0
                yield from self._points(points, entries, own[is_leaf], candidates[is_leaf])
                own, candidates = own[~is_leaf], candidates[~is_leaf]
                n = self.children[own]
                below = np.repeat(self.child[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                next_nodes.append(below)
                next_open.append(np.repeat(candidates, n, axis=0))
            nodes, open_ = np.concatenate(next_nodes), np.concatenate(next_open)

    def _points(self, points, entries, leaves, candidates) -> Iterator[tuple[np.ndarray, ...]]:
        """Exact comparisons of the leaves' points with the entries that are left."""
        n = self.end[leaves] - self.start[leaves]
        leaf = np.repeat(np.arange(len(leaves)), n)
        at = np.repeat(self.start[leaves], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        for cut in range(0, len(at), _AT_ONCE):
            own, of = at[cut : cut + _AT_ONCE], leaf[cut : cut + _AT_ONCE]
            left = np.flatnonzero(candidates[of].any(axis=0))
            exact = squared(points[self.order[own]], entries[left])
            exact = np.where(candidates[np.ix_(of, left)], exact, np.inf)
            yield own, own + 1, left[exact.argmin(axis=1)]


def _whole(column: Column) -> Column:
    """The vector if it has components, all of them finite; else null."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(column) > 0) & F.coalesce(fine, F.lit(False)), column)


_TREES = "n int, vectors binary, trees array<array<binary>>"
_SUMS = "part int, entry int, n bigint, sums array<bigint>"


def _integers(vectors: pa.Array, dim: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) and np.abs(flat).max() >= LARGEST:
        raise ValueError(f"components must be below {LARGEST} in size")
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim)


def plant_trees(vectors: DataFrame, dim: int, parts: int) -> DataFrame:
    """Blocks of ``vectors`` (id, label, vec), with their cover trees: a row for each block."""
    width = dim // parts
    label_type = vectors.schema["label"].dataType.simpleString()

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, BLOCK):
                block = batch.slice(cut, BLOCK)
                ids, labels, vecs = (block.column(block.schema.get_field_index(c)) for c in ("id", "label", "vec"))
                points = _integers(vecs, dim)
                trees = [CoverTree.build(points[:, p * width : (p + 1) * width]) for p in range(parts)]
                packed = [[a.tobytes() for a in t.arrays()] for t in trees]
                whole = pa.array([0, len(block)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(block)], pa.int32()),
                        pa.array([points.tobytes()], pa.binary()),
                        pa.array([packed], pa.list_(pa.list_(pa.binary()))),
                        pa.ListArray.from_arrays(whole, ids),
                        pa.ListArray.from_arrays(whole, labels),
                    ],
                    names=["n", "vectors", "trees", "ids", "labels"],
                )

    return vectors.select("id", "label", "vec").mapInArrow(
        plant, f"{_TREES}, ids array<bigint>, labels array<{label_type}>"
    )


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray, list[CoverTree]]]:
    kinds = [np.int64, np.int64, np.int64, np.float64, np.int64, np.int64]
    for i in range(batch.num_rows):
        points = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64).reshape(-1, dim)
        trees = [CoverTree(*[np.frombuffer(a, k) for a, k in zip(t, kinds)]) for t in batch.column(2)[i].as_py()]
        yield i, points, trees


def _sums(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(part, entry, n, sums) of each task's points, by the entry they belong to."""
    parts, entries, width = codebooks.shape
    shared = trees.sparkSession.sparkContext.broadcast(codebooks)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, points, own in _blocks(batch, parts * width):
                for p, tree in enumerate(own):
                    mine = points[:, p * width : (p + 1) * width]
                    cumulative = np.zeros((len(mine) + 1, width), np.int64)
                    np.cumsum(mine[tree.order], axis=0, out=cumulative[1:])
                    for first, last, entry in tree.assign(mine, shared.value[p]):
                        np.add.at(total[p], entry, cumulative[last] - cumulative[first])
                        np.add.at(count[p], entry, last - first)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(count[part, entry]),
                pa.array(list(total[part, entry]), pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    rows = trees.select("n", "vectors", "trees").mapInArrow(add, _SUMS)
    added = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]
    return rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added)


def _coded(trees: DataFrame, codebooks: np.ndarray, label_type: str) -> DataFrame:
    """(id, label, code, error) of every vector."""
    parts, _, width = codebooks.shape
    shared = trees.sparkSession.sparkContext.broadcast(codebooks)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, points, own in _blocks(batch, parts * width):
                codes = np.zeros((len(points), parts), np.uint8)
                error = np.zeros(len(points), np.int64)
                for p, tree in enumerate(own):
                    mine = points[:, p * width : (p + 1) * width]
                    for first, last, entry in tree.assign(mine, shared.value[p]):
                        n = last - first
                        at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        codes[tree.order[at], p] = np.repeat(entry, n)
                    gap = mine - shared.value[p][codes[:, p]]
                    error += (gap * gap).sum(axis=1)
                text = codes.tobytes().hex()
                ids, labels = batch.column(3)[i].values, batch.column(4)[i].values
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        labels,
                        pa.array([text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)], pa.string()),
                        pa.array(error),
                    ],
                    names=["id", "label", "code", "error"],
                )

    return trees.mapInArrow(code, f"id bigint, label {label_type}, code string, error bigint")


def codebooks_text(codebooks: np.ndarray) -> str:
    """All components by part, entry and place within the part, joined by commas."""
    return ",".join(map(str, codebooks.ravel().tolist()))


def vector_codes(
    vectors: DataFrame,
    *,
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of ``vectors`` (vec_id, label and ``vector``), and the codebooks.

    A vector that is null, empty, or has a null or non-finite component is
    dropped, and so is one of another length than the first vector kept (the
    one with the smallest ``vec_id``). Components become floor(1024 * x); one of
    ``LARGEST`` or more in size raises, and so does a length that is no multiple
    of ``parts``. Codebooks start
    as the vectors of the smallest ids (null ids last, equal ids by their
    components): of all vectors where there are fewer than ``entries``, and
    they are one part by entry by component array. No vectors, no rows. Rows
    that repeat are coded each. Other columns are not read.

    The blocks and their trees are written once, about 1.5 times the vectors'
    size as 64-bit integers; a round reads them and sends a row for each task
    and entry.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    label_type = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("id"), "label", _whole(F.col(f"`{vector}`")).alias("vec")
    ).where("vec is not null")
    in_order = [F.asc_nulls_last("id"), F.asc("vec")]
    first = rows.orderBy(*in_order).select("vec").head()
    if first is None:
        empty = spark.createDataFrame([], f"vec_id bigint, label {label_type}, code string, error bigint")
        return empty, np.zeros((parts, 0, 0), np.int64)
    dim = len(first[0])
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("vec") == dim)
    starts = rows.orderBy(*in_order).select("vec").limit(entries).toArrow()["vec"].combine_chunks()
    width = dim // parts
    codebooks = _integers(starts, dim).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    with scratch_scope(spark, "cover-trees") as temp:
        trees = materialize(plant_trees(rows, dim, parts), "trees", folder=temp)
        for _ in range(rounds):
            for row in _sums(trees, codebooks).collect():
                sums = np.array(row[3:], np.int64)
                codebooks[row["part"], row["entry"]] = sums // row["n"]
        coded = _coded(trees, codebooks, label_type).withColumnRenamed("id", "vec_id")
        return materialize(coded, "codes"), codebooks


def coded_with_errors(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes with the error over each label."""
    coded, codebooks = vector_codes(vectors, **options)
    digest = hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    totals = materialize(totals, "label-errors", true_size=True)
    columns = ["vec_id", "code", "error", "label_error"]
    named = join_groups(coded.where("label is not null"), totals.where("label is not null"), ["label"], "rows")
    # A null label is a label too: one number.
    of_null = totals.where("label is null").select("label_error").head()
    nameless = coded.where("label is null").withColumn(
        "label_error", F.lit(None if of_null is None else of_null[0]).cast("bigint")
    )
    out = named.select(columns).unionByName(nameless.select(columns))
    return out.withColumn("codebooks_sha256", F.lit(digest))
