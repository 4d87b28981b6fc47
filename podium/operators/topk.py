"""Sorts and top-k. ``orderBy`` + ``limit`` plans as TakeOrderedAndProject: each
task keeps its own best k rows, and only those are merged. ``top_rows`` selects
a large k without a merge.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.exact import exact_mean, exact_order, exact_sums
from podium.functions.names import free_name, quoted
from podium.functions.ordering import best_first
from podium.operators.aggregate import group_avg
from podium.operators.ranges import range_count, value_ranges


def sort_desc(df: DataFrame, measure: str, ties: Sequence[str] = ()) -> DataFrame:
    """All rows, best first. ``ties`` also lets the range partitioner cut a run
    of equal measures, so one frequent value does not fill one task.
    """
    return df.orderBy(*best_first(measure, ties))


def top_k(df: DataFrame, measure: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The best ``k`` rows, in order. They are merged in one task: for a large ``k`` see ``top_rows``."""
    return df.orderBy(*best_first(measure, ties)).limit(k)


def top_rows(
    df: DataFrame, measure: str, k: int, ties: Sequence[str] = (), *, rows_per_range: int = 1_000_000
) -> DataFrame:
    """The best ``k`` rows of ``df`` for a ``k`` of any size, in no order (``sort_desc`` gives one).

    The measure's ranges are counted, best first, up to the one in which the
    k-th row lies. The rows of better ranges are taken as they are; no row is
    exchanged for that. Of the k-th row's range, of about ``rows_per_range``
    rows, the best ones are found as in ``top_k``. Where that range holds a
    single value, the same is done with the first of ``ties``, and so on; of
    rows that are equal in all of them, each partition gives its first ones,
    up to the number that is missing.

    All columns may be of any type that Spark can order. Needs jobs of its own,
    a count for each column in the order at most; ``df`` must give the same
    rows, in the same partitions, each time it is read.
    """
    if k <= 0:
        return df.limit(0)
    order = [(measure, True), *((t, False) for t in ties)]
    number = free_name(df.columns, "_range")
    n_rows = df.count()
    if n_rows <= k:
        return df
    taken: DataFrame | None = None
    rows = df
    while True:
        column, descending = order[0]
        ranges = value_ranges(rows, [column], n_rows, range_count(rows, n_rows, rows_per_range))
        counts = dict(rows.groupBy(ranges.find().alias(number)).agg(F.count("*")).collect())
        in_order = range(ranges.count - 1, -1, -1) if descending else range(ranges.count)
        edge, before = _edge(counts, in_order, k)
        behind = ranges.reaches(edge + 1)
        whole = rows.where(behind if descending else ~ranges.reaches(edge))
        taken = whole if taken is None else taken.unionByName(whole)
        rows, k, n_rows = rows.where(ranges.reaches(edge) & ~behind), k - before, counts[edge]
        if k == n_rows:
            return taken.unionByName(rows)
        if not ranges.is_single[edge]:
            (first, down), *rest = order
            keys = [F.desc_nulls_last(quoted(first)) if down else F.asc_nulls_first(quoted(first))]
            keys += [F.asc_nulls_first(quoted(t)) for t, _ in rest]
            return taken.unionByName(rows.orderBy(*keys).limit(k))
        order = order[1:]
        if not order:
            return taken.unionByName(_some(rows, k))


def _edge(counts: dict[int, int], in_order: Iterable[int], k: int) -> tuple[int, int]:
    """The range in which the ``k``-th row lies, and the rows in the ranges before it."""
    before = 0
    for r in in_order:
        if before + counts.get(r, 0) >= k:
            return r, before
        before += counts.get(r, 0)
    raise ValueError("fewer rows than counted: the table must give the same rows each time it is read")


def _some(rows: DataFrame, k: int) -> DataFrame:
    """``k`` rows of ``rows``: the first ones of each partition, as many as are missing. No exchange."""
    pid, place = free_name(rows.columns, "_pid"), free_name(rows.columns, "_place")
    sizes = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    quota, left = {}, k
    for p, n in sorted(sizes):
        quota[p] = min(n, left)
        left -= quota[p]
    numbered = rows.withColumns(
        {pid: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}
    )
    most = F.split(F.lit(",".join(str(quota.get(p, 0)) for p in range(max(quota) + 1))), ",").cast("array<bigint>")
    fits = F.col(place) < F.coalesce(F.get(most, F.col(pid)), F.lit(0))
    return numbered.where(fits).drop(pid, place)


def top1(df: DataFrame, measure: str, ties: Sequence[str] = ()) -> DataFrame:
    return top_k(df, measure, 1, ties)


def filtered_top1(
    df: DataFrame, where: Column, measure: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The best row among those that satisfy ``where``, with all its columns."""
    return top1(df.where(where), measure, ties)


def best_mean(
    df: DataFrame, where: Column, key: str, measure: str, name: str, digits: int | None = None
) -> DataFrame:
    """(key, name) of the key with the largest mean over the rows of ``where``.

    Means are compared exactly, also where they are one double or round to one
    at ``digits``, which concerns the output alone; equal means go to the
    lowest key. So the winner does not depend on the order of the rows. The
    means of decimals are compared as Spark gives them.
    """
    dtype = df.schema[measure].dataType
    rows = df.where(where)
    if isinstance(dtype, T.DecimalType):
        means = group_avg(rows, key, measure, "mean").select(
            F.col(quoted(key)).alias("key"), "mean", F.col("mean").alias("place")
        )
    else:
        sums = exact_sums(rows, {"key": F.col(quoted(key))}, F.col(quoted(measure)), dtype)
        means = sums.select("key", exact_mean().alias("mean"), exact_order().alias("place"))
    best = means.orderBy(*best_first("place", ["key"])).limit(1)
    mean = F.col("mean") if digits is None else F.round("mean", digits)
    return best.select(F.col("key").alias(key), mean.alias(name))


def winner_rows(df: DataFrame, winner: DataFrame, key: str, where: Column) -> DataFrame:
    """The rows of ``where`` that belong to the winner of a top-1; none without a winner.

    The winner is found when this is called, and its key becomes a filter, which
    reaches the scan. A ``winner`` of more than one row raises.
    """
    found = winner.select(quoted(key)).head(2)
    if len(found) > 1:
        raise ValueError("winner_rows takes the one row of a top-1")
    if not found:
        return df.where(F.lit(False))
    return df.where(where & F.col(quoted(key)).eqNullSafe(F.lit(found[0][0])))
