"""Physical layout: partitions by row count, and scoped persistence."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.names import free_name

# Fixed value: the analysis sizes its partitions by this many rows.
ROWS_PER_PARTITION = 100_000


def target_partitions(n_rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """ceil(rows / rows per partition), at least 1."""
    return max(1, math.ceil(n_rows / rows_per_partition))


def partition_count(df: DataFrame) -> int:
    """Partitions of ``df``, with or without rows. Rows are not computed, but for
    the shuffles below, if adaptive execution has yet to decide on their partitions."""
    return df.rdd.getNumPartitions()


def partition_sizes(df: DataFrame) -> dict[int, int]:
    """Rows of each partition that has any, by its number. An action: it computes ``df``."""
    per_partition = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    return {r["p"]: r["n"] for r in per_partition.collect()}


def filled_partition_count(df: DataFrame) -> int:
    """Partitions that have rows. An action: it computes ``df``."""
    return len(partition_sizes(df))


def repartition_by_rows(
    df: DataFrame, rows_per_partition: int = ROWS_PER_PARTITION, *, merge: str = "bounded"
) -> DataFrame:
    """Spread ``df`` over ceil(rows / ``rows_per_partition``) partitions of at most so many rows.

    Fewer partitions than now are merged without a shuffle: with ``merge="bounded"``
    where the merged ones keep the bound, with ``"always"`` in any case, as
    ``coalesce`` does, the bound then being a mean. Else the rows are dealt out
    exactly: a row's number, from prefix sums over the partitions' measured
    sizes, says which partition it goes to, and all but the last are full.

    One aggregate measures ``df``, which is then computed again: write a costly
    one, or one whose rows come in another order each time, first
    (``materialize``). Partitions keep to their place when they are merged only
    if the input has no preferred hosts; with such, the bound is about kept.
    """
    if merge not in ("bounded", "always"):
        raise ValueError(f"merge must be 'bounded' or 'always', not {merge!r}")
    sizes, n_partitions = partition_sizes(df), partition_count(df)
    target = target_partitions(sum(sizes.values()), rows_per_partition)
    if target <= n_partitions:
        if merge == "always" or max(_merged(sizes, n_partitions, target), default=0) <= rows_per_partition:
            return df if target == n_partitions else df.coalesce(target)
    return _dealt(df, sizes, n_partitions, rows_per_partition, target)


def _merged(sizes: dict[int, int], n_partitions: int, target: int) -> list[int]:
    """Rows of each partition after neighbours are merged to ``target`` of them, as ``coalesce`` does."""
    bounds = [i * n_partitions // target for i in range(target + 1)]
    return [sum(sizes.get(p, 0) for p in range(a, b)) for a, b in zip(bounds, bounds[1:])]


def _dealt(df: DataFrame, sizes: dict[int, int], n_partitions: int, rows: int, target: int) -> DataFrame:
    """The i-th row of all goes to partition i // ``rows``: one exchange, by number."""
    before = itertools.accumulate((sizes.get(p, 0) for p in range(n_partitions)), initial=0)
    bases = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    place = free_name(df.columns, "_place")
    # The number of a row within its partition, from 0.
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    number = F.get(bases, F.spark_partition_id()) + within
    # Were there more rows than measured, they would go to the last partition.
    numbered = df.withColumn(place, F.least(F.floor(number / rows), F.lit(target - 1)).cast("int"))
    return numbered.repartitionById(target, F.col(place)).drop(place)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep ``frames`` cached for the length of a ``with`` block.

    Spark is lazy: write or collect every result inside the block, or it is
    computed afterwards without the cache.
    """
    cached = tuple(df.persist(StorageLevel.MEMORY_AND_DISK) for df in frames)
    try:
        yield cached
    finally:
        for df in cached:
            release(df)


def release(df: DataFrame) -> None:
    df.unpersist(blocking=True)


def release_all(spark: SparkSession) -> None:
    """Drop every cached table of the session, the caller's own included."""
    spark.catalog.clearCache()
