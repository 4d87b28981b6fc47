"""Ranks inside partitions, built so that no task receives a whole partition.

The ranked partitions are few and large (the years of a panel), so a plain
window would sort each of them in one task. These operators give the window's
exact result (``rank``: ties share a rank, gaps follow, NULL last) without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.names import free_name, quoted
from podium.operators.ranges import Ranges, free_names, range_count, splitter_value, task_count, value_ranges
from podium.operators.topk import sort_desc, top1
from podium.sources.scratch import materialize


def rank_in_partition(
    df: DataFrame,
    partition: str,
    measure: str,
    name: str = "ranking",
    *,
    rows_per_task: int = 5_000_000,
) -> DataFrame:
    """``df`` plus its rank by ``measure``, largest first, inside ``partition``.

    Both columns may be of any type that Spark can order: numbers, dates,
    timestamps, strings, booleans, structs. A column called ``name`` is
    replaced, as ``withColumn`` does.

    The rows are dealt once, to ranges of (partition, measure) of about
    ``rows_per_task`` rows, and ranked there; a task ranks several ranges, one
    after the other, where there are more than ``task_count`` says. A partition that goes on in the
    ranges behind adds these ranges' rows of it, which are all better: prefix
    sums over a row for each such range, at most as many as ranges, hence the
    broadcast. A value that fills ranges by itself has one of its own, dealt to
    several tasks; its rows share their rank.

    Needs jobs of its own (row count, sample); ``df`` must give the same rows
    each time it is read.
    """
    rows = df.drop(name) if name in df.columns and name not in (partition, measure) else df
    n_rows = df.count()
    ranges = value_ranges(df, [partition, measure], n_rows, range_count(df, n_rows, rows_per_task))
    number, part, task, inside, own, at, ahead = free_names(
        df.withColumn(name, F.lit(0)), "_range", "_part", "_task", "_inside", "_own", "_at", "_ahead"
    )
    p, best_first = F.col(quoted(partition)), F.desc_nulls_last(quoted(measure))
    dealt = ranges.deal(rows, number, part, task, task_count(df, n_rows))
    ranked = dealt.withColumn(inside, F.rank().over(Window.partitionBy(task, part, p).orderBy(best_first)))
    place = F.col(inside).cast("bigint")
    if ranges.count > 1:
        crossing = _crossing(df, partition, ranges).select(
            F.col("p").alias(own), F.col("range").alias(at), F.col("ahead").alias(ahead)
        )
        same = p.eqNullSafe(F.col(own)) & (F.col(number) == F.col(at))
        ranked = ranked.join(F.broadcast(crossing), same, "left")
        place = place + F.coalesce(F.col(ahead), F.lit(0))
    columns = [F.col(quoted(c)) for c in df.columns]
    if name in df.columns:
        return ranked.select(*[place.alias(name) if c == name else F.col(quoted(c)) for c in df.columns])
    return ranked.select(*columns, place.alias(name))


def _crossing(df: DataFrame, partition: str, ranges: Ranges) -> DataFrame:
    """(p, range, ahead): rows of partition ``p`` in the ranges behind each range, where there are any.

    Only partitions of a splitter can go on in another range, so the others are
    not counted where a splitter surely holds the partition's own value.
    """
    kind = df.schema[partition].dataType
    p = F.col(quoted(partition))
    found = df.select(p.alias("p"), ranges.find().alias("range"))
    if isinstance(kind, (T.NumericType, T.StringType, T.DateType, T.BooleanType)):
        edges = df.sparkSession.range(1).select(F.explode(ranges.splitters).alias("s"))
        edges = edges.select(F.col("s.c0").alias("e")).distinct()
        found = found.join(F.broadcast(edges), splitter_value(F.col("p"), kind).eqNullSafe(F.col("e")), "left_semi")
    counts = found.groupBy("p", "range").agg(F.count("*").alias("n"))
    behind = Window.partitionBy("p").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("ahead", F.sum("n").over(behind)).where("ahead > 0")


def first_place_counts(
    df: DataFrame, partition: str, measure: str, entity: str, name: str = "count"
) -> DataFrame:
    """How often each entity ranks first, over all partitions; most wins first.

    Every row that ties for first place counts. A partition whose measures are
    all NULL is a tie of all its rows.

    Rank 1 means "equal to the partition's maximum", so no window is needed:
    one aggregate finds the maxima, and a second pass counts the rows that
    reach them. No row below the lowest maximum can win, so the second pass
    drops those; it counts before the join with the maxima, so a tie of any size
    leaves a row for each task and entity.
    """
    keys = df.select(
        F.col(quoted(partition)).alias("p"),
        F.col(quoted(measure)).alias("v"),
        F.col(quoted(entity)).alias("e"),
    )
    best = materialize(
        keys.groupBy(F.col("p").alias("bp")).agg(F.max("v").alias("best")), "maxima", true_size=True
    )
    lowest = best.agg(F.min("best")).scalar()
    counts = keys.where((F.col("v") >= lowest) | F.col("v").isNull()).groupBy("p", "v", "e")
    firsts = counts.agg(F.count("*").alias("n")).join(
        best,
        F.col("p").eqNullSafe(F.col("bp")) & F.col("v").eqNullSafe(F.col("best")),
        "left_semi",
    )
    wins = firsts.groupBy(F.col("e").alias(entity)).agg(F.sum("n").alias(name))
    return sort_desc(wins, name, [entity])


def rank_of_argmax(
    df: DataFrame,
    partition: str,
    value: object,
    pick_by: str,
    rank_by: str,
    keys: Sequence[str],
    name: str = "ranking",
) -> DataFrame:
    """(keys, name): of the partition ``value``, the row with the largest ``pick_by``,
    and its rank by ``rank_by`` among all rows of that partition.

    The rank is 1 + the number of rows with a larger ``rank_by`` (with any
    value, when the row's own is NULL), so two parallel passes replace the
    window. The joined side is the one row of a top-1, hence the broadcast.
    """
    rows = df.where(F.col(quoted(partition)).eqNullSafe(F.lit(value)))
    own, of, v, peer = (free_name(keys, c) for c in ("_own", "_of", "_v", "_peer"))
    leader = top1(rows, pick_by, keys).select(
        F.col(quoted(rank_by)).alias(own), F.col(quoted(partition)).alias(of), *keys
    )
    peers = rows.select(F.col(quoted(rank_by)).alias(v), F.col(quoted(partition)).alias(peer))
    ahead = (F.col(v) > F.col(own)) | (F.col(own).isNull() & F.col(v).isNotNull())
    return (
        peers.join(F.broadcast(leader), F.col(peer).eqNullSafe(F.col(of)))
        .groupBy(*keys)
        .agg((F.count_if(ahead) + 1).alias(name))
    )
