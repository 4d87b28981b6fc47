"""Group and global aggregates.

All are partial / final aggregations: tasks reduce their own rows before the
shuffle, so a hot group costs one row per task, not its row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.exact import exact_mean, exact_sums
from podium.functions.names import free_name, quoted
from podium.functions.ordering import best_first_key
from podium.sources.scratch import materialize


def _rounded(value: Column, digits: int | None) -> Column:
    # The order in which doubles are added is not fixed, so the last digits of
    # a mean can differ between runs. Rounding gives a stable result.
    return value if digits is None else F.round(value, digits)


def group_max(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    return df.groupBy(quoted(key)).agg(F.max(quoted(measure)).alias(name))


def group_count(df: DataFrame, key: str, name: str = "count") -> DataFrame:
    return df.groupBy(quoted(key)).agg(F.count("*").alias(name))


def group_avg(
    df: DataFrame, key: str, measure: str, name: str, digits: int | None = None, *, exact: bool = False
) -> DataFrame:
    """Mean of ``measure`` per key; NULLs are skipped.

    With ``exact`` it is the double nearest to the exact mean of a numeric
    measure, the same bits however the rows are dealt; without, its last digits
    may change with the order of the additions, and ``digits`` rounds them off.
    A decimal is summed exactly in both cases, and its mean is a decimal.
    """
    dtype = df.schema[measure].dataType
    if not exact or isinstance(dtype, T.DecimalType):
        return df.groupBy(quoted(key)).agg(_rounded(F.avg(quoted(measure)), digits).alias(name))
    sums = exact_sums(df, {"key": F.col(quoted(key))}, F.col(quoted(measure)), dtype)
    return sums.select(F.col("key").alias(key), _rounded(exact_mean(), digits).alias(name))


def group_first(
    df: DataFrame,
    key: str,
    value: str,
    order: Sequence[str],
    name: str,
    *,
    prune: bool = True,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``value`` of the first row of each group under ``order`` (ascending, NULL first).

    The order is part of the aggregate, so the result does not depend on how
    the rows arrive. ``prune`` is that of ``argmax_per_group``. ``also`` names
    further aggregates over all rows of each group; with ``prune`` the pass
    that finds the groups' first values computes them too.
    """
    lead, extra = F.col(quoted(order[0])), dict(also or {})
    added = [column.alias(n) for n, column in extra.items()]
    own_key, own_lead, best = (free_name([*extra, key, name], n) for n in ("_key", "_lead", "_best"))
    # Numbered, as two columns of the order may differ only in what a struct's fields cannot.
    row = F.struct(
        *[F.col(quoted(c)).alias(f"o{i}") for i, c in enumerate(order)], F.col(quoted(value)).alias("value")
    )
    extras = [F.col(quoted(n)) for n in extra]
    if not prune:
        found = df.groupBy(F.col(quoted(key)).alias(own_key)).agg(F.min(row).alias(best), *added)
        return found.select(F.col(own_key).alias(key), F.col(f"{best}.value").alias(name), *extras)
    first = F.when(F.max(lead.isNull()), None).otherwise(F.min(lead))
    starts = df.groupBy(F.col(quoted(key)).alias(own_key)).agg(first.alias(own_lead), *added)
    starts = materialize(starts, "starts", true_size=True)
    rows = df.select(F.col(quoted(key)).alias("k"), row.alias("r")).join(
        starts.select(own_key, own_lead),
        F.col("k").eqNullSafe(F.col(own_key)) & F.col("r.o0").eqNullSafe(F.col(own_lead)),
        "left_semi",
    )
    k, r = free_name(starts.columns, "k"), free_name(starts.columns, "r")
    found = rows.groupBy(F.col("k").alias(k)).agg(F.min("r").alias(r))
    if extra:
        found = found.join(starts, F.col(k).eqNullSafe(F.col(own_key)))
    return found.select(F.col(k).alias(key), F.col(f"{r}.value").alias(name), *extras)


def argmax_per_group(
    df: DataFrame, group: str, entity: str, measure: str, *, prune: bool = True
) -> DataFrame:
    """(group, entity, measure) of the row with the largest measure in each group.

    Entity and measure come from the same row. Ties go to the lowest entity; a
    group whose measures are all NULL still names its lowest entity.

    A first hash aggregate finds every group's maximum; only rows that reach
    their own group's maximum go on to the second, which takes the lowest
    entity. ``prune=False`` reads ``df`` once instead, with a minimum over
    structs, which Spark aggregates by sorting: for costly or small inputs.
    """
    keys = [k.alias(f"_{i}") for i, k in enumerate(best_first_key(df, measure))]
    if prune:
        rows = df.select(
            F.col(quoted(group)).alias("g"), F.col(quoted(entity)).alias("e"), F.col(quoted(measure)).alias("m")
        )
        best = rows.groupBy(F.col("g").alias("bg")).agg(F.max("m").alias("best"))
        best = materialize(best, "group-maxima", true_size=True)
        reached = F.col("g").eqNullSafe(F.col("bg")) & F.col("m").eqNullSafe(F.col("best"))
        # The maximum of a group is one value: the join brings it along.
        firsts = rows.join(best, reached, "left_semi").groupBy("g", "m").agg(F.min("e").alias("e"))
        return firsts.select(
            F.col("g").alias(group), F.col("e").alias(entity), F.col("m").alias(measure)
        )
    best = F.min(F.struct(*keys, F.col(quoted(entity)).alias("_e"), F.col(quoted(measure)).alias("_m")))
    return (
        df.groupBy(F.col(quoted(group)).alias("g"))
        .agg(best.alias("best"))
        .select(
            F.col("g").alias(group),
            F.col("best._e").alias(entity),
            F.col("best._m").alias(measure),
        )
    )


def overall_avg(
    df: DataFrame, measure: str, name: str, where: Column | None = None, digits: int | None = None
) -> DataFrame:
    """One row: the mean of ``measure`` over the rows of one cohort, or over all."""
    rows = df if where is None else df.where(where)
    return rows.agg(_rounded(F.avg(quoted(measure)), digits).alias(name))


def pct_change(
    df: DataFrame,
    measure: str,
    previous: Column,
    current: Column,
    *,
    mean_digits: int | None = None,
    pct_digits: int | None = None,
) -> DataFrame:
    """One row: both cohorts' means, the percent change and its direction.

    ``previous`` and ``current`` select the cohorts, and one pass over the rows
    of either serves both means. A missing or zero previous mean gives NULL.
    The change is that of the mean of ``measure`` as stored: for a logged
    measure it is the change of the mean logarithm.
    """
    means = df.where(previous | current).agg(
        F.avg(F.when(previous, F.col(quoted(measure)))).alias("_prev"),
        F.avg(F.when(current, F.col(quoted(measure)))).alias("_curr"),
    )
    pct = F.try_divide(F.col("_curr") - F.col("_prev"), F.col("_prev")) * 100
    direction = (
        F.when(F.col("_curr") > F.col("_prev"), "up")
        .when(F.col("_curr") < F.col("_prev"), "down")
        .when(F.col("_curr") == F.col("_prev"), "flat")
    )
    return means.select(
        _rounded(F.col("_prev"), mean_digits).alias("mean_previous"),
        _rounded(F.col("_curr"), mean_digits).alias("mean_current"),
        _rounded(pct, pct_digits).alias("pct_change"),
        direction.alias("direction"),
    )


def first_value(df: DataFrame) -> object | None:
    """First column of the first row, or None for an empty frame. An action."""
    row = df.head()
    return None if row is None else row[0]
