"""Sort keys for measures, shared by the top-k, arg-max and rank operators.

One order is used everywhere: largest measure first, NULL last, then the tie
keys ascending. NaN counts as larger than any number, as it does in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.names import quoted


def best_first(measure: str, ties: Sequence[str] = ()) -> list[Column]:
    """Arguments for ``orderBy``: best measure first, ties by ``ties``."""
    return [F.desc_nulls_last(quoted(measure)), *(F.asc_nulls_first(quoted(t)) for t in ties)]


def best_first_key(df: DataFrame, measure: str) -> list[Column]:
    """Columns whose *ascending* order is the best-first order of ``measure``.

    They make the order usable inside an aggregate, where ``min`` of a struct
    gives the best row without a window or a sort by the measure.
    """
    m = F.col(quoted(measure))
    dtype = df.schema[measure].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return [m.isNull(), ~F.isnan(m), -m]
    if isinstance(dtype, T.IntegralType):
        # Bitwise NOT is -m - 1: it reverses the order and cannot overflow.
        return [m.isNull(), F.bitwise_not(m)]
    if isinstance(dtype, T.DecimalType):
        return [m.isNull(), -m]
    raise TypeError(f"measure {measure!r} must be numeric, not {dtype.simpleString()}")
