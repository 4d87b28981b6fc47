"""Sums and means of doubles that are exact, whatever the order of the rows.

A double is a whole number times a power of two. It is split into three whole
numbers below 2**27 in size, relative to one of 133 fixed grids, by its
exponent; 64-bit sums of these are exact for 2**36 rows of a group, and do not
depend on how the rows are dealt or on which task adds first. Both sums and
split are JVM-side. What is left is a row for each group and grid in use; only
these are joined to one Python integer per group, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exponents that share a grid, and the unit of the lowest grid: 2 ** -UNIT.
# The lowest exponent is -1074, and a double has 52 bits behind its first one;
# one more bit allows for a logarithm that is rounded up to the next exponent.
_GRID = 16
_LOWEST = 1074
UNIT = _LOWEST + 53
# Bits of a fraction that tell apart any two different means of up to 2**63 rows.
_FRACTION = 127
# Bytes of a mean as an ordered key: sign, 1024 bits before the point, the rest behind it.
_KEY_BYTES = (1024 + UNIT + _FRACTION + 8) // 8 + 1


def _doubles(numbers: Iterable[float]) -> Column:
    """An array of constants, folded into one literal."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")


def _with_limbs(rows: DataFrame, dtype: T.DataType) -> DataFrame:
    """``rows`` with ``x`` as (high * 2**44 + middle * 2**22 + low) * 2 ** (shift - UNIT), whole numbers.

    Column by column, so that none is computed anew in those after it.
    """
    x = F.col("x")
    if isinstance(dtype, T.IntegralType):
        low_bits = F.lit((1 << 22) - 1)
        return rows.withColumns(
            {
                "shift": F.when(x.isNotNull(), F.lit(UNIT)),
                "high": F.shiftright(x, 44),
                "middle": F.shiftright(x, 22).bitwiseAND(low_bits),
                "low": x.bitwiseAND(low_bits),
            }
        )
    # The logarithm of zero is null, and the place of infinities and NaN is made so.
    exponent = F.floor(F.log2(F.when(F.abs(x) < float("inf"), F.abs(x))))
    rows = rows.withColumn("shift", F.greatest(F.floor((exponent + _LOWEST) / _GRID), F.lit(0)).cast("int"))
    # ``greatest`` skips nulls.
    rows = rows.withColumn("shift", F.when((F.abs(x) > 0) & (F.abs(x) < float("inf")), F.col("shift")))
    # Powers of two, looked up; the product of both alone may be too large for a double.
    ups = [UNIT - _GRID * i for i in range((1023 + _LOWEST) // _GRID + 1)]
    scale = F.element_at(_doubles(2.0 ** (up // 2) for up in ups), F.col("shift") + 1)
    other = F.element_at(_doubles(2.0 ** (up - up // 2) for up in ups), F.col("shift") + 1)
    rows = rows.withColumns({"low": x * scale * other, "shift": F.col("shift") * _GRID})
    for name, unit in (("high", 1 << 44), ("middle", 1 << 22)):
        rows = rows.withColumn(name, F.floor(F.col("low") / F.lit(float(unit))))
        rows = rows.withColumn("low", F.col("low") - F.col(name).cast("double") * F.lit(float(unit)))
    return rows.withColumn("low", F.col("low").cast("bigint"))


def exact_sums(df: DataFrame, keys: Mapping[str, Column], measure: Column, dtype: T.DataType) -> DataFrame:
    """A row for each group: ``keys``, ``n`` (rows with a value) and its sum in parts.

    No key is called ``x``, ``shift``, ``high``, ``middle``, ``low``, ``n``,
    ``parts`` or ``special``. ``special`` is the sum of the group's NaN and
    infinite values, null if it has none. A hot group sends a row per task and grid.
    """
    x = measure.cast("bigint" if isinstance(dtype, T.IntegralType) else "double")
    rows = df.select(*[c.alias(n) for n, c in keys.items()], x.alias("x"))
    split = _with_limbs(rows, dtype)
    is_finite = F.lit(True) if isinstance(dtype, T.IntegralType) else F.abs("x") < float("inf")
    by_grid = split.groupBy(*keys, "shift").agg(
        F.count("x").alias("n"),
        F.sum(F.when(~is_finite, F.col("x").cast("double"))).alias("special"),
        *[F.sum(c).alias(c) for c in ("high", "middle", "low")],
    )
    parts = F.collect_list(F.when(F.col("shift").isNotNull(), F.struct("shift", "high", "middle", "low")))
    return by_grid.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("special").alias("special"), parts.alias("parts")
    )


def _joined(finish: Callable[[int, float | None, int], object], dtype: str, arrow: pa.DataType) -> Column:
    """``finish(rows, special, sum in units of 2 ** -UNIT)`` of each row of ``exact_sums``."""

    # Inside, so that it is sent whole: executors need no installed copy of this package.
    def join(n: pa.Array, special: pa.Array, *parts: pa.Array) -> pa.Array:
        out = []
        for rows, odd, *lists in zip(n.to_pylist(), special.to_pylist(), *[p.to_pylist() for p in parts]):
            total = 0
            for shift, high, middle, low in zip(*lists):
                total += ((high << 44) + (middle << 22) + low) << shift
            out.append(finish(rows, odd, total) if rows else None)
        return pa.array(out, arrow)

    # The names by which the UDF's type is read, which an inner function has not.
    join.__annotations__ = {"return": pa.Array, "n": pa.Array, "special": pa.Array, "parts": pa.Array}
    parts = [F.col(f"parts.{c}") for c in ("shift", "high", "middle", "low")]
    return F.arrow_udf(join, dtype)(F.col("n"), F.col("special"), *parts)


def exact_mean() -> Column:
    """The mean of a row of ``exact_sums``: the double nearest to the exact one; null without values."""

    def mean(rows: int, odd: float | None, total: int) -> float:
        # The quotient of two Python integers is rounded once, correctly.
        return total / (rows << UNIT) if odd is None else odd

    return _joined(mean, "double", pa.float64())


def exact_order() -> Column:
    """Bytes whose order is that of the exact means, NaN being the largest; null without values.

    Different means have different bytes even where they round to one double.
    """

    def place(rows: int, odd: float | None, total: int) -> bytes:
        if odd is not None:
            return {"-inf": b"\x00", "inf": b"\xff", "nan": b"\xff\xff"}[str(odd)]
        number = (total << _FRACTION) // rows + (1 << (8 * _KEY_BYTES - 9))
        return b"\x01" + number.to_bytes(_KEY_BYTES - 1, "big")

    return _joined(place, "binary", pa.binary())
