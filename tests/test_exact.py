"""Exact means against rational arithmetic, under any dealing of the rows."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from podium import operators as op
from podium.functions.exact import exact_order, exact_sums
from pyspark.sql import functions as F


def nearest(values):
    """The double nearest to the mean, by rational numbers; NaN and infinities as sums have them."""
    values = [v for v in values if v is not None]
    if not values:
        return None
    odd = [v for v in values if not math.isfinite(v)]
    if odd:
        return sum(odd)
    mean = sum(map(Fraction, values)) / len(values)
    return mean.numerator / mean.denominator


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else float(x).hex()


def wide(rng):
    kind = rng.random()
    if kind < 0.1:
        return None
    if kind < 0.2:
        return rng.choice([0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308, -1.7976931348623157e308])
    if kind < 0.5:
        return rng.uniform(-1, 1) * 2.0 ** rng.randint(-1060, 1020)
    if kind < 0.6:
        # On both sides of the border between two grids.
        edge = 2.0 ** (16 * rng.randint(-60, 60) - 1074 + 1072)
        return rng.choice([edge, math.nextafter(edge, 0), math.nextafter(edge, math.inf)])
    return round(rng.uniform(-1e6, 1e6), 2)


def data(n=4000):
    rng = random.Random(8)
    out = [(rng.choice(["hot", "hot", "hot", "a", "b", None, f"k{i % 300}"]), wide(rng)) for i in range(n)]
    for key, odd in (("up", [math.inf, 1.0]), ("down", [-math.inf]), ("none", [math.nan, 1.0]), ("both", [math.inf, -math.inf])):
        out += [(key, x) for x in odd]
    return out + [("empty", None)]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_means_are_nearest_doubles_however_dealt(spark, partitions):
    rows = data()
    random.Random(partitions).shuffle(rows)
    groups = defaultdict(list)
    for k, x in rows:
        groups[k].append(x)
    df = spark.createDataFrame(rows, "`a key` string, `x.y` double").repartition(partitions)
    got = op.group_avg(df, "a key", "x.y", "mean", exact=True)
    assert got.columns == ["a key", "mean"]
    assert {k: bits(m) for k, m in got.collect()} == {k: bits(nearest(v)) for k, v in groups.items()}


def test_the_order_of_means_is_exact(spark):
    rows = [(k, x) for k, x in data() if x is not None]
    groups = defaultdict(list)
    for k, x in rows:
        groups[k].append(x)
    # One unit in the last place of one of many rows, far below the mean's own precision.
    for k in range(5):
        groups[f"close{k}"] = [1e300, 5e-324 * k, -1e300, 1.0, 1.0]
        rows += [(f"close{k}", x) for x in groups[f"close{k}"]]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    sums = exact_sums(df, {"key": F.col("k")}, F.col("x"), df.schema["x"].dataType)
    got = [r.key for r in sums.orderBy(exact_order(), F.col("key").asc_nulls_first()).collect()]

    def place(k):
        values = groups[k]
        odd = [v for v in values if not math.isfinite(v)]
        if odd:
            s = sum(odd)
            return (3, 0) if math.isnan(s) else (2, 0) if s > 0 else (0, 0)
        return (1, sum(map(Fraction, values)) / len(values))

    assert got == sorted(groups, key=lambda k: (place(k), k is not None, k or ""))
    means = dict(op.group_avg(df, "k", "x", "m", exact=True).collect())
    assert len({means[f"close{k}"] for k in range(5)}) == 1


@pytest.mark.parametrize("digits", [None, 6, 0])
def test_best_mean_is_found_before_rounding(spark, digits):
    df = spark.createDataFrame([("a", 1.0000001), ("b", 1.0000004), ("c", 0.5)], "e string, m double")
    best = op.best_mean(df, F.lit(True), "e", "m", "mean", digits).collect()
    assert [tuple(r) for r in best] == [("b", 1.0000004 if digits is None else 1.0)]


def test_best_mean_of_one_double_and_of_equal_means(spark):
    rows = [("a", 1e16), ("a", 1.0), ("a", -1e16), ("b", 1e16), ("b", 1.0000000000000002), ("b", -1e16)]
    rows += [("c", 1e16), ("c", 1.0000000000000002), ("c", -1e16)]
    df = spark.createDataFrame(rows, "e string, m double")
    for n in (1, 3, 9):
        best = op.best_mean(df.repartition(n), F.lit(True), "e", "m", "mean").collect()
        assert best[0].e == "b"
    assert op.best_mean(df, F.lit(False), "e", "m", "mean").collect() == []


def test_whole_numbers_beyond_doubles(spark):
    rows = [("a", 2**62 + 1), ("a", 2**62 - 1), ("b", 2**62), ("b", 2**62 + 1), ("c", -(2**63)), ("c", None)]
    df = spark.createDataFrame(rows, "e string, m bigint")
    got = dict(op.group_avg(df, "e", "m", "mean", exact=True).collect())
    assert got == {"a": float(2**62), "b": float(2**62), "c": -(2.0**63)}
    assert op.best_mean(df, F.lit(True), "e", "m", "mean").head().e == "b"


def test_decimals_and_floats(spark):
    df = spark.createDataFrame([("a", "1.10"), ("a", "1.20"), ("b", "1.16")], "e string, t string")
    decimals = df.select("e", F.col("t").cast("decimal(10,2)").alias("m"))
    assert op.best_mean(decimals, F.lit(True), "e", "m", "mean").head().e == "b"
    floats = df.select("e", F.col("t").cast("float").alias("m"))
    assert op.best_mean(floats, F.lit(True), "e", "m", "mean").head().e == "b"


def test_no_rows(spark):
    df = spark.createDataFrame([], "e string, m double")
    assert op.group_avg(df, "e", "m", "mean", exact=True).collect() == []


def test_only_group_rows_reach_python(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.rand(1).alias("x"))
    plan = op.group_avg(df, "k", "x", "mean", exact=True)._jdf.queryExecution().executedPlan().toString()
    # The top-most step, above both aggregates.
    assert plan.index("ArrowEvalPython") < plan.index("HashAggregate")
