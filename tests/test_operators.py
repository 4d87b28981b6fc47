"""Operators against brute force and on edge cases."""

from __future__ import annotations

import math
import os
import random
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from podium import operators as op
from podium import sources as src
from podium.functions import Rule, classify, classify_udf
from podium.functions.continents import AFRICA, EUROPE, continent_rules
from pyspark.sql import functions as F

SCHEMA = "id bigint, p string, m double"


def rows(df):
    return [tuple(r) for r in df.collect()]


def worth(m):
    """Sort key: larger is better; NaN above all numbers, NULL below all."""
    if m is None:
        return (0, 0.0)
    return (2, 0.0) if math.isnan(m) else (1, m)


def brute_ranks(data):
    return {
        i: 1 + sum(worth(other) > worth(m) for _, q, other in data if q == p)
        for i, p, m in data
    }


def hot_data(n=1200, seed=3):
    """One partition and one value hold a third of the rows each; NULLs, NaN, -0.0."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        p = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, f"tiny{i % 50}"])
        pick = rng.random()
        if pick < 0.33:
            m = 5.0
        elif pick < 0.43:
            m = None
        elif pick < 0.46:
            m = math.nan
        elif pick < 0.56:
            m = rng.choice([0.0, -0.0])
        elif pick < 0.58:
            m = rng.choice([math.inf, -math.inf])
        else:
            m = round(rng.uniform(-10, 10), 2)
        data.append((i, p, m))
    return data


@pytest.mark.parametrize("rows_per_task", [1, 20, 150, 1000, 10**6])
def test_rank_in_partition_equals_brute_force(spark, rows_per_task):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    ranked = op.rank_in_partition(df, "p", "m", rows_per_task=rows_per_task)
    assert ranked.columns == ["id", "p", "m", "ranking"]
    got = {r.id: r.ranking for r in ranked.collect()}
    assert got == brute_ranks(data)


@pytest.mark.parametrize("rows_per_task", [1, 10, 10**6])
def test_rank_has_one_schema_and_result_at_every_size(spark, rows_per_task):
    """Columns with names of the operator's own, dots, and the result's name."""
    own = ["_v", "_cell", "_p", "_c", "_better", "_n", "_rank", "p", "v", "n", "range", "a.b", "Ranking2"]
    data = [(i, f"g{i % 3}", float(i % 7), *(f"{c}{i}" for c in own), "old") for i in range(100)]
    df = spark.createDataFrame(data, ["id", "grp", "m", *own, "ranking"])
    ranked = op.rank_in_partition(df, "grp", "m", rows_per_task=rows_per_task)
    assert ranked.columns == df.columns
    assert ranked.schema["ranking"].dataType.simpleString() == "bigint"
    want = brute_ranks([r[:3] for r in data])
    got = sorted(rows(ranked))
    assert [r[:-1] for r in got] == [r[:-1] for r in data]
    assert {r[0]: r[-1] for r in got} == want


def test_rank_of_wide_types(spark):
    """Distinct values beyond the precision of a double stay apart."""
    data = [(i, "p", 2**60 + i % 200) for i in range(2000)]
    df = spark.createDataFrame(data, "id bigint, p string, m bigint")
    want = {i: 1 + 10 * (199 - i % 200) for i, _, _ in data}
    for wide in (df, df.withColumn("m", F.col("m").cast("decimal(38,6)"))):
        ranked = op.rank_in_partition(wide, "p", "m", rows_per_task=20)
        assert {r.id: r.ranking for r in ranked.collect()} == want


def test_ranks_need_no_join_threshold(spark):
    data = hot_data(600)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(data, SCHEMA)
        ranked = op.rank_in_partition(df, "p", "m", rows_per_task=10)
        assert {r.id: r.ranking for r in ranked.collect()} == brute_ranks(data)
        firsts = op.first_place_counts(df, "p", "m", "id")
        assert firsts.count() == sum(r == 1 for r in brute_ranks(data).values())
        text = firsts._jdf.queryExecution().sparkPlan().toString()
        assert text.index("LeftSemi") < text.index("partial_count(1)")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows_per_task", [8, 10**6])
def test_rank_exchanges_rows_once(spark, rows_per_task):
    df = spark.createDataFrame(hot_data(600), SCHEMA).repartition(4)
    text = op.rank_in_partition(df, "p", "m", rows_per_task=rows_per_task)._jdf.queryExecution().executedPlan().toString()
    rows_side = [line for line in text.split("\n") if "Exchange" in line and "Broadcast" not in line]
    # Of the rows: the exchange they come from, and one more. The others count by partition and range.
    assert sum("passthrough" in line or "SinglePartition" in line for line in rows_side) == 1
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_many_ranges_share_the_tasks(spark):
    data = hot_data(600)
    ranked = op.rank_in_partition(spark.createDataFrame(data, SCHEMA), "p", "m", rows_per_task=4)
    assert {r.id: r.ranking for r in ranked.collect()} == brute_ranks(data)
    # Of 150 ranges, not one task each.
    assert op.partition_count(ranked) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize(
    "kind", ["int", "string", "date", "timestamp", "timestamp_ntz", "boolean", "decimal(20,3)", "binary", "float", "struct<a:int,b:string>"]
)
def test_ranks_and_top_rows_of_any_type(spark, kind):
    """A third of all rows hold one value, a third one partition; ranks and top rows as Spark's own."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        pick = rng.random()
        v = None if pick < 0.05 else 77 if pick < 0.4 else rng.randrange(400)
        data.append((i, rng.choice([1, 1, 2, None, 3 + i % 60]), v))
    df = spark.createDataFrame(data, "id int, p int, v int").repartition(5)
    of = {
        "int": "{0}", "string": "concat(repeat('prefix', 50), lpad({0}, 4, '0'), 'é')", "date": "date_add(date'1990-01-01', {0})",
        "timestamp": "timestamp_micros({0} * 1001L + 999)", "timestamp_ntz": "cast(timestamp_micros({0} * 7L) as timestamp_ntz)",
        "boolean": "{0} > 100", "decimal(20,3)": "cast({0} * 1.001 as decimal(20,3))", "binary": "cast(lpad({0}, 4, '0') as binary)",
        "float": "cast({0} / 3 as float)", "struct<a:int,b:string>": "if({0} is null, null, named_struct('a', {0} div 10, 'b', cast({0} as string)))",
    }[kind]
    df = df.selectExpr("id", f"{of.format('p')} AS p", f"{of.format('v')} AS m")
    want = df.selectExpr("id", "rank() OVER (PARTITION BY p ORDER BY m DESC NULLS LAST) AS r")
    want = {r.id: r.r for r in want.collect()}
    for rows_per_task in (12,):
        ranked = op.rank_in_partition(df, "p", "m", rows_per_task=rows_per_task)
        assert {r.id: r.ranking for r in ranked.collect()} == want
    in_order = [r.id for r in df.orderBy(F.desc_nulls_last("m"), "id").collect()]
    for k in (1, 300, 899):
        top = op.top_rows(df, "m", k, ["id"], rows_per_range=20)
        assert top.columns == df.columns and sorted(r.id for r in top.collect()) == sorted(in_order[:k])


def test_top_rows_of_equal_rows(spark):
    data = [(i, 5.0 if i % 3 else float(i % 50), "same") for i in range(1200)]
    df = spark.createDataFrame(data, "id bigint, m double, _range string").repartition(7)
    for k in (0, 30, 500, 1100):
        got = [r.m for r in op.top_rows(df, "m", k, ["_range"], rows_per_range=10).collect()]
        assert sorted(got) == sorted(sorted((r[1] for r in data), reverse=True)[:k])
    same = spark.range(1000).selectExpr("1 AS m").repartition(6)
    assert op.top_rows(same, "m", 333, rows_per_range=5).count() == 333
    assert op.top_rows(same.limit(0), "m", 3).count() == 0


def test_top_rows_exchange_no_rows(spark):
    df = spark.range(20_000).selectExpr("id", "hash(id) AS m")
    text = op.top_rows(df, "m", 2000, ["id"], rows_per_range=100)._jdf.queryExecution().executedPlan().toString()
    # The rows within the last range are merged; the others stay where they are.
    assert "Exchange" not in text and text.count("TakeOrderedAndProject") == 1


def test_hot_values_are_dealt_to_several_tasks(spark):
    from podium.operators.ranges import value_ranges

    df = spark.range(0, 9000, 1, 12).selectExpr("if(id % 3 = 0, 5, id % 500) AS v", "'p' AS p")
    ranges = value_ranges(df, ["p", "v"], 9000, 30)
    sizes = [r["n"] for r in ranges.deal(df, "r", "q").groupBy("q").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 9000 / 30 * 4 and max(ranges.parts) >= 5


def test_rank_of_integers_beyond_double_precision(spark):
    big = 2**60
    data = [(i, "p", big + i % 40) for i in range(200)]
    df = spark.createDataFrame(data, "id bigint, p string, m bigint")
    got = {r.id: r.ranking for r in op.rank_in_partition(df, "p", "m", rows_per_task=10).collect()}
    assert got == {i: 1 + sum(o > m for _, _, o in data) for i, _, m in data}


def test_rank_of_empty_and_of_all_null(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.rank_in_partition(empty, "p", "m", rows_per_task=1).count() == 0
    nulls = spark.createDataFrame([(i, "p", None) for i in range(30)], SCHEMA)
    ranks = op.rank_in_partition(nulls, "p", "m", rows_per_task=5)
    assert {r.ranking for r in ranks.collect()} == {1}


def test_rank_of_a_map_raises(spark):
    df = spark.range(9).selectExpr("id", "'p' AS p", "map(id, 1) AS m")
    with pytest.raises(Exception, match="(?i)order|sort"):
        op.rank_in_partition(df, "p", "m", rows_per_task=2).collect()


def test_first_place_counts_equals_brute_force(spark):
    data = hot_data()
    df = spark.createDataFrame(data, SCHEMA).withColumn("e", F.col("id") % 7)
    expected = {}
    for i, r in brute_ranks(data).items():
        if r == 1:
            expected[i % 7] = expected.get(i % 7, 0) + 1
    got = rows(op.first_place_counts(df, "p", "m", "e"))
    assert got == sorted(expected.items(), key=lambda kv: (-kv[1], kv[0]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.sampled_from([None, math.nan, -1.5, 0.0, 2.0, 3.0]),
            st.sampled_from([None, 1.0, 2.0, math.nan]),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_argmax_and_rank_of_argmax(spark, triples):
    data = [(i, p, m, b) for i, (p, m, b) in enumerate(triples)]
    df = spark.createDataFrame(data, "id bigint, p string, m double, b double")

    def best(candidates, measure):
        return max(candidates, key=lambda r: (worth(r[measure]), -r[0]))

    expected = {p: best([r for r in data if r[1] == p], 2)[0] for p in {r[1] for r in data}}
    for prune in (True, False):
        winners = op.argmax_per_group(df, "p", "id", "m", prune=prune)
        assert {r.p: r.id for r in winners.collect()} == expected

    group = [r for r in data if r[1] == "a"]
    got = rows(op.rank_of_argmax(df, "p", "a", "b", "m", ["id"]))
    if not group:
        assert got == []
    else:
        leader = best(group, 3)
        rank = 1 + sum(worth(r[2]) > worth(leader[2]) for r in group)
        assert got == [(leader[0], rank)]


def test_argmax_of_integers_and_decimals(spark):
    low, high = -(2**63), 2**63 - 1
    data = [("a", 1, low), ("a", 2, high), ("a", 3, high), ("b", 4, None), ("b", 5, low)]
    df = spark.createDataFrame(data, "g string, e int, m bigint")
    assert set(rows(op.argmax_per_group(df, "g", "e", "m"))) == {("a", 2, high), ("b", 5, low)}
    df = df.where("m > 0 OR m IS NULL").withColumn("m", F.col("m").cast("decimal(20,1)"))
    assert {r.e for r in op.argmax_per_group(df, "g", "e", "m").collect()} == {2, 4}
    with pytest.raises(TypeError):
        op.argmax_per_group(df, "m", "e", "g")


def test_sort_and_top_k_order(spark):
    data = hot_data(200)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    expected = [
        r[0] for r in sorted(data, key=lambda r: (tuple(-x for x in worth(r[2])), r[0]))
    ]
    assert [r.id for r in op.sort_desc(df, "m", ["id"]).collect()] == expected
    assert [r.id for r in op.top_k(df, "m", 7, ["id"]).collect()] == expected[:7]
    assert [r.id for r in op.top1(df, "m", ["id"]).collect()] == expected[:1]


def test_sort_desc_of_a_whole_table(spark):
    customers = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    got = rows(op.sort_desc(customers, "c_acctbal", ["c_custkey"]).select("c_acctbal", "c_custkey"))
    assert len(got) == customers.count()
    assert got == sorted(got, key=lambda r: (-r[0], r[1]))


@pytest.mark.parametrize("prune", [True, False])
def test_group_first_ignores_arrival_order(spark, prune):
    data = [("a", 3, 30), ("a", 1, 10), ("a", 1, 11), ("b", 2, 20), ("b", 9, 90)]
    data += [("c", None, 41), ("c", None, 40), ("d", 0, 51), ("d", None, 50), (None, 7, 60)]
    df = spark.createDataFrame(data, "g string, t int, v int").repartition(3)
    got = set(rows(op.group_first(df, "g", "v", ["t", "v"], "first", prune=prune)))
    assert got == {("a", 10), ("b", 20), ("c", 40), ("d", 50), (None, 60)}


@pytest.mark.parametrize(
    ("old", "new", "expected"),
    [
        ([1.0, None], [2.0], (1.0, 2.0, 100.0, "up")),
        ([2.0], [1.0], (2.0, 1.0, -50.0, "down")),
        ([2.0], [2.0, None], (2.0, 2.0, 0.0, "flat")),
        ([0.0], [2.0], (0.0, 2.0, None, "up")),
        ([], [2.0], (None, 2.0, None, None)),
        ([None], [None], (None, None, None, None)),
        ([], [], (None, None, None, None)),
    ],
)
def test_pct_change(spark, old, new, expected):
    data = [(1, v) for v in old] + [(2, v) for v in new] + [(3, 99.0)]
    df = spark.createDataFrame(data, "y int, m double")
    got = op.pct_change(df, "m", F.col("y") == 1, F.col("y") == 2)
    assert rows(got) == [expected]


def test_first_value(spark):
    assert op.first_value(spark.range(0)) is None
    assert op.first_value(spark.range(3, 4)) == 3


def test_winner_rows(spark):
    data = [("a", 2018, 9.0), ("a", 2019, 1.0), ("a", 2019, 2.0), ("b", 2019, 5.0)]
    df = spark.createDataFrame(data, "e string, y int, m double")
    winner = op.best_mean(df, F.col("y") < 2019, "e", "m", "mean")
    assert rows(winner) == [("a", 9.0)]
    got = op.winner_rows(df, winner, "e", F.col("y") == 2019)
    assert sorted(rows(got)) == data[1:3]
    assert op.winner_rows(df, winner.where("mean < 0"), "e", F.col("y") == 2019).count() == 0
    with pytest.raises(ValueError, match="one row"):
        op.winner_rows(df, winner.union(winner), "e", F.col("y") == 2019)


def test_argmax_and_first_read_few_rows_after_the_maxima(spark):
    """One very low group does not keep the rows of the others."""
    data = [(i, "high", float(i)) for i in range(500)] + [(1000, "low", -1.0), (1001, None, None)]
    df = spark.createDataFrame(data, "id bigint, g string, m double")
    best = op.argmax_per_group(df, "g", "id", "m")
    assert sorted(rows(best), key=str) == [("high", 499, 499.0), ("low", 1000, -1.0), (None, 1001, None)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "LeftSemi" in plan
    first = op.group_first(df, "g", "id", ["m", "id"], "first", also={"n": F.count("*")})
    assert sorted(rows(first), key=str) == [("high", 0, 500), ("low", 1000, 1), (None, 1001, 1)]
    alone = op.group_first(df, "g", "id", ["m", "id"], "first", prune=False, also={"n": F.count("*")})
    assert sorted(rows(alone), key=str) == sorted(rows(first), key=str)


# --- columns -------------------------------------------------------------------


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["A b C", "d"])
    assert op.normalize_columns(df).columns == ["a_b_c", "d"]
    with pytest.raises(ValueError, match="a_b"):
        op.normalize_columns(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_rename_missing_column_raises(spark):
    with pytest.raises(ValueError, match="nope"):
        op.rename(spark.range(1), {"nope": "x"})


def test_project_takes_names_literally(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c d"])
    assert rows(op.project(df, "c d", "a.b")) == [(2, 1)]


def test_union_aligns_by_name_and_keeps_duplicates(spark):
    left = spark.createDataFrame([("x", 1.0), ("x", 1.0)], "e string, score double")
    right = spark.createDataFrame([(2019, 3.0, "y")], "y int, m double, e string")
    got = op.align_and_union(
        left, right, ["e", "m", "y"], cohort=("y", 2021), snapshot_names={"score": "m"}
    )
    assert sorted(rows(got)) == [("x", 1.0, 2021), ("x", 1.0, 2021), ("y", 3.0, 2019)]


# --- classifier ----------------------------------------------------------------


def walk(rules, region, entity, default):
    """The rules in plain Python."""
    for r in rules:
        tests = []
        if r.contains is not None:
            tests.append(r.contains in (region or ""))
        if r.members:
            tests.append(entity in r.members)
        if (all if r.need == "all" else any)(tests):
            return r.label
    return default


@pytest.mark.parametrize("default", ["Other", None])
def test_classify_native_udf_and_walker_agree(spark, default):
    regions = [
        None, "", "Unknown", "Western Europe", "East Asia", "Latin America", "africa",
        "Sub-Saharan Africa", "Middle East and North Africa", "Commonwealth",
        "Europe and Asia",
    ]
    names = [None, "Atlantis", "Australia", "New Zealand", AFRICA[13], "south africa", EUROPE[12]]
    data = [(r, n) for r in regions for n in names]
    df = spark.createDataFrame(data, "region string, name string")
    rules = continent_rules()
    spark.udf.register("continent_of", classify_udf(rules, default))
    df.createOrReplaceTempView("places")
    native = df.withColumn("c", classify(rules, F.col("region"), F.col("name"), default))
    by_sql = spark.sql("SELECT region, name, continent_of(region, name) AS c FROM places")
    expected = {(r, n, walk(rules, r, n, default)) for r, n in data}
    assert set(rows(native)) == expected
    assert set(rows(by_sql)) == expected


def test_classify_without_rules_or_tests(spark):
    with pytest.raises(ValueError, match="no rules"):
        classify([], F.col("a"), F.col("b"))
    with pytest.raises(ValueError):
        Rule("empty")
    with pytest.raises(ValueError):
        Rule("bad", contains="x", need="some")


# --- sources and layout ---------------------------------------------------------


def test_target_partitions():
    assert op.target_partitions(0) == 1
    assert op.target_partitions(100_000) == 1
    assert op.target_partitions(100_001) == 2
    assert op.target_partitions(10**15) == 10**10


def test_repartition_by_rows(spark):
    df = spark.range(0, 1000, 1, 4)
    grown = op.repartition_by_rows(df, rows_per_partition=100)
    assert (op.partition_count(grown), grown.count()) == (10, 1000)
    shrunk = op.repartition_by_rows(df, rows_per_partition=600)
    assert (op.partition_count(shrunk), shrunk.count()) == (2, 1000)
    empty = op.repartition_by_rows(spark.range(0))
    assert (op.partition_count(empty), op.filled_partition_count(empty), empty.count()) == (1, 0, 0)
    one = op.repartition_by_rows(df, rows_per_partition=1000)
    assert (op.partition_count(one), one.count()) == (1, 1000)


@pytest.mark.parametrize("bound, n", [(100, 10), (400, 3), (500, 2), (10_000, 1)])
def test_repartition_keeps_its_bound_when_one_partition_has_all_rows(spark, bound, n):
    df = spark.range(0, 1000, 1, 4).where("id < 0").union(spark.range(0, 1000, 1, 1))
    spread = op.repartition_by_rows(df, bound)
    sizes = [r[1] for r in rows(spread.groupBy(F.spark_partition_id()).count())]
    assert len(sizes) == n and sum(sizes) == 1000 and max(sizes) <= bound


def test_partition_count_computes_no_rows(spark):
    def fail(batches):
        raise AssertionError("computed")

    df = spark.range(0, 100, 1, 64).where("id < 2").mapInArrow(fail, "id bigint")
    assert op.partition_count(df) == 64
    assert op.filled_partition_count(spark.range(0, 100, 1, 64).where("id < 2")) == 2


@pytest.mark.parametrize("bound", [7, 100, 333])
def test_all_partitions_but_the_last_are_full(spark, bound):
    """Skewed and empty partitions, rows in order; columns of the operator's own names."""
    skewed = spark.range(0, 600, 1, 1).union(spark.range(600, 603, 1, 3)).union(spark.range(0, 9, 1, 3).where("id < 0"))
    df = skewed.union(spark.range(603, 1000, 1, 17)).select("id", F.lit("own").alias("_place"))
    spread = op.repartition_by_rows(df, bound)
    sizes = op.partition_sizes(spread)
    assert spread.columns == ["id", "_place"] and sorted(r.id for r in spread.collect()) == list(range(1000))
    n = math.ceil(1000 / bound)
    assert op.partition_count(spread) == n and sizes == {i: min(bound, 1000 - i * bound) for i in range(n)}


def test_shrinking_merges_without_an_exchange(spark):
    df = spark.range(0, 64_000, 1, 64)

    def exchanged(spread):
        return "Exchange" in spread._jdf.queryExecution().executedPlan().toString()

    bounded = op.repartition_by_rows(df, 7_000)
    assert not exchanged(bounded) and op.partition_count(bounded) == 10
    assert max(op.partition_sizes(bounded).values()) <= 7_000
    # Twenty of 3.2 partitions each: four of them are too many for the bound.
    assert exchanged(op.repartition_by_rows(df, 3_200))
    assert max(op.partition_sizes(op.repartition_by_rows(df, 3_200)).values()) == 3_200
    always = op.repartition_by_rows(df, 3_200, merge="always")
    assert not exchanged(always) and op.partition_count(always) == 20 and always.count() == 64_000
    same = op.repartition_by_rows(df, 1_000)
    assert not exchanged(same) and op.partition_count(same) == 64
    with pytest.raises(ValueError, match="merge"):
        op.repartition_by_rows(df, 10, merge="never")


def test_persisted_scope(spark):
    df = spark.range(100)
    with op.persisted(df) as (cached,):
        assert cached.is_cached
        assert "InMemoryTableScan" in cached.where("id > 3")._jdf.queryExecution().toString()
    assert not df.is_cached
    with pytest.raises(ZeroDivisionError), op.persisted(df) as (cached,):
        1 / 0
    assert not df.is_cached
    df.persist().count()
    op.release_all(spark)
    assert not df.storageLevel.useMemory


def test_csv_schema_must_match_the_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("A b,c\n1,\n2,x\n")
    path = str(tmp_path / "t.csv")
    assert src.read_csv(spark, path).dtypes == [("A b", "int"), ("c", "string")]
    typed = src.read_csv(spark, path, "`A b` bigint, c string")
    assert rows(typed) == [(1, None), (2, "x")]
    with pytest.raises(Exception, match="header"):
        src.read_csv(spark, path, "c string, `A b` bigint").collect()


def test_materialize_cuts_lineage_and_keeps_types(spark):
    df = spark.createDataFrame(hot_data(50), SCHEMA)
    stored = src.materialize(df, "test")
    assert stored.schema == df.schema
    assert stored.count() == 50
    assert "podium-test-" in stored.inputFiles()[0]


def test_true_size_tables_are_not_broadcast_when_large(spark):
    """A million equal rows compress to almost nothing, but must count in full."""
    equal = spark.range(1_000_000).select(F.lit(7).cast("bigint").alias("k"), F.lit(1.5).alias("v"))

    def joined(**options):
        small = src.materialize(equal, "equal", **options)
        plan = spark.range(10).join(small, F.col("id") == F.col("k"), "left")
        return plan._jdf.queryExecution().sparkPlan().toString()

    assert "BroadcastHashJoin" in joined()
    assert "SortMergeJoin" in joined(true_size=True)


def test_scratch_follows_the_session(spark):
    assert src.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    def session(checkpoint, warehouse="hdfs:///w", master="yarn"):
        settings = {"spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": warehouse}
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert src.scratch_root(session("hdfs:///shared/")) == "hdfs:///shared"
    assert src.scratch_root(session(None)) == "hdfs:///w/_podium_scratch"
    assert src.scratch_root(session(None, "file:/w", "local[4]")) == "file:/w/_podium_scratch"
    # Each executor would write to a disk of its own.
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        src.scratch_root(session(None, "file:/w"))


def test_scratch_scope_deletes_its_folder(spark):
    with src.scratch_scope(spark, "scoped") as folder:
        stored = src.materialize(spark.range(5), "five", folder=folder)
        assert stored.count() == 5 and os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    with pytest.raises(ValueError, match="scratch"):
        src.remove(spark, "/somewhere/else")


@pytest.mark.parametrize("prune", [True, False])
def test_group_first_with_any_names(spark, prune):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), ("b", 3, 3.0)], "k string, `t.x` int, m double")
    also = {n: F.max("m") for n in ("lead", "s", "best", "k", "r", "_key", "_lead", "o0")}
    got = op.group_first(df.withColumnRenamed("k", "g.h"), "g.h", "m", ["t.x"], "value", prune=prune, also=also)
    assert got.columns == ["g.h", "value", *also]
    assert sorted(rows(got)) == [("a", 2.0, *[2.0] * 8), ("b", 3.0, *[3.0] * 8)]


def test_names_with_dots_and_spaces_everywhere(spark):
    df = spark.createDataFrame([("x", 1.0, 3), ("x", 2.0, 4), ("y", 5.0, 1)], "`a.b` string, `m m` double, `t.t` int")
    assert sorted(rows(op.group_max(df, "a.b", "m m", "o.o"))) == [("x", 2.0), ("y", 5.0)]
    assert sorted(rows(op.group_count(df, "a.b", "n.n"))) == [("x", 2), ("y", 1)]
    assert sorted(rows(op.group_avg(df, "a.b", "m m", "o.o"))) == [("x", 1.5), ("y", 5.0)]
    for prune in (True, False):
        got = op.argmax_per_group(df, "a.b", "t.t", "m m", prune=prune)
        assert got.columns == ["a.b", "t.t", "m m"] and sorted(rows(got)) == [("x", 4, 2.0), ("y", 1, 5.0)]
    assert rows(op.top_k(df, "m m", 2, ["t.t"])) == [("y", 5.0, 1), ("x", 2.0, 4)]
    assert rows(op.best_mean(df, F.col("`t.t`") > 0, "a.b", "m m", "o")) == [("y", 5.0)]
    assert rows(op.overall_avg(df, "m m", "o.o")) == [(8 / 3,)]
    change = op.pct_change(df, "m m", F.col("`t.t`") == 1, F.col("`t.t`") == 4).head()
    assert change.direction == "down" and change.pct_change == -60.0
    assert rows(op.winner_rows(df, op.top1(df, "m m"), "a.b", F.lit(True))) == [("y", 5.0, 1)]
