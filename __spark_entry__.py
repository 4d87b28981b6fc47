"""

Each query runs over its whole tables. A ``limit`` appears only inside the
top-1 and top-k operators, where it is the feature.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from podium import operators as op  # noqa: E402
from podium import sources as src  # noqa: E402
from podium.functions import Rule, classify, classify_udf, register_classifier  # noqa: E402
from podium.plans import Panel  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        _ORACLES[name] = sql
        return fn

    return register


# The columns of the given tables.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return src.read_parquet(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


def _from_year(column: str, year: int) -> Column:
    """``column`` is in ``year`` or later; a plain comparison, so it reaches the scan."""
    return F.col(column) >= F.lit(f"{year}-01-01").cast("timestamp_ntz")


def _in_year(column: str, year: int) -> Column:
    return _from_year(column, year) & ~_from_year(column, year + 1)


def _not_in_year(column: str, year: int) -> Column:
    """All other rows, those without a date included."""
    return F.col(column).isNull() | ~_in_year(column, year)


# --- top-k and sorts ---------------------------------------------------------


@_query(
    "top1_by_measure",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 1
    """,
)
def top1_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = op.project(_table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_totalprice")
    return op.top1(orders, "o_totalprice", ["o_orderkey"])


@_query(
    "topk_by_measure",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10
    """,
)
def topk_by_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = op.project(_table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")
    return op.top_k(orders, "o_totalprice", 10, ["o_orderkey"])


@_query(
    "topk_large",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber
    LIMIT (SELECT count(*) // 10 FROM lineitem)
    """,
)
def topk_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    lines = op.project(_table(spark, sf_dir, "lineitem"), *columns)
    return op.top_rows(lines, "l_extendedprice", lines.count() // 10, columns[:2], rows_per_range=10_000)


@_query(
    "filter_eq_top1",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE year(o_orderdate) = 2000
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 1
    """,
)
def filter_eq_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    best = op.filtered_top1(orders, _in_year("o_orderdate", 2000), "o_totalprice", ["o_orderkey"])
    return op.project(best, "o_orderkey", "o_custkey", "o_totalprice")


@_query(
    "sort_desc",
    "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey",
)
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = op.project(_table(spark, sf_dir, "customer"), "c_custkey", "c_acctbal")
    return op.sort_desc(customers, "c_acctbal", ["c_custkey"])


@_query(
    "avg_since_top1",
    """
    SELECT l_suppkey, round(avg(l_quantity), 6) AS avg_quantity FROM lineitem
    WHERE year(l_shipdate) > 1998 GROUP BY l_suppkey
    ORDER BY favg(l_quantity) DESC NULLS LAST, l_suppkey LIMIT 1
    """,
)
def avg_since_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.best_mean(
        _table(spark, sf_dir, "lineitem"),
        _from_year("l_shipdate", 1999),
        "l_suppkey",
        "l_quantity",
        "avg_quantity",
        digits=6,
    )


@_query(
    "winner_followup",
    """
    WITH winner AS (
        SELECT l_suppkey, favg(l_quantity) AS m FROM lineitem
        WHERE year(l_shipdate) > 1998 GROUP BY l_suppkey
        ORDER BY m DESC NULLS LAST, l_suppkey LIMIT 1
    )
    SELECT l_suppkey, round(avg(l_quantity), 6) AS avg_quantity_1999 FROM lineitem
    WHERE year(l_shipdate) = 1999 AND l_suppkey IN (SELECT l_suppkey FROM winner)
    GROUP BY l_suppkey
    """,
)
def winner_followup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.winner_rows(
        _table(spark, sf_dir, "lineitem"),
        avg_since_top1(spark, sf_dir),
        "l_suppkey",
        _in_year("l_shipdate", 1999),
    )
    return op.group_avg(rows, "l_suppkey", "l_quantity", "avg_quantity_1999", digits=6)


# --- classifier --------------------------------------------------------------

_PART_RULES = [
    Rule("special", members=("Brand#1", "Brand#2")),
    Rule("value", contains="ECONOMY", members=("Brand#3", "Brand#4"), need="any"),
    Rule("promo_core", contains="PROMO", members=("Brand#5", "Brand#6"), need="all"),
    Rule("promo_other", contains="PROMO"),
    Rule("sized", contains="A"),
]
_PART_CASE = """
    CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'special'
         WHEN contains(p_type, 'ECONOMY') OR p_brand IN ('Brand#3', 'Brand#4') THEN 'value'
         WHEN contains(p_type, 'PROMO') AND p_brand IN ('Brand#5', 'Brand#6') THEN 'promo_core'
         WHEN contains(p_type, 'PROMO') THEN 'promo_other'
         WHEN contains(p_type, 'A') THEN 'sized'
         ELSE 'other' END
"""


def _classified_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = classify(_PART_RULES, F.col("p_type"), F.col("p_brand"), "other")
    return _table(spark, sf_dir, "part").withColumn("category", category)


@_query("classify_rules", f"SELECT p_partkey, {_PART_CASE} AS category FROM part")
def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.project(_classified_part(spark, sf_dir), "p_partkey", "category")


@_query("classify_rules_udf", f"SELECT p_partkey, {_PART_CASE} AS category FROM part")
def classify_rules_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_classifier(spark, "part_category", _PART_RULES, "other")
    part = _table(spark, sf_dir, "part")
    return part.select("p_partkey", F.expr("part_category(p_type, p_brand)").alias("category"))


@_query("classify_rules_arrow", f"SELECT p_partkey, {_PART_CASE} AS category FROM part")
def classify_rules_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udf.register("part_category_arrow", classify_udf(_PART_RULES, "other"))
    part = _table(spark, sf_dir, "part")
    return part.select("p_partkey", F.expr("part_category_arrow(p_type, p_brand)").alias("category"))


# --- aggregates --------------------------------------------------------------


@_query(
    "argmax_per_group",
    f"""
    SELECT category, p_partkey, p_retailprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY category ORDER BY p_retailprice DESC NULLS LAST, p_partkey) AS rn
        FROM (SELECT *, {_PART_CASE} AS category FROM part))
    WHERE rn = 1
    """,
)
def argmax_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _classified_part(spark, sf_dir)
    return op.argmax_per_group(parts, "category", "p_partkey", "p_retailprice")


@_query(
    "group_first",
    """
    SELECT event_type, arg_min(event_id, (ts, event_id)) AS first_event,
           max(value) AS max_value
    FROM events GROUP BY event_type
    """,
)
def group_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return op.group_first(
        events,
        "event_type",
        "event_id",
        ["ts", "event_id"],
        "first_event",
        also={"max_value": F.max("value")},
    )


@_query(
    "group_max",
    "SELECT c_mktsegment, max(c_acctbal) AS max_acctbal FROM customer GROUP BY c_mktsegment",
)
def group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.group_max(
        _table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "max_acctbal"
    )


@_query(
    "group_count",
    "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority",
)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.group_count(_table(spark, sf_dir, "orders"), "o_orderpriority", "n_orders")


@_query(
    "group_avg",
    """
    SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_quantity
    FROM lineitem GROUP BY l_returnflag
    """,
)
def group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.group_avg(
        _table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", "avg_quantity", digits=6
    )


# To 17 digits the mean would depend on the order of additions, but for the exact sum.
@_query(
    "group_avg_exact",
    """
    SELECT o_custkey, round(favg(o_totalprice), 8) AS avg_price FROM orders GROUP BY o_custkey
    """,
)
def group_avg_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return op.group_avg(orders, "o_custkey", "o_totalprice", "avg_price", digits=8, exact=True)


@_query(
    "cohort_avg",
    """
    SELECT round(avg(l_extendedprice), 4) AS avg_price
    FROM lineitem WHERE year(l_shipdate) = 2000
    """,
)
def cohort_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.overall_avg(
        _table(spark, sf_dir, "lineitem"),
        "l_extendedprice",
        "avg_price",
        _in_year("l_shipdate", 2000),
        digits=4,
    )


@_query(
    "pct_change",
    """
    WITH m AS (
        SELECT avg(o_totalprice) FILTER (year(o_orderdate) = 2000) AS p,
               avg(o_totalprice) FILTER (year(o_orderdate) = 2001) AS c
        FROM orders)
    SELECT round(p, 4) AS mean_previous, round(c, 4) AS mean_current,
           round((c - p) / nullif(p, 0) * 100, 6) AS pct_change,
           CASE WHEN c > p THEN 'up' WHEN c < p THEN 'down' WHEN c = p THEN 'flat' END
               AS direction
    FROM m
    """,
)
def pct_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.pct_change(
        _table(spark, sf_dir, "orders"),
        "o_totalprice",
        _in_year("o_orderdate", 2000),
        _in_year("o_orderdate", 2001),
        mean_digits=4,
        pct_digits=6,
    )


# --- ranks -------------------------------------------------------------------

_RANK_SQL = """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice,
           rank() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC NULLS LAST)
               AS ranking
    FROM orders
"""


def _orders_with_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("order_year"), "o_totalprice"
    )


@_query("rank_in_partition", _RANK_SQL)
def rank_in_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rank_in_partition(_orders_with_year(spark, sf_dir), "order_year", "o_totalprice")


# The same, with a bound low enough that small tables are cut into cells too.
@_query("rank_in_partition_cells", _RANK_SQL)
def rank_in_partition_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rank_in_partition(
        _orders_with_year(spark, sf_dir), "order_year", "o_totalprice", rows_per_task=500
    )


# Strings: nothing but the order of the type is used.
@_query(
    "rank_in_partition_text",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority,
           rank() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m')
                        ORDER BY o_orderpriority DESC NULLS LAST) AS ranking
    FROM orders
    """,
)
def rank_in_partition_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority"
    )
    return op.rank_in_partition(orders, "month", "o_orderpriority", rows_per_task=10_000)


@_query(
    "first_place_counts",
    """
    SELECT o_orderpriority, count(*) AS wins FROM (
        SELECT o_orderpriority, rank() OVER (
            PARTITION BY date_trunc('month', o_orderdate)
            ORDER BY o_totalprice DESC NULLS LAST) AS ranking
        FROM orders)
    WHERE ranking = 1 GROUP BY o_orderpriority
    """,
)
def first_place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    return op.first_place_counts(orders, "month", "o_totalprice", "o_orderpriority", "wins")


@_query(
    "rank_of_argmax",
    """
    SELECT l_orderkey, l_linenumber, ranking FROM (
        SELECT *, rank() OVER (
            PARTITION BY year(l_shipdate) ORDER BY l_extendedprice DESC NULLS LAST) AS ranking
        FROM lineitem)
    WHERE year(l_shipdate) = 2000
    ORDER BY l_extendedprice * (1 - l_discount) DESC NULLS LAST, l_orderkey, l_linenumber
    LIMIT 1
    """,
)
def rank_of_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").withColumns(
        {
            "ship_year": F.year("l_shipdate"),
            "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        }
    )
    # The year's lines are all rows of that partition; the filter on the date reaches the scan.
    return op.rank_of_argmax(
        lines.where(_in_year("l_shipdate", 2000)),
        "ship_year",
        2000,
        "revenue",
        "l_extendedprice",
        ["l_orderkey", "l_linenumber"],
    )


# --- columns and unions ------------------------------------------------------


@_query("project_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.project(_table(spark, sf_dir, "orders"), "o_orderkey", "o_totalprice")


@_query(
    "normalize_columns",
    "SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account FROM customer",
)
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    titled = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("ACCOUNT"),
    )
    return op.normalize_columns(titled)


@_query(
    "add_cohort_literal",
    "SELECT c_custkey, CAST(2021 AS INTEGER) AS year FROM customer",
)
def add_cohort_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_literal(op.project(_table(spark, sf_dir, "customer"), "c_custkey"), "year", 2021)


@_query(
    "align_and_union",
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    """,
)
def align_and_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    snapshot = orders.where(_in_year("o_orderdate", 2001)).select(
        "o_orderkey", F.col("o_totalprice").alias("price")
    )
    history = orders.where(_not_in_year("o_orderdate", 2001)).select(
        F.year("o_orderdate").alias("year"), "o_totalprice", "o_orderkey"
    )
    return op.align_and_union(
        snapshot,
        history,
        ["o_orderkey", "o_totalprice", "year"],
        cohort=("year", 2001),
        snapshot_names={"price": "o_totalprice"},
    )


# A declared schema with a whole number for a price: fractions have no place in it.
@_query(
    "conform_or_reject",
    """
    SELECT o_orderkey, o_totalprice = floor(o_totalprice) AS fits,
           CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(o_totalprice AS BIGINT) END AS price
    FROM orders
    """,
)
def conform_or_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    clean, rejects = op.conform_or_reject(orders, "o_orderkey bigint, o_totalprice bigint")
    kept = clean.select("o_orderkey", F.lit(True).alias("fits"), F.col("o_totalprice").alias("price"))
    return kept.unionByName(
        rejects.select("o_orderkey", F.lit(False).alias("fits"), F.lit(None).cast("bigint").alias("price"))
    )


# --- sources, sinks and layout -----------------------------------------------

_CSV_SQL = """
    SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance
    FROM customer
"""


def _write_customer_csv(spark: SparkSession, sf_dir: str) -> str:
    path = src.scratch_dir(spark, "csv") + "/customer"
    _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("Account Balance"),
    ).write.option("header", True).csv(path)
    return path


@_query("csv_roundtrip", _CSV_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = op.normalize_columns(src.read_csv(spark, _write_customer_csv(spark, sf_dir)))
    # Inference gives int or bigint, depending on the largest key.
    return customers.withColumn("customer_key", F.col("customer_key").cast("bigint"))


@_query("csv_roundtrip_schema", _CSV_SQL)
def csv_roundtrip_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "`Customer Key` bigint, `Customer Name` string, `Account Balance` double"
    return op.normalize_columns(
        src.read_csv(spark, _write_customer_csv(spark, sf_dir), schema)
    )


# Debts in parentheses, as accounts write them: no number to a CSV reader.
@_query(
    "csv_with_rejects",
    """
    SELECT c_custkey AS customer_key, c_acctbal >= 0 AS is_clean,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS account_balance,
           CASE WHEN c_acctbal < 0 THEN 'not of the column''s type: Account Balance' END AS reason
    FROM customer
    """,
)
def csv_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast("string")
    path = src.scratch_dir(spark, "csv") + "/accounts"
    _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("("), F.abs("c_acctbal"), F.lit(")")))
        .otherwise(balance)
        .alias("Account Balance"),
    ).write.option("header", True).csv(path)
    clean, rejects = src.read_csv_checked(spark, path, "`Customer Key` bigint, `Account Balance` double")
    kept = op.normalize_columns(clean).select(
        "customer_key", F.lit(True).alias("is_clean"), "account_balance", F.lit(None).cast("string").alias("reason")
    )
    lost = rejects.select(
        F.substring_index("line", ",", 1).cast("bigint").alias("customer_key"),
        F.lit(False).alias("is_clean"),
        F.lit(None).cast("double").alias("account_balance"),
        "reason",
    )
    return kept.unionByName(lost)


def _supplier_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.group_avg(
        _table(spark, sf_dir, "lineitem"), "l_suppkey", "l_quantity", "avg_quantity", digits=6
    )


@_query(
    "parquet_roundtrip",
    """
    SELECT l_suppkey, round(avg(l_quantity), 6) AS avg_quantity
    FROM lineitem GROUP BY l_suppkey
    """,
)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = src.scratch_dir(spark, "parquet") + "/supplier_means"
    src.write_parquet(_supplier_means(spark, sf_dir), path)
    return src.read_parquet(spark, path)


# The second version is read; the first is still there, by its number.
@_query(
    "published_versions",
    """
    SELECT 'newest' AS version, l_suppkey, round(avg(l_quantity), 6) AS avg_quantity
    FROM lineitem GROUP BY l_suppkey
    UNION ALL
    SELECT 'first', l_suppkey, round(avg(l_quantity), 6)
    FROM lineitem WHERE year(l_shipdate) < 2000 GROUP BY l_suppkey
    """,
)
def published_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = src.scratch_dir(spark, "published") + "/supplier_means"
    lines = _table(spark, sf_dir, "lineitem")
    for rows in (lines.where(~_from_year("l_shipdate", 2000)), lines):
        src.publish_parquet(op.group_avg(rows, "l_suppkey", "l_quantity", "avg_quantity", digits=6), path)
    newest, first = src.read_published(spark, path), src.read_published(spark, path, 1)
    return newest.withColumn("version", F.lit("newest")).unionByName(first.withColumn("version", F.lit("first")))


@_query(
    "results_manifest",
    """
    SELECT 'supplier_means' AS result, count(DISTINCT l_suppkey) AS n_rows FROM lineitem
    UNION ALL
    SELECT 'priority_counts', count(DISTINCT o_orderpriority) FROM orders
    UNION ALL
    SELECT 'datasets listed', 2
    """,
)
def results_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = src.scratch_dir(spark, "results")
    results = {
        "supplier_means": _supplier_means(spark, sf_dir),
        "priority_counts": group_count(spark, sf_dir),
    }
    for name, df in results.items():
        src.write_parquet(df, f"{folder}/{name}")
    manifest = src.results_manifest(spark, {name: f"{folder}/{name}" for name in results})
    dataset = F.regexp_extract("path", "/([^/]+)/[^/]+$", 1)
    listed = src.list_files(spark, folder).agg(F.count_distinct(dataset).alias("n_rows"))
    return manifest.unionByName(listed.select(F.lit("datasets listed").alias("result"), "n_rows"))


@_query(
    "repartition_by_rows",
    """
    SELECT g.rows_per_partition, count(l_orderkey) AS n_rows,
           greatest(CAST(ceil(count(l_orderkey) / CAST(g.rows_per_partition AS DOUBLE)) AS BIGINT), 1)
               AS n_partitions,
           least(g.rows_per_partition, count(l_orderkey)) AS largest
    FROM (VALUES (CAST(10000 AS BIGINT)), (CAST(1000000000000 AS BIGINT))) g(rows_per_partition)
    LEFT JOIN lineitem ON true GROUP BY g.rows_per_partition
    """,
)
def repartition_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")

    def sizes(rows: DataFrame, bound: int) -> DataFrame:
        spread = op.repartition_by_rows(rows, bound)
        # Whole rows move: every column takes part in the count.
        cells = F.count(F.struct(*spread.columns)).alias("n")
        per_partition = spread.groupBy(F.spark_partition_id().alias("p")).agg(cells)
        return per_partition.agg(
            F.lit(bound).cast("bigint").alias("rows_per_partition"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.greatest(F.count("*"), F.lit(1)).alias("n_partitions"),
            # All partitions but the last are full.
            F.coalesce(F.max("n"), F.lit(0)).alias("largest"),
        )

    # A case that deals rows, and one that merges all partitions into one.
    shrinking = sizes(lines.repartition(16), 10**12)
    return sizes(lines, 10_000).unionByName(shrinking)


# Of a reduced number of partitions, none is exchanged: neighbours are merged.
@_query(
    "merge_partitions",
    """
    SELECT count(*) AS n_rows, CAST(40 AS BIGINT) AS before,
           CAST(ceil(count(*) / 100000.0) AS BIGINT) AS after FROM lineitem
    """,
)
def merge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = _table(spark, sf_dir, "lineitem").repartition(40)
    merged = op.repartition_by_rows(spread, merge="always")
    return merged.agg(
        F.count("*").alias("n_rows"),
        F.lit(op.partition_count(spread)).cast("bigint").alias("before"),
        F.lit(op.partition_count(merged)).cast("bigint").alias("after"),
    )


@_query(
    "persist_reuse",
    """
    SELECT 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders
    UNION ALL
    SELECT 'max_price', max(o_totalprice) FROM orders
    """,
)
def persist_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    with op.persisted(_table(spark, sf_dir, "orders")) as (cached,):
        n_rows = cached.agg(F.count("*").cast("double").alias("value"))
        price = cached.agg(F.max("o_totalprice").alias("value"))
        return src.materialize(
            n_rows.select(F.lit("n_rows").alias("metric"), "value").unionByName(
                price.select(F.lit("max_price").alias("metric"), "value")
            ),
            "persist-reuse",
        )


@_query(
    "release_all",
    """
    SELECT 'orders' AS cached, count(*) AS n_rows, true AS held_before, false AS held_after FROM orders
    UNION ALL
    SELECT 'customer', count(*), true, false FROM customer
    """,
)
def release_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: _table(spark, sf_dir, name) for name in ("orders", "customer")}
    counts, before = {}, {}
    for name, df in tables.items():
        df.cache()
        counts[name] = df.count()
        before[name] = df.storageLevel.useMemory
    op.release_all(spark)
    rows = [(name, counts[name], before[name], df.storageLevel.useMemory) for name, df in tables.items()]
    return spark.createDataFrame(rows, "cached string, n_rows bigint, held_before boolean, held_after boolean")


# --- the panel analysis ------------------------------------------------------
# Entities are suppliers, their years come from the lines they shipped: the score
# is the largest price, the GDP the logarithm of the year's sales, the life
# expectancy the mean quantity. The snapshot is 2001.

_PANEL_CTE = """
    WITH yearly AS (
        SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
               max(l_extendedprice) AS score,
               round(ln(sum(l_extendedprice)), 6) AS gdp,
               round(avg(l_quantity), 4) AS life
        FROM lineitem GROUP BY ALL),
    snapshot AS (
        SELECT s_name AS country_name, r_name, y.*
        FROM yearly y JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE year = 2001),
    history AS (
        SELECT s_name AS country_name, y.*
        FROM yearly y JOIN supplier ON l_suppkey = s_suppkey WHERE year IS DISTINCT FROM 2001),
    panel AS (SELECT * EXCLUDE (r_name) FROM snapshot UNION ALL SELECT * FROM history)
"""


def _panel(spark: SparkSession, sf_dir: str, history_rows: Column | None = None) -> Panel:
    """The panel; ``history_rows`` are the lines of the years that a question asks for."""
    lines = _table(spark, sf_dir, "lineitem")
    # No join is hinted: the tables' own sizes decide which ones broadcast.
    suppliers = _table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_name").alias("country_name")
    )
    regions = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.initcap(F.col("r_name")).alias("regional_indicator"))
    )

    def yearly(where: Column) -> DataFrame:
        # Aggregating before the join leaves a row per supplier and year, so a
        # supplier with most of the lines does not skew it.
        return (
            lines.where(where)
            .groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
            .agg(
                F.max("l_extendedprice").alias("score"),
                F.round(F.log(F.sum("l_extendedprice")), 6).alias("gdp"),
                F.round(F.avg("l_quantity"), 4).alias("life"),
            )
            .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        )

    snapshot = (
        yearly(_in_year("l_shipdate", 2001))
        .join(regions, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            "country_name",
            "regional_indicator",
            F.col("score").alias("ladder_score"),
            F.col("gdp").alias("logged_gdp_per_capita"),
            F.col("life").alias("healthy_life_expectancy"),
        )
    )
    past = _not_in_year("l_shipdate", 2001)
    history = yearly(past if history_rows is None else history_rows & past).select(
        "country_name",
        "year",
        F.col("score").alias("life_ladder"),
        F.col("gdp").alias("log_gdp_per_capita"),
        F.col("life").alias("healthy_life_expectancy_at_birth"),
    )
    return Panel(
        snapshot,
        history,
        snapshot_year=2001,
        base_year=2000,
        after_year=1996,
        lookup_year=1999,
        digits=6,
        costly=True,
    )


@_query(
    "panel_happiest",
    _PANEL_CTE
    + """
    SELECT country_name, score AS ladder_score FROM snapshot
    ORDER BY score DESC NULLS LAST, country_name LIMIT 1
    """,
)
def panel_happiest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir).happiest()


@_query(
    "panel_happiest_per_continent",
    _PANEL_CTE
    + """
    SELECT continent, country_name, score AS ladder_score FROM (
        SELECT *, row_number() OVER (
            PARTITION BY continent ORDER BY score DESC NULLS LAST, country_name) AS rn
        FROM (SELECT *, CASE r_name WHEN 'EUROPE' THEN 'Europe' WHEN 'ASIA' THEN 'Asia'
                  WHEN 'AMERICA' THEN 'America' WHEN 'AFRICA' THEN 'Asia'
                  ELSE 'Other' END AS continent
              FROM snapshot))
    WHERE rn = 1
    """,
)
def panel_happiest_per_continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir).happiest_per_continent()


# Member lists that hold some suppliers, for every branch of the continent rules.
_EUROPE_MEMBERS = ("Supplier#2", "Supplier#3", "Supplier#5", "Supplier#11", "Supplier#17")
_AFRICA_MEMBERS = ("Supplier#1", "Supplier#4", "Supplier#7", "Supplier#13", "Supplier#19")


@_query(
    "panel_continent_members",
    _PANEL_CTE
    + f"""
    SELECT country_name, score AS ladder_score,
           CASE WHEN contains(initcap_region, 'Europe') OR country_name IN {_EUROPE_MEMBERS} THEN 'Europe'
                WHEN initcap_region = 'Africa' AND country_name IN {_AFRICA_MEMBERS} THEN 'Africa'
                WHEN contains(initcap_region, 'Asia') THEN 'Asia'
                WHEN contains(initcap_region, 'Africa') THEN 'Asia'
                ELSE 'Other' END AS continent
    FROM (SELECT *, upper(r_name[1]) || lower(r_name[2:]) AS initcap_region FROM snapshot)
    """,
)
def panel_continent_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("Europe", contains="Europe", members=_EUROPE_MEMBERS, need="any"),
        Rule("Africa", contains="Africa", members=_AFRICA_MEMBERS, need="all"),
        Rule("Asia", contains="Asia"),
        Rule("Asia", contains="Africa"),
    ]
    continent = classify(rules, F.col("regional_indicator"), F.col("country_name"), "Other")
    snapshot = _panel(spark, sf_dir).snapshot
    return snapshot.select("country_name", "ladder_score", continent.alias("continent"))


@_query(
    "panel_first_place_counts",
    _PANEL_CTE
    + """
    SELECT country_name, count(*) AS count FROM (
        SELECT *, rank() OVER (PARTITION BY year ORDER BY score DESC NULLS LAST) AS ranking
        FROM panel)
    WHERE ranking = 1 GROUP BY country_name
    """,
)
def panel_first_place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir).first_place_counts()


@_query(
    "panel_rank_of_richest",
    _PANEL_CTE
    + """
    SELECT country_name, ranking FROM (
        SELECT *, rank() OVER (PARTITION BY year ORDER BY score DESC NULLS LAST) AS ranking
        FROM history)
    WHERE year = 2000 ORDER BY gdp DESC NULLS LAST, country_name LIMIT 1
    """,
)
def panel_rank_of_richest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir, _in_year("l_shipdate", 2000)).rank_of_richest()


@_query(
    "panel_gdp_change",
    _PANEL_CTE
    + """
    , m AS (SELECT (SELECT avg(gdp) FROM history WHERE year = 2000) AS p,
                   (SELECT avg(gdp) FROM snapshot) AS c)
    SELECT round(p, 6) AS mean_previous, round(c, 6) AS mean_current,
           round((c - p) / nullif(p, 0) * 100, 6) AS pct_change,
           CASE WHEN c > p THEN 'up' WHEN c < p THEN 'down' WHEN c = p THEN 'flat' END
               AS direction
    FROM m
    """,
)
def panel_gdp_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir, _in_year("l_shipdate", 2000)).gdp_change()


@_query(
    "panel_longest_lived",
    _PANEL_CTE
    + """
    SELECT country_name, round(avg(life), 6) AS avg_healthy_life_expectancy FROM panel
    WHERE year > 1996 GROUP BY country_name
    ORDER BY favg(life) DESC NULLS LAST, country_name LIMIT 1
    """,
)
def panel_longest_lived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir, _from_year("l_shipdate", 1997)).longest_lived()


@_query(
    "panel_longest_lived_in_year",
    _PANEL_CTE
    + """
    SELECT country_name, life AS healthy_life_expectancy, year FROM panel
    WHERE year = 1999 ORDER BY life DESC NULLS LAST, country_name LIMIT 1
    """,
)
def panel_longest_lived_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir, _in_year("l_shipdate", 1999)).longest_lived_in_year()


@_query(
    "panel_longest_lived_followup",
    _PANEL_CTE
    + """
    , winner AS (
        SELECT country_name, favg(life) AS m FROM panel WHERE year > 1996
        GROUP BY country_name ORDER BY m DESC NULLS LAST, country_name LIMIT 1)
    SELECT country_name, life AS healthy_life_expectancy, year FROM panel
    WHERE year = 1999 AND country_name IN (SELECT country_name FROM winner)
    """,
)
def panel_longest_lived_followup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panel(spark, sf_dir, _from_year("l_shipdate", 1997)).longest_lived_followup()


# --- training-data operators --------------------------------------------------
# They are optional: without the subpackage and its pipeline, all else still works.

try:
    import corpus_pipeline
    from podium.llm import queries as llm_queries
except ImportError:
    # Without the subpackage, the pipeline or a library that they need.
    pass
else:
    _QUERIES.update(llm_queries.QUERIES)
    _ORACLES.update(llm_queries.ORACLES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

# --- contract ----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return panel_first_place_counts(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
