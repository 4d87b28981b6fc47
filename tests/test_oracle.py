"""Every registered query against its SQL twin in DuckDB, values and types."""

from __future__ import annotations

import math
import os
import re

import __spark_entry__ as entry_module
import duckdb
import pytest

SF_DIR = os.environ.get("PODIUM_TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


TRAINING_DATA = re.compile(r"op\d+_|pipeline$")


def test_every_query_has_an_oracle():
    """But for training-data operators beyond SQL, which have tests of their own."""
    without = entry_module.queries().keys() - entry_module.oracle_sql().keys()
    assert all(TRAINING_DATA.match(name) for name in without)
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = _sorted(tuple(r) for r in df.select(*names).collect())
    expected = _sorted(expected)
    assert len(got) == len(expected) > 0
    for g, e in zip(got, expected):
        assert all(map(_same, g, e)), (g, e)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_module._SCHEMAS))
def test_declared_schema_is_the_file_schema(spark, name):
    declared = entry_module._table(spark, SF_DIR, name)
    assert declared.dtypes == spark.read.parquet(f"{SF_DIR}/{name}.parquet").dtypes
