"""Published versions, CSV with rejects, declared schemas and the classifier as SQL."""

from __future__ import annotations

import math
import os
import subprocess
import sys

import pytest
from podium import operators as op
from podium import sources as src
from podium.functions import Rule, classify, register_classifier
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- published versions ---


def failing(spark):
    return spark.range(0, 1000, 1, 8).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))


def test_a_failing_job_leaves_the_published_rows(spark, tmp_path):
    path = str(tmp_path / "data")
    with pytest.raises(FileNotFoundError):
        src.read_published(spark, path)
    with pytest.raises(Exception, match="no"):
        src.publish_parquet(failing(spark), path)
    with pytest.raises(FileNotFoundError):
        src.read_published(spark, path)
    src.publish_parquet(spark.range(5), path)
    reader = src.read_published(spark, path)
    with pytest.raises(Exception, match="no"):
        src.publish_parquet(failing(spark), path)
    assert rows(src.read_published(spark, path)) == rows(reader) == [(i,) for i in range(5)]
    assert [v.number for v in src.versions(spark, path)] == [1]
    # What the failed attempts had written is gone.
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 1


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "data")
    for n in range(1, 5):
        # Each version is made from the one before.
        before = src.read_published(spark, path) if n > 1 else spark.range(0).withColumn("a.b", F.lit("x"))
        src.publish_parquet(before.union(spark.range(n, n + 1).withColumn("a.b", F.lit("x"))), path, keep=2)
    kept = src.versions(spark, path)
    assert [(v.number, v.n_rows) for v in kept] == [(4, 4), (3, 3)]
    assert src.read_published(spark, path).count() == 4 and src.read_published(spark, path, 3).count() == 3
    assert src.read_published(spark, path).columns == ["id", "a.b"]
    with pytest.raises(FileNotFoundError):
        src.read_published(spark, path, 1)
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2
    with pytest.raises(ValueError, match="kept"):
        src.publish_parquet(spark.range(1), path, keep=0)


def test_half_written_manifests_and_lost_files_are_seen(spark, tmp_path):
    path = str(tmp_path / "data")
    src.publish_parquet(spark.range(7), path)
    (tmp_path / "data" / "_published" / "00000002").write_text('{"number": 2, "fol')
    assert src.read_published(spark, path).count() == 7
    version = src.versions(spark, path)[0]
    folder = tmp_path / "data" / version.folder
    next(folder.glob("*.parquet")).unlink()
    with pytest.raises(OSError, match="not as it was published"):
        src.read_published(spark, path)


def test_of_two_writers_one_raises(spark, tmp_path, monkeypatch):
    from podium.sources import published

    path = str(tmp_path / "data")
    src.publish_parquet(spark.range(1), path)
    old = src.versions(spark, path)
    src.publish_parquet(spark.range(2), path)
    seen = published.versions
    # A writer that began before the second version was there.
    monkeypatch.setattr(published, "versions", lambda spark, path: old)
    with pytest.raises(Exception, match="(?i)exist"):
        src.publish_parquet(spark.range(3), path)
    monkeypatch.setattr(published, "versions", seen)
    assert src.read_published(spark, path).count() == 2
    assert len([n for n in os.listdir(path) if n.startswith("version-")]) == 2


def test_empty_tables_are_published(spark, tmp_path):
    version = src.publish_parquet(spark.range(0), str(tmp_path / "none"))
    assert version.n_rows == 0 and src.read_published(spark, str(tmp_path / "none")).count() == 0


# --- CSV with rejects ---

SCHEMA = "`the key` int, `b.c` double, _line string"


@pytest.fixture
def csv(tmp_path):
    text = "the key,b.c,_line\n1,2.5,x\n2,abc,y\nzz,3.0,\"z, z\"\n4,4.5\n5,1,2,3\n,,\n7,NaN,\"q\"\n99999999999,1,w\n"
    (tmp_path / "t.csv").write_text(text)
    (tmp_path / "u.csv").write_text("the key,b.c,_line\n8,-1e3,ü\n9, 1.5 ,\n")
    return str(tmp_path)


def test_rejected_rows_are_kept_with_their_reason(spark, csv):
    clean, rejects = src.read_csv_checked(spark, csv, SCHEMA)
    assert clean.columns == ["the key", "b.c", "_line"]
    got = sorted(clean.collect(), key=str)
    keys = sorted((r["the key"] for r in got if r["the key"] is not None))
    assert set(keys) >= {1, 7, 8} and any(r["the key"] is None and r["b.c"] is None for r in got)
    assert math.isnan(next(r["b.c"] for r in got if r["the key"] == 7))
    bad = {r.line: r.reason for r in rejects.collect()}
    assert bad["2,abc,y"] == "not of the column's type: b.c"
    assert bad['zz,3.0,"z, z"'] == "not of the column's type: the key"
    assert bad["4,4.5"] == bad["5,1,2,3"] == "not 3 values"
    assert bad["99999999999,1,w"] == "not of the column's type: the key"
    assert clean.count() + rejects.count() == 10
    assert all(r.file.endswith("t.csv") for r in rejects.where("line LIKE '%abc%'").collect())


def test_no_column_is_left_unparsed(spark, csv):
    clean, rejects = src.read_csv_checked(spark, csv, SCHEMA)
    n = clean.count()
    assert clean.select("the key").count() == clean.select("_line").count() == n == len(clean.select("_line").collect())
    assert rejects.select("reason").count() == rejects.count() == 10 - n


def test_strict_reading_raises_with_the_count(spark, csv, tmp_path):
    with pytest.raises(src.RejectedRows, match="rows of .* such as"):
        src.read_csv_checked(spark, csv, SCHEMA, strict=True)
    clean, rejects = src.read_csv_checked(spark, f"{csv}/u.csv", "`the key` int, `b.c` string, _line string", strict=True)
    assert clean.count() == 2 and rejects.count() == 0


def test_a_header_of_other_columns_raises(spark, csv):
    with pytest.raises(Exception, match="(?i)header"):
        src.read_csv_checked(spark, csv, "a int, b double, c string")[0].collect()


# --- declared schemas ---


def test_clashes_raise_before_anything_runs(spark):
    left = spark.range(3).selectExpr("id", "cast(id as int) AS score", "'a' AS name")
    right = spark.range(3).selectExpr("id", "'7' AS score", "'b' AS name")
    with pytest.raises(TypeError, match="score: int and string"):
        op.align_and_union(left, right, ["id", "score", "name"])
    with pytest.raises(TypeError, match="score: string is no double"):
        op.align_and_union(left, right, ["id", "score"], schema="id bigint, score double")
    with pytest.raises(ValueError, match="columns"):
        op.align_and_union(left, left, ["id", "score"], schema="id bigint")
    with pytest.raises(ValueError, match="has no columns"):
        op.conform(left, "nothing int")


def test_sides_widen_to_each_other(spark):
    left = spark.sql("SELECT 1 AS a, cast(2 AS bigint) AS b, NULL AS c, cast(1.5 AS decimal(5,2)) AS `d.d`")
    right = spark.sql("SELECT 2.5D AS a, 3 AS b, 'x' AS c, cast(1.25 AS decimal(9,4)) AS `d.d`")
    both = op.align_and_union(left, right, ["d.d", "a", "b", "c"])
    assert both.dtypes == [("d.d", "decimal(9,4)"), ("a", "double"), ("b", "bigint"), ("c", "string")]
    assert both.count() == 2
    declared = op.align_and_union(left, left, ["a", "b"], schema="b decimal(22,0), a bigint")
    assert declared.dtypes == [("a", "bigint"), ("b", "decimal(22,0)")]


@pytest.mark.parametrize(
    "source, target, ok",
    [
        ("tinyint", "int", True), ("bigint", "int", False), ("int", "decimal(9,0)", False), ("int", "decimal(12,2)", True),
        ("bigint", "double", True), ("bigint", "float", False), ("double", "float", False), ("decimal(5,2)", "decimal(6,1)", False),
        ("date", "timestamp_ntz", True), ("date", "timestamp", False), ("timestamp", "date", False), ("string", "int", False),
        ("int", "string", False), ("void", "date", True), ("array<int>", "array<int>", True), ("array<int>", "array<bigint>", False),
    ],
)
def test_only_safe_widening(spark, source, target, ok):
    df = spark.createDataFrame([], f"x {source}")
    if ok:
        assert op.conform(df, f"x {target}").dtypes == [("x", target)]
    else:
        with pytest.raises(TypeError, match="x: "):
            op.conform(df, f"x {target}")


def test_rows_that_do_not_fit_are_rejected_with_their_columns(spark):
    data = [(1, "7", 2.0, "a"), (2, "x", 2.5, "b"), (3, None, None, "c"), (4, "8", 2.5, "d"), (None, " 9 ", 1e300, "e")]
    df = spark.createDataFrame(data, "id int, t string, m double, reason string")
    clean, rejects = op.conform_or_reject(df, "t int, m bigint, id bigint")
    assert clean.dtypes == [("t", "int"), ("m", "bigint"), ("id", "bigint")]
    assert rows(clean) == rows(spark.createDataFrame([(7, 2, 1), (None, None, 3)], "t int, m bigint, id bigint"))
    assert rejects.columns == [*df.columns, "reason_"]
    assert {r.id: r.reason_ for r in rejects.collect()} == {2: "t, m", 4: "m", None: "m"}
    whole = op.conform_or_reject(df, "id bigint")
    assert whole[0].count() == 5 and whole[1].count() == 0


# --- the classifier in SQL text ---


def test_registered_classifier_equals_the_expression(spark):
    rules = [
        Rule("it's", contains="O'Neil\\", members=("é", "a\"b"), need="any"),
        Rule("both", contains="%", members=("x\ny", "日本", "\U0001f600"), need="all"),
        Rule("tail", contains="Asia"),
    ]
    values = ["O'Neil\\ x", "é", "a\"b", "50%", "x\ny", "日本", "\U0001f600", "Asia", "asia", "", None]
    df = spark.createDataFrame([(r, e) for r in values for e in values], "region string, entity string")
    for default in ("Other", None, "o'o"):
        register_classifier(spark, "my rules", rules, default)
        got = df.selectExpr("region", "entity", "`my rules`(region, entity) AS c")
        want = df.select("region", "entity", classify(rules, F.col("region"), F.col("entity"), default).alias("c"))
        assert rows(got) == rows(want)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in text and "my rules" not in text
    df.createOrReplaceTempView("classified")
    assert spark.sql("SELECT count(*) FROM classified WHERE `my rules`(region, entity) = 'tail'").head()[0] > 0
    with pytest.raises(ValueError, match="no rules"):
        register_classifier(spark, "none", [])


# --- the entry without optional parts ---


@pytest.mark.parametrize("missing", ["tokenizers", "public_tokenizers", "podium.llm", "corpus_pipeline"])
def test_the_entry_imports_without(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'rank_in_partition' in names and set(e.oracle_sql()) <= names\n"
        "assert not any(n.startswith('op1') for n in names) and 'pipeline' not in names\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
