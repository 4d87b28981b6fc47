"""CSV and Parquet sources, the Parquet sink, and listings of written results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.functions.names import free_name, quoted


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header row.

    Without ``schema`` the types are inferred, which reads the whole input one
    extra time: give a schema for large files. A schema must name the header's
    columns in order; a file with another header raises when it is read.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


class RejectedRows(ValueError):
    """Rows of a CSV that do not fit its schema."""


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) of CSV files with a header row that has the columns of ``schema``, in order.

    A line is rejected if a value does not parse as its column's type, or if it
    has too few or too many values. An empty value is NULL, and no reject.
    ``rejects`` has the whole ``line``, its ``file`` and the ``reason``: the
    columns whose values did not parse, or the number of values. Clean rows
    are those of ``read_csv``. With ``strict``, one aggregate counts the
    rejects, and any raise ``RejectedRows``. Every column is parsed, whatever
    is selected of either table; each reads the files anew, so a costly input
    is better written first.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in schema.fields]
    bad, file = free_name(names, "_line"), free_name(names, "_file")
    parsed = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", bad)
        # With pruned columns a bad value in another column would go unseen.
        .option("columnPruning", False)
        .schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())]))
        .csv(path)
        .withColumn(file, F.input_file_name())
    )
    columns = [F.col(quoted(n)) for n in names]
    # Holds for all rows. A query of the line alone is not allowed, and one of
    # some columns might not parse the others.
    all_parsed = F.xxhash64(*columns) >= F.lit(-(1 << 63))
    clean = parsed.where(F.col(bad).isNull() & all_parsed).select(*columns)
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    values = F.from_csv(F.col(bad), ", ".join(f"{quoted(n)} STRING" for n in names), {"mode": "PERMISSIVE"})
    found = parsed.where(F.col(bad).isNotNull() & all_parsed).withColumn("_values", values)
    unparsed = [
        F.when(F.col(quoted(n)).isNull() & F.col("_values")[n].isNotNull(), F.lit(n)) for n in as_text.names
    ]
    wrong = F.concat_ws(", ", *unparsed)
    reason = F.when(wrong != "", F.concat(F.lit("not of the column's type: "), wrong)).otherwise(
        F.lit(f"not {len(names)} values")
    )
    rejects = found.select(F.col(bad).alias("line"), F.col(file).alias("file"), reason.alias("reason"))
    if strict:
        n, first = rejects.agg(F.count("*"), F.min("line")).head()
        if n:
            raise RejectedRows(f"{n} rows of {path} do not fit the schema, such as {first!r}")
    return clean, rejects


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet. A given schema saves the job that reads it from a file's footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet, replacing what is at ``path``."""
    df.write.mode("overwrite").parquet(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the data files below ``path``; no file content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def results_manifest(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(result, n_rows) for every named Parquet dataset, read back from storage."""
    counts = [
        read_parquet(spark, path).agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("result"), "n_rows"
        )
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts)
