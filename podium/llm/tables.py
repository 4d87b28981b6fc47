"""The given tables these operators read, with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from podium.operators import free_name
from podium.sources import read_parquet

# The columns of the given tables.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def map_batches(docs: DataFrame, fn: Callable, extra: Sequence[T.StructField] = ()) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names; ``fn`` adds ``extra`` behind them."""
    names: list[str] = []
    for i, c in enumerate(docs.columns):
        # Names with dots are not taken as they are.
        names.append(free_name([*docs.columns, *names], f"_{i}") if "." in c or "`" in c else c)
    fields = [T.StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    mapped = docs.toDF(*names).mapInArrow(fn, T.StructType([*fields, *extra]))
    return mapped.toDF(*docs.columns, *[f.name for f in extra])
