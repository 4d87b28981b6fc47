"""Intermediate tables, written once to storage every executor can read.

``materialize`` cuts lineage: the reduced table is on shared storage, so a lost
executor never makes a later stage recompute it. It also gives Catalyst the
table's real size, so ``spark.sql.autoBroadcastJoinThreshold`` decides from a
measured size whether a join on it is broadcast or shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; unset, a folder of the warehouse.

    The session is not changed. On a cluster that names no checkpoint folder, a
    warehouse on the local disk raises: each executor would write to its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_podium_scratch"
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of ``path`` and ``path`` as it takes it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new empty folder in the shared folder, deleted when the application ends."""
    path = f"{scratch_root(spark)}/podium-{name}-{uuid.uuid4().hex}"
    fs, jvm_path = hadoop_path(spark, path)
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` made; one that is gone already is no error."""
    if not path.startswith(f"{scratch_root(spark)}/podium-"):
        raise ValueError(f"not a scratch folder: {path}")
    fs, jvm_path = hadoop_path(spark, path)
    fs.delete(jvm_path, True)


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch folder for the length of a ``with`` block.

    Write or collect every result that reads it inside the block.
    """
    path = scratch_dir(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Set session settings for the length of a ``with`` block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# The shuffle files of a finished write are of no more use: without this they
# stay on the executors' disks until the driver happens to collect its garbage.
_CLEAN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def materialize(
    df: DataFrame,
    name: str,
    *,
    true_size: bool = False,
    folder: str | None = None,
    compact: bool = False,
) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table.

    ``folder`` is one of a ``scratch_scope``; without it the table stays until
    the application ends. With ``true_size`` the files are neither compressed
    nor dictionary-encoded, so their size, which Catalyst takes for the
    table's, is that of the values. Use it for a table that may be broadcast:
    well-compressed files would hide a table too large for that. ``compact``
    takes less disk for numbers packed into bytes, at about the same time.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name) + "/table" if folder is None else f"{folder}/{name}"
    writer = df.write
    if true_size:
        writer = writer.options(**{"compression": "none", "parquet.enable.dictionary": "false"})
    elif compact:
        writer = writer.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"})
    with session_settings(spark, _CLEAN_SHUFFLES):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
