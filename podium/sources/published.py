"""Published datasets: a reader sees a whole version or the one before, never a part.

A version is a Parquet folder of its own. It is published by a manifest file
that is written last, under the next number; nothing is renamed or
overwritten, so this also holds on object stores. A job that fails leaves the
published version as it was. Of two writers that publish at once, one raises.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.sources.scratch import hadoop_path
from podium.sources.tables import list_files, read_parquet

_MANIFESTS = "_published"
# Last line of a complete manifest.
_END = "end"


@dataclass(frozen=True)
class Version:
    """One published version: its number, folder (below the dataset), rows, files, bytes and schema."""

    number: int
    folder: str
    n_rows: int
    n_files: int
    n_bytes: int
    schema: str


def _read(spark: SparkSession, path: str) -> Version | None:
    """The version of a manifest file; None if it is incomplete."""
    fs, file = hadoop_path(spark, path)
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    body, _, end = text.rpartition("\n")
    return Version(**json.loads(body)) if end == _END else None


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The published versions that are still kept, the newest first."""
    fs, folder = hadoop_path(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    found = [_read(spark, f"{path}/{_MANIFESTS}/{name}") for name in names if name.isdigit()]
    return sorted((v for v in found if v is not None), key=lambda v: -v.number)


def publish_parquet(df: DataFrame, path: str, *, keep: int = 2) -> Version:
    """Write ``df`` as the next version of the dataset at ``path``, and publish it.

    ``df`` may read the dataset itself. The newest ``keep`` versions stay;
    older ones are deleted after the publication, and so is what an attempt
    that failed here has written. A reader that has begun with a version can
    finish while it is kept. The rows are counted from the written files.
    """
    if keep < 1:
        raise ValueError("at least the published version is kept")
    spark = df.sparkSession
    before = versions(spark, path)
    number = before[0].number + 1 if before else 1
    folder = f"version-{number:08d}-{uuid.uuid4().hex}"
    fs, target = hadoop_path(spark, f"{path}/{folder}")
    try:
        df.write.parquet(f"{path}/{folder}")
        written = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
        files = list_files(spark, f"{path}/{folder}").where(F.col("path").endswith(".parquet"))
        n_files, n_bytes = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).head()
        version = Version(number, folder, written.count(), n_files, n_bytes, df.schema.json())
        _publish(spark, path, version)
    except BaseException:
        fs.delete(target, True)
        raise
    for old in versions(spark, path)[keep:]:
        # The manifest first: a version that is named is whole.
        for part in (f"{_MANIFESTS}/{old.number:08d}", old.folder):
            old_fs, old_path = hadoop_path(spark, f"{path}/{part}")
            old_fs.delete(old_path, True)
    return version


def _publish(spark: SparkSession, path: str, version: Version) -> None:
    fs, manifest = hadoop_path(spark, f"{path}/{_MANIFESTS}/{version.number:08d}")
    # Without overwriting: a second writer of the same number fails here.
    stream = fs.create(manifest, False)
    try:
        stream.write(bytearray(f"{json.dumps(asdict(version))}\n{_END}".encode()))
    finally:
        stream.close()


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest published version of the dataset at ``path``, or the one of that ``number``.

    Raises where there is none, or where files are missing or have other sizes
    than when they were published.
    """
    found = [v for v in versions(spark, path) if number in (None, v.number)]
    if not found:
        raise FileNotFoundError(f"no published version at {path}" + (f" of number {number}" if number else ""))
    version = found[0]
    files = list_files(spark, f"{path}/{version.folder}").where(F.col("path").endswith(".parquet"))
    state = tuple(files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).head())
    if state != (version.n_files, version.n_bytes):
        raise OSError(f"version {version.number} of {path} is not as it was published")
    schema = T.StructType.fromJson(json.loads(version.schema))
    return read_parquet(spark, f"{path}/{version.folder}", schema)
