"""Exact deduplication as a stream with disk-backed keyed state.

The state holds, for each digest of a normalised text, the smallest document
id, the locator (file and row) of that document's content, and the number of
rows so far. It lives in RocksDB on the executors' disks and in the stream's
checkpoint, and never expires, so later files meet the documents of all earlier
ones. A hit is a row whose digest is known: its full text is compared with the
retained document's, read back by the locator; rows that differ are no copies.

Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.sources import materialize, scratch_dir, session_settings

_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Many small stores would each reserve megabytes of disk that they do not fill.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Rows of one group that meet one copy of the retained text.
ROWS_PER_COPY = 64


def normalised(text: Column) -> Column:
    """Null as empty, and each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(docs: DataFrame, digest) -> DataFrame:
    """Each row's id, locator and digest; works on a stream and on a table of files."""
    return docs.select(
        "doc_id",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        digest(normalised(F.col("text"))).alias("digest"),
        F.sha2(normalised(F.col("text")), 256).alias("hex"),
    )


def run_stream(stream: DataFrame, state_dir: str, digest=sha256) -> DataFrame:
    """Take the stream's new files into the state; (digest, first, n) for all digests.

    ``first`` is the retained row: (no_id, doc_id, file, row), a null id after
    all others, equal ids by file and row. A batch that is run again overwrites
    its own folder of updates.
    """
    spark = stream.sparkSession
    state = (
        _located(stream, digest)
        .groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")).alias(
                "first"
            ),
            F.count("*").alias("n"),
        )
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state_dir}/updates/batch={number}")

    with session_settings(spark, _STATE_SETTINGS):
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{state_dir}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
    query.awaitTermination()
    updates = spark.read.schema(state.schema.add("batch", "long")).parquet(f"{state_dir}/updates")
    # A digest has an update for each batch that met it; counts only grow.
    return updates.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def _differing(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(file, row, digest, text) of the hits whose text is not the retained one's.

    Texts are fetched by locator, which is unique, and only those of hits go
    on. The retained text of a group of n rows is copied n / ``ROWS_PER_COPY``
    times, so no group meets in one task.
    """
    texts = docs.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        normalised(F.col("text")).alias("norm"),
    )
    found = materialize(texts.join(hits.hint("shuffle_hash"), ["file", "row"]), "hit-texts")
    copies = F.ceil(F.col("n") / ROWS_PER_COPY).cast("int")
    retained = found.where("is_first").select(
        "digest", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"), F.col("norm").alias("kept")
    )
    others = found.where(~F.col("is_first")).withColumn(
        "copy", F.pmod(F.xxhash64("file", "row"), copies).cast("int")
    )
    return (
        others.join(retained, ["digest", "copy"])
        .where(F.col("norm") != F.col("kept"))
        .select("file", "row", "doc_id", "digest", "norm")
    )


def exact_dedup(
    stream: DataFrame, docs: DataFrame, state_dir: str | None = None, digest=sha256
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``stream`` and ``docs`` read the same files (doc_id, text), as a stream and
    as a table. Of equal texts the row with the smallest id stays; a null id
    comes last; of rows with equal ids, the first by file and row. A null text
    is an empty one, and empty texts are copies of each other. No rows, no
    result rows. Other columns are not read. ``state_dir`` of an earlier run
    continues its state: only new files are read by the stream.
    """
    spark = docs.sparkSession
    state_dir = state_dir or scratch_dir(spark, "exact-dedup")
    firsts = materialize(run_stream(stream, state_dir, digest), "firsts")
    rows = _located(docs, digest)

    # A group of a thousandth of all rows or more: at most a thousand, joined by
    # broadcast. All other groups are smaller than that, so no key is hot.
    n_rows = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    is_large = F.col("n") * 1000 >= max(n_rows, 1000)
    large = firsts.where(is_large).select(
        "digest", F.col("first").alias("large_first"), F.col("n").alias("large_n")
    )
    split = materialize(rows.join(F.broadcast(large), "digest", "left"), "fingerprints")
    columns = ["doc_id", "file", "row", "digest", "hex", "first", "n"]
    of_large = split.where("large_n is not null").withColumnsRenamed(
        {"large_first": "first", "large_n": "n"}
    )
    of_small = split.where("large_n is null").drop("large_first", "large_n").join(firsts, "digest")
    grouped = of_large.select(columns).unionByName(of_small.select(columns))
    grouped = materialize(
        grouped.withColumn(
            "is_first",
            (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row")),
        ),
        "groups",
    )

    hits = grouped.where("n > 1").select("doc_id", "file", "row", "digest", "n", "is_first")
    differing = materialize(_differing(docs, hits), "differing")
    result = grouped.select(
        "doc_id",
        "file",
        "row",
        "digest",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("is_first").alias("kept"),
        F.col("hex").alias("text_sha256"),
    )
    if not differing.isEmpty():
        result = _regrouped(result, differing)
    return result.drop("file", "row", "digest")


def _regrouped(result: DataFrame, differing: DataFrame) -> DataFrame:
    """Give the rows that only share a digest with the retained text their own groups."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row")
    own = differing.groupBy("digest", "norm").agg(F.min(order).alias("own"), F.count("*").alias("m"))
    moved = differing.join(own, ["digest", "norm"]).select("file", "row", "own", "m")
    left = differing.groupBy("digest").agg(F.count("*").alias("gone"))
    is_own = (F.col("file") == F.col("own.file")) & (F.col("row") == F.col("own.row"))
    return (
        result.join(moved, ["file", "row"], "left")
        .join(left, "digest", "left")
        .select(
            "doc_id",
            "file",
            "row",
            "digest",
            F.when(F.col("m").isNull(), F.col("keep_id"))
            .otherwise(F.col("own.doc_id"))
            .alias("keep_id"),
            F.coalesce("m", F.col("group_size") - F.coalesce("gone", F.lit(0))).alias("group_size"),
            F.when(F.col("m").isNull(), F.col("kept")).otherwise(is_own).alias("kept"),
            "text_sha256",
        )
    )
