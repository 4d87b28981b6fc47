"""The training-data pipeline: rejects poor documents, deletes repeated lines, keeps
one of each group of near copies, drops benchmark leaks, and packs the rest.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the next one's ``docs``; a lost executor, or a job
that is started anew, goes on from there.
"""

from __future__ import annotations

import public_tokenizers
from podium.llm.decontaminate import drop_contaminated
from podium.llm.line_dedup import drop_repeated_lines
from podium.llm.nbsvm import keep_good
from podium.llm.packing import pack_documents
from podium.llm.set_join import keep_one
from podium.llm.tables import table
from podium.sources import materialize
from pyspark.sql import DataFrame, SparkSession

# Rows that go to a Python worker and back at a time; Spark's own 10,000 are 20 MB of text
# or more, held several times over by the executor's Arrow buffers and each worker.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Bytes of such a batch, about: the sets of 1,000 pairs of long documents are over 100 MB.
BATCH_BYTES = 4 << 20
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Rows that a Parquet reader holds decoded; Spark's own 4,096 are 10 MB of text or more in each task.
_READER_SETTING = "spark.sql.parquet.columnarReaderBatchSize"


def _small_batches(spark: SparkSession) -> None:
    """Set for the session: the caller writes a stage's result, after the stage has returned it."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if int(spark.conf.get(_READER_SETTING)) > BATCH_ROWS:
        spark.conf.set(_READER_SETTING, str(BATCH_ROWS))
    if spark.conf.get(_BYTES_SETTING, None) is None:
        spark.conf.set(_BYTES_SETTING, str(BATCH_BYTES))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go."""
    _small_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents that had nothing else."""
    _small_batches(spark)
    return drop_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, one stays."""
    _small_batches(spark)
    return keep_one(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage near a benchmark item go."""
    _small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as sequences of at most 1024 tokens."""
    _small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# A trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
