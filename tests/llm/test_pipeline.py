from __future__ import annotations

import corpus_pipeline
import pytest

from podium.llm.nbsvm import THRESHOLD, classify

from . import test_decontaminate, test_line_dedup
from .helpers import brute_components, frame, shingles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents of the smallest table after each stage."""
    docs = corpus_pipeline.table(spark, SF_DIR, "documents")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), name)
        out.append(docs.toPandas())
    return out


def test_stages_narrow_the_documents_down(stages):
    for before, after in zip(stages[:4], stages[1:5]):
        assert list(after.columns) == list(before.columns)
        assert set(after.doc_id) <= set(before.doc_id) and len(after) > 0.4 * len(before)


def test_near_copies_are_gone(stages):
    left = [s for s in (shingles(t, 5) for t in stages[3].text) if s]
    for i, a in enumerate(left):
        assert not any(100 * len(a & b) >= 80 * len(a | b) for b in left[:i])


def test_every_document_that_is_left_is_packed(stages):
    packed = stages[5]
    assert set(packed.doc_id) == set(stages[4].doc_id)
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert packed.groupby("sequence_id").length.sum().mean() > 900


def test_stages_take_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, []), SF_DIR).count() == 0


def test_run_is_the_stages_in_order(spark, stages):
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(stages[5])


def rows_of(table):
    return sorted(zip(table.doc_id, table.text))


def test_classifier_stage_keeps_what_the_scores_say(spark, stages):
    docs, labels = (corpus_pipeline.table(spark, SF_DIR, t) for t in ("documents", "labels"))
    scores = {r.doc_id: r.score for r in classify(docs, labels).collect()}
    want = [row for row in rows_of(stages[0]) if scores[row[0]] >= THRESHOLD]
    assert rows_of(stages[1]) == want and 0 < len(want) < len(stages[0])


def test_line_stage_equals_brute_force(stages):
    before = rows_of(stages[1])
    cleaned = test_line_dedup.brute(before, 16)
    want = [(i, cleaned[i, t][0]) for i, t in before if not cleaned[i, t][2] or cleaned[i, t][0].split()]
    assert rows_of(stages[2]) == sorted(want) != before


def test_set_join_stage_equals_brute_force(stages):
    before = rows_of(stages[2])
    first = brute_components([shingles(t, 5) for _, t in before], 80)
    assert rows_of(stages[3]) == [row for i, row in enumerate(before) if first[i] == i] != before


def test_decontamination_stage_equals_brute_force(spark, stages):
    items = [tuple(r) for r in corpus_pipeline.table(spark, SF_DIR, "benchmark").collect()]
    before = rows_of(stages[3])
    hit = set()
    for i, t in before:
        text = test_decontaminate.tokens(t)
        held = set(text)
        for _, item in items:
            own = test_decontaminate.tokens(item)
            most = int(test_decontaminate.d.EDITS * len(own))
            # Each word of the item that the text lacks is an edit.
            if own and sum(w not in held for w in own) <= most:
                if test_decontaminate.distance(own, text) <= most:
                    hit.add(i)
                    break
    assert hit and rows_of(stages[4]) == [row for row in before if row[0] not in hit]


def test_run_is_the_stages_row_by_row(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF_DIR).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(stages[5][columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("before, after", [("10000", "1000"), ("0", "1000"), ("200", "200")])
def test_stages_send_small_batches_to_python(spark, before, after):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, before)
    try:
        docs = frame(spark, [(1, "some words"), (2, None)])
        dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs, "")
        assert spark.conf.get(setting) == after
    finally:
        spark.conf.unset(setting)


def test_stages_bound_what_is_held_by_bytes_and_rows(spark):
    in_batch, read = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    # Ten texts of 1 MB: by rows alone they are one batch.
    docs = frame(spark, [(i, f"w{i} " * 250_000) for i in range(10)]).coalesce(1)
    try:
        for name in (in_batch, read):
            spark.conf.unset(name)
        stage(spark, frame(spark, [(1, "some words"), (2, None)]), "")
        assert int(spark.conf.get(read)) == corpus_pipeline.BATCH_ROWS
        def rows_of_batches(batches):
            import pyarrow as pa

            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

        assert max(r.n for r in docs.select("text").mapInArrow(rows_of_batches, "n bigint").collect()) < 10
        spark.conf.set(in_batch, "1000")
        spark.conf.set(read, "10")
        stage(spark, frame(spark, [(1, "some words")]), "")
        assert (spark.conf.get(in_batch), spark.conf.get(read)) == ("1000", "10")
    finally:
        for name in (in_batch, read, "spark.sql.execution.arrow.maxRecordsPerBatch"):
            spark.conf.unset(name)
