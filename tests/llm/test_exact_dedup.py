from __future__ import annotations

import hashlib
import re

import pytest
from podium.llm.exact_dedup import exact_dedup
from pyspark.sql import functions as F

from .helpers import SCHEMA, awkward, frame


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def run(spark, path, **kw):
    stream = spark.readStream.schema(SCHEMA).parquet(str(path))
    return exact_dedup(stream, spark.read.schema(SCHEMA).parquet(str(path)), **kw)


def check(rows, result):
    got = result.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == expected(rows)
    # One row of each group stays, and it has the group's id.
    kept = {}
    for r in got:
        if r.kept:
            assert r.text_sha256 not in kept and r.doc_id == r.keep_id
            kept[r.text_sha256] = r
    assert kept.keys() == {r.text_sha256 for r in got}


def weak(text):
    """A digest on which most texts collide: only full texts tell them apart."""
    return F.unhex(F.substring(F.md5(text), 1, 2)).substr(1, 1)


@pytest.mark.parametrize("digest", [None, weak])
def test_groups_equal_brute_force(spark, tmp_path, digest):
    rows = awkward() + [(1000 + i, "copied  text") for i in range(200)]
    frame(spark, rows, clashes=True).drop("a.b").write.parquet(f"{tmp_path}/docs")
    check(rows, run(spark, f"{tmp_path}/docs", **({"digest": digest} if digest else {})))


def test_state_goes_on_over_later_files(spark, tmp_path):
    first, second = awkward()[:20], awkward()[10:]
    second = [(None if i is None else i + 500, t) for i, t in second]
    frame(spark, second).write.parquet(f"{tmp_path}/docs")
    state = f"{tmp_path}/state"
    check(second, run(spark, f"{tmp_path}/docs", state_dir=state))
    frame(spark, first).write.mode("append").parquet(f"{tmp_path}/docs")
    check(first + second, run(spark, f"{tmp_path}/docs", state_dir=state))


def test_empty_table(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/docs")
    assert run(spark, f"{tmp_path}/docs").count() == 0


def test_no_python_in_the_plan(spark, tmp_path):
    frame(spark, awkward()).write.parquet(f"{tmp_path}/docs")
    plan = run(spark, f"{tmp_path}/docs")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
