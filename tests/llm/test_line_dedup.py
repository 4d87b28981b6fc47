from __future__ import annotations

import random

import pytest
from podium.llm.line_dedup import dedup_lines, drop_repeated_lines

from .helpers import CLASHES, awkward, frame

SPACE = " \t\r\x0b\x0c"


def brute(rows, min_words):
    """Delete each line in a run of ``min_words`` words that equals an earlier one."""
    keys = sorted({(i is None, i or 0, t or "") for i, t in rows})
    docs = []
    for key in keys:
        lines = [(at, x.strip(SPACE), len(x.split())) for at, x in enumerate(key[2].split("\n"))]
        docs.append((key, [x for x in lines if x[2]]))
    runs = {}
    # Documents with equal ids come in an order of their own: such ids are not in these tests.
    for d, (key, lines) in enumerate(docs):
        for s in range(len(lines)):
            total = 0
            for e in range(s, len(lines)):
                total += lines[e][2]
                run = tuple(x[1] for x in lines[s : e + 1])
                if total >= min_words:
                    runs.setdefault(run, []).append((d, s, e))
    gone = {}
    for places in runs.values():
        for d, s, e in sorted(places)[1:]:
            gone.setdefault(d, set()).update(range(s, e + 1))
    out = {}
    for d, (key, lines) in enumerate(docs):
        dropped = {lines[p][0] for p in gone.get(d, ())}
        split = key[2].split("\n")
        left = [x for at, x in enumerate(split) if at not in dropped]
        text = key[2] if not dropped else "\n".join(left) if any(x.split() for x in left) else ""
        out[(None if key[0] else key[1], key[2])] = (text, len(split), len(dropped))
    return out


def check(spark, rows, min_words):
    df = frame(spark, rows, clashes=True)
    got = dedup_lines(df, min_words).collect()
    want = brute(rows, min_words)
    pairs = sorted(((r.doc_id, r.text or "", r.n_lines, r.n_removed) for r in got), key=str)
    full = sorted(((i, *want[(i, t or "")]) for i, t in rows), key=str)
    assert pairs == full
    assert len(got) == len(rows)


@pytest.mark.parametrize("min_words", [1, 3, 7, 16])
def test_random_lines_equal_brute_force(spark, min_words):
    rng = random.Random(min_words)
    lines = ["a", "b", "c", "d e f", "g h i j k", "  a ", "", " ".join("xyz" * 4)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 14)))) for i in range(40)]
    rows += [(100 + i, f"own{i}\n" + "a\nb\nc\nd e f\ng h i j k\nb\na\n" * 3 + f"end{i}") for i in range(6)]
    rows += [(None, "a\nb\nc"), (200, None), (201, "")]
    check(spark, rows, min_words)


def test_awkward_documents(spark):
    rows = [(i, t) for i, t in awkward() if i not in (5, 7) and not (i is None and t.startswith("w"))]
    check(spark, rows, 16)


def test_rows_that_repeat_id_and_text_are_one_document(spark):
    text = "a line of exactly these nine words in it"
    got = dedup_lines(frame(spark, [(1, text), (1, text), (2, text)]), 5).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text), (1, text), (2, "")]


def test_stage_drops_emptied_documents_and_keeps_columns(spark):
    line = "a line of exactly these nine words in it"
    rows = [(1, line), (2, line), (3, f"{line}\nmore"), (4, ""), (5, None)]
    df = frame(spark, rows)
    out = drop_repeated_lines(df, 5)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect()) == [
        (1, line, len(line)), (3, "more", 4), (4, "", 0), (5, None, None)]


def test_empty_table_and_own_columns(spark):
    assert dedup_lines(frame(spark, [])).count() == 0
    row = dedup_lines(frame(spark, [(1, "x")], clashes=True)).head()
    assert all(row[c] == f"own {c}" for c in CLASHES)


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(frame(spark, awkward()))._jdf.queryExecution().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan
