"""Pseudonyms and licences."""

from __future__ import annotations

import re

from podium.llm import licenses
from podium.llm.pseudonyms import feistel_number, feistel_text, pseudonymise
from pyspark.sql import functions as F

from .helpers import CLASHES, awkward, frame

TEXTS = [
    "call +1 (415) 555-1234 or +14155551234 now",
    "card 4041894974608795 or 4041-8949-7460-8795, bad 4041894974608796",
    "ip 42.144.35.254 and 300.1.1.1",
    "bosbt.42@mail8.example.com.",
    "on 2024-02-29, 2023-02-29; 31.12.1999 12/31/1999, 2500-01-01",
    "ssn 123-45-6789 000-12-3456 666-12-3456",
    'password=b7db7aa4a5fcc78305 token "0123456789abcdef0123456789abcdef01234567"',
    "plain 12 words, 3.14 and 1,000,000",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def shape(text):
    return re.sub(r"[a-z]", "a", re.sub(r"\d", "9", text))


def test_round_trip_links_and_formats(spark):
    df = frame(spark, [*enumerate(TEXTS), *((i + 100 if i is not None else None, t) for i, t in awkward())], clashes=True)
    made = pseudonymise(df, "key")
    rows = {r.doc_id: r for r in made.collect() if r.doc_id is not None and r.doc_id < 100}
    assert [rows[i].n_found for i in range(8)] == [2, 2, 1, 1, 3, 1, 2, 0]
    assert rows[7].text == TEXTS[7]
    cards = re.findall(r"\d[\d-]+\d", rows[1].text)
    assert cards[0] == cards[1].replace("-", "") and luhn(cards[0]) and cards[2] == "4041894974608796"
    assert cards[0] != "4041894974608795"
    assert "300.1.1.1" in rows[2].text and "2023-02-29" in rows[4].text and "2500-01-01" in rows[4].text
    for i in (0, 1, 4, 5):
        assert shape(rows[i].text) == shape(TEXTS[i])
    assert all(rows[0][c] == f"own {c}" for c in CLASHES if c != "n_found")
    back = pseudonymise(made, "key", invert=True).select("doc_id", "text").collect()
    assert sorted(back, key=str) == sorted(df.select("doc_id", "text").collect(), key=str)
    other = pseudonymise(df.where("doc_id = 1"), "another key").head().text
    assert other != rows[1].text


def test_networks_are_permutations(spark):
    n = 189 * 773
    numbers = spark.range(n).select("id", feistel_number(F.col("id"), (189, 773), "k", "t").alias("p"))
    row = numbers.agg(F.count_distinct("p"), F.min("p"), F.max("p"), F.count_if(F.col("p") == F.col("id"))).head()
    assert tuple(row)[:3] == (n, 0, n - 1) and row[3] < 20
    digits = spark.range(1000).select(F.format_string("%03d", "id").alias("d"))
    made = digits.select(feistel_text(F.col("d"), "0123456789", "k", "t").alias("p"))
    assert made.distinct().count() == 1000 and made.where("length(p) = 3").count() == 1000


def test_pseudonyms_run_no_python_and_need_no_exchange(spark):
    plan = pseudonymise(frame(spark, []).coalesce(1), "k")
    assert plan.count() == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in text


def test_secrets_of_any_case_and_length_and_days_before_months(spark):
    capitals = "9233A8EC0B44D1F76A5E3C2B1A0998877E9329BF"
    texts = [
        f'TOKEN = "{capitals}" token "{capitals.lower()}"',
        "key 9233a8EC0B44d1f7 mixed",
        "hex " + "0a9F" * 60 + " and " + "7b3c" * 500,
        "write to " + "ab1.c" * 60 + "@mail.example.com",
        "on 25/12/2020 and 12/25/2020, not 31/13/2020 or 30/02/2020",
    ]
    df = frame(spark, enumerate(texts))
    made = pseudonymise(df, "key")
    rows = {r.doc_id: r for r in made.collect()}
    assert [rows[i].n_found for i in range(5)] == [2, 1, 2, 1, 2]
    upper, lower = re.findall('"(.*?)"', rows[0].text)
    assert upper != capitals and upper == upper.upper() and upper.lower() == lower
    assert "9233a8EC" not in rows[1].text and "0a9F0a9F" not in rows[2].text and "7b3c7b3c" not in rows[2].text
    assert [len(rows[i].text) for i in range(5)] == list(map(len, texts)) and "ab1.cab1.c" not in rows[3].text
    first, second, *rest = re.findall(r"\d\d/\d\d/\d{4}", rows[4].text)
    assert first != "25/12/2020" and int(first[:2]) > 12 and int(second[:2]) <= 12
    assert rest == ["31/13/2020", "30/02/2020"]
    back = pseudonymise(made, "key", invert=True).select("doc_id", "text").collect()
    assert sorted(map(tuple, back)) == list(enumerate(texts))


def paths(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, path string, text string")


NOTICE = "Licensed under the Apache License, Version 2.0."


def test_headers_files_and_inheritance(spark):
    filler = "the quick brown fox jumps over lazy dogs again and again without any end of words"
    rows = [
        (1, "a/LICENSE", NOTICE),
        (2, "a/x.txt", filler),
        (3, "a/b/y.txt", filler),
        (4, "a/b/z.txt", f"Released under the MIT License.\n{filler}"),
        (5, "a/c/LICENSE", "All rights reserved."),
        (6, "a/c/d/e.txt", filler),
        (7, "q/w.txt", filler),
        (8, "root.txt", filler),
        (9, None, filler),
        (10, "a/n.txt", None),
        (11, "ab/n.txt", ""),
        (2, "a/x.txt", filler),
        (12, None, NOTICE),
    ] + [(100 + i, f"z/{i}", f"{filler} {i}") for i in range(50)]
    got = {}
    result = licenses.scan_licences(paths(spark, rows).withColumn("own", F.lit(1)).withColumn("dir", F.lit("x")))
    for r in result.collect():
        got.setdefault(r.doc_id, []).append((r.licence, r.origin, r.from_dir))
    assert sum(map(len, got.values())) == len(rows)
    assert got[1] == [("Apache-2.0", "file", None)]
    assert got[2] == [("Apache-2.0", "directory", "a")] * 2
    assert got[3] == [("Apache-2.0", "directory", "a")]
    assert got[4] == [("MIT", "header", None)]
    assert got[6] == [("Proprietary", "directory", "a/c")]
    assert got[10] == [("Apache-2.0", "directory", "a")]
    assert got[12] == [("Apache-2.0", "file", None)]
    assert all(got[i] == [(None, None, None)] for i in (7, 8, 9, 11))
    assert all(v == [(None, None, None)] for k, v in got.items() if k >= 100)


def test_a_file_in_the_root_reaches_every_directory(spark):
    rows = [(1, "LICENSE", NOTICE), (2, "deep/er/x", "words"), (3, "y", "words")] + [(i, f"p{i}/x", "other words") for i in range(9, 30)]
    got = {r.doc_id: (r.licence, r.from_dir) for r in licenses.scan_licences(paths(spark, rows)).collect()}
    assert got[2] == ("Apache-2.0", "") and got[3] == ("Apache-2.0", "")


def test_lines_are_not_lost_by_the_anchors(spark):
    """Every template's own lines are found, whatever stands around them."""
    rows = [(i, f"d/{i}", f"some words before\n{t}\nand more words after it, many of them")
            for i, t in enumerate(t for texts in licenses.TEMPLATES.values() for t in texts)]
    names = [name for name, texts in licenses.TEMPLATES.items() for _ in texts]
    got = {r.doc_id: r.licence for r in licenses.scan_licences(paths(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == names


COMPLETE = ["MIT", "BSD-3-Clause", "BSD-2-Clause", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-2.1", "MPL-2.0", "ISC"]


def test_complete_licence_files_reach_their_siblings(spark):
    """Complete texts, with a holder's lines, are licence files; prose of their length is none."""
    texts = licenses.FILES
    filler = "the quick brown fox jumps over lazy dogs again and again without any end of words"
    rows = [(i, f"p{i}/LICENSE", f"Copyright (c) 2019 Jane Q. Doe and others\n\n{texts[n][0]}") for i, n in enumerate(COMPLETE)]
    rows += [(100 + i, f"p{i}/src/main.c", f"{filler} {i}") for i in range(len(COMPLETE))]
    prose = " ".join(f"the owner of the work w{i} gave it to a person w{i % 7} and you may use it or not" for i in range(40))
    rows += [(200, "q/notes", prose), (201, "q/x.c", filler)]
    rows += [(300 + i, f"z{i}/f", f"{filler} {i}") for i in range(50)]
    got = {r.doc_id: (r.licence, r.origin) for r in licenses.scan_licences(paths(spark, rows)).collect()}
    assert [got[i] for i in range(len(COMPLETE))] == [(n, "file") for n in COMPLETE]
    assert [got[100 + i] for i in range(len(COMPLETE))] == [(n, "directory") for n in COMPLETE]
    assert got[200] == got[201] == (None, None) and got[300] == (None, None)


def test_the_mit_text_as_usually_written(spark):
    text = """MIT License

Copyright (c) 2021 Some Company, Inc.

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
    rows = [(1, "a/LICENSE", text), (2, "a/x", "some words")] + [(i, f"z{i}/f", f"other words {i}") for i in range(9, 30)]
    got = {r.doc_id: (r.licence, r.origin) for r in licenses.scan_licences(paths(spark, rows)).collect()}
    assert got[1] == ("MIT", "file") and got[2] == ("MIT", "directory") and got[9] == (None, None)


def test_empty_table(spark):
    assert licenses.scan_licences(paths(spark, [])).count() == 0
