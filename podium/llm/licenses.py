"""Licence scan: TF-IDF cosine of lines and files to licence templates, and
inheritance from the nearest directory with a licence file.

A document is a file with a path. Each of its lines is compared with short
notices (a header), and the whole document with complete licence texts and with
the notices (a licence file). Term weights are counted over all documents. A file without a header takes the
licence of the nearest ancestor directory that has a licence file.

Only DataFrame operations: no Python on the executors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.sources import materialize

# Short notices of common licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms"
        " of the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0"
        " International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met.",
    ],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved."],
}
# Complete texts of licences, without a holder's name: what a licence file has.
FILES = {
    p.stem: [p.read_text("utf-8")] for p in sorted(Path(__file__).with_name("licence_texts").glob("*.txt"))
}
# Least cosine of a match.
THRESHOLD = 0.6
_NOT_TERM = r"[^\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    """The words of a text, lower case; repeats kept."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _NOT_TERM), lambda t: t != "")


def _template_terms(text: str) -> Counter:
    return Counter(t for t in re.split(r"[^a-z0-9]+", text.lower()) if t)


def _anchors(vectors: list[dict[str, float]], known: Mapping[str, int]) -> list[str]:
    """Terms of which every text that reaches the threshold has one.

    A text without them shares too little of a template: by the Cauchy-Schwarz
    inequality its cosine is at most the root of the squared weights left. Terms
    that are in no document need no place among the anchors; of the others those
    come first that hold much of the weight and are in few documents (``known``).
    """
    anchors: set[str] = set()
    for vector in vectors:
        left = sum(w * w for t, w in vector.items() if t in known and t not in anchors)
        for term, weight in sorted(vector.items(), key=lambda x: (-x[1] ** 2 / (known.get(x[0], 0) + 1), x[0])):
            if left < THRESHOLD**2 * 0.999:
                break
            if term in known and term not in anchors:
                anchors.add(term)
                left -= weight * weight
    return sorted(anchors)


def _holds(text: Column, anchors: list[str]) -> Column:
    """Whether ``text`` has one of the anchors as a word."""
    words = "|".join(re.escape(a) for a in anchors) or "(?!)"
    return text.rlike(rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])")


def _frequencies(docs: DataFrame) -> tuple[DataFrame, int]:
    """(term, df) over all documents, written, and the number of documents."""
    terms = docs.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    counts = materialize(terms.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    return counts, docs.count()


def scan_texts(
    docs: DataFrame,
    templates: Mapping[str, list[str]] = TEMPLATES,
    files: Mapping[str, list[str]] = FILES,
) -> DataFrame:
    """(doc_id, path, unit, licence, cosine): the best template of each line, and of each
    whole text (unit -1), that reaches ``THRESHOLD``. ``docs`` has doc_id, path, text.

    Lines have the notices of ``templates``, whole texts also the texts of ``files``.
    """
    spark = docs.sparkSession
    frequencies, n_docs = _frequencies(docs)
    idf = lambda df: math.log((n_docs + 1) / (df + 1)) + 1
    counted = [
        (name, full, _template_terms(t))
        for full, kind in enumerate((templates, files))
        for name, texts in kind.items()
        for t in texts
    ]
    wanted = sorted({t for _, _, terms in counted for t in terms})
    known = {r.term: r.df for r in frequencies.where(F.col("term").isin(wanted)).collect()}
    vectors = []
    for _, _, terms in counted:
        raw = {t: n * idf(known.get(t, 0)) for t, n in terms.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    rows = [(i, *counted[i][:2], t, w) for i, v in enumerate(vectors) for t, w in v.items()]
    weights = spark.createDataFrame(rows, "template int, licence string, full int, term string, weight double")

    # Whole texts and lines that hold an anchor as a word.
    notices = [v for v, (_, full, _) in zip(vectors, counted) if not full]
    texts = docs.where(_holds(F.col("text"), _anchors(vectors, known))).select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "path", "text"
    )
    texts = materialize(texts, "anchored")
    lines = texts.select("rid", F.posexplode(F.split("text", "\n", -1)).alias("unit", "line"))
    lines = lines.where(_holds(F.col("line"), _anchors(notices, known)))
    whole = texts.select("rid", F.lit(-1).alias("unit"), F.col("text").alias("line"))
    terms = lines.unionByName(whole).select("rid", "unit", F.explode(_terms(F.col("line"))).alias("term"))
    terms = terms.groupBy("rid", "unit", "term").agg(F.count("*").alias("tf"))
    weighed = terms.join(frequencies, "term").select(
        "rid",
        "unit",
        "term",
        "tf",
        (F.col("tf") * (F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1)) + 1)).alias("w"),
    )
    weighed = materialize(weighed, "weighed")
    norms = weighed.groupBy("rid", "unit").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("n_terms")
    )
    # The templates are a fixed list: some thousand rows.
    dots = (
        weighed.join(F.broadcast(weights), "term")
        .where("unit < 0 or full = 0")
        .groupBy("rid", "unit", "template", "licence", "full")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.sum("tf").alias("shared"))
    )
    near = dots.join(norms, ["rid", "unit"]).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
    best = (
        near.where(F.col("cosine") >= THRESHOLD)
        # A file that is a notice is mostly that: not a short text below a header.
        .where((F.col("unit") >= 0) | (F.col("full") == 1) | (2 * F.col("shared") >= F.col("n_terms")))
        .groupBy("rid", "unit")
        .agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "licence")).alias("b"))
    )
    return best.join(texts.select("rid", "doc_id", "path"), "rid").select(
        "doc_id", "path", "unit", F.col("b.licence").alias("licence"), (-F.col("b.minus")).alias("cosine")
    )


def parent(path: Column) -> Column:
    """The directory of a path; a path without a slash is in the root, ''."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def nearest_licences(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """(dir, licence, from_dir): the nearest of each directory's ancestors, itself included,
    that ``licensed`` (dir, licence) has. Directories have as many ancestors as
    their paths have parts, so the join is linear in the paths."""
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.size(parts))
    above = directories.select(
        "dir",
        F.explode(
            F.transform(
                F.filter(depths, lambda n: (n == 0) | (F.col("dir") != "")),
                lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("up")),
            )
        ).alias("a"),
    ).select("dir", "a.depth", "a.up")
    found = above.join(licensed.withColumnRenamed("dir", "up"), "up")
    best = found.groupBy("dir").agg(F.max(F.struct("depth", "licence", "up")).alias("b"))
    return best.select("dir", F.col("b.licence").alias("licence"), F.col("b.up").alias("from_dir"))


def scan_licences(
    docs: DataFrame,
    templates: Mapping[str, list[str]] = TEMPLATES,
    files: Mapping[str, list[str]] = FILES,
) -> DataFrame:
    """(doc_id, path, licence, origin, cosine, from_dir) of each row of ``docs`` (doc_id, path, text).

    ``origin`` is ``file`` for a licence file, ``header`` for a file with a
    licence line, ``directory`` for one that inherits, NULL for one without.
    The best cosine decides, then the licence's name. Of several licence files
    in a directory the best, then the one named first, counts for it. A null
    text has no licence of its own; a null path is in no directory and inherits
    nothing. Rows that repeat are reported as often. No rows, no result rows.
    Other columns are not read.
    """
    docs = docs.select("doc_id", "path", "text")
    found = materialize(scan_texts(docs, templates, files), "found")
    files = found.where("unit = -1 and path is not null")
    order = F.struct((-F.col("cosine")).alias("minus"), "licence")
    licensed = (
        files.groupBy(parent(F.col("path")).alias("dir")).agg(F.min(order).alias("b"))
        .select("dir", F.col("b.licence").alias("licence"))
    )
    directories = docs.where("path is not null").select(parent(F.col("path")).alias("dir")).distinct()
    inherited = nearest_licences(directories, licensed)
    inherited = materialize(inherited, "inherited", true_size=True)

    # A whole file before a header; rows that repeat have the same best.
    own = found.groupBy("doc_id", "path").agg(
        F.min(F.struct((F.col("unit") >= 0).alias("line"), (-F.col("cosine")).alias("minus"), "licence")).alias("own")
    )
    own = own.select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), "own")
    own = materialize(own, "own", true_size=True)
    rows = docs.select("doc_id", "path").withColumn("dir", parent(F.col("path")))
    rows = rows.join(
        own, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")), "left"
    ).join(inherited.withColumnRenamed("licence", "above"), "dir", "left")
    has_own = F.col("own").isNotNull()
    return rows.select(
        "doc_id",
        "path",
        F.when(has_own, F.col("own.licence")).otherwise(F.col("above")).alias("licence"),
        F.when(has_own & ~F.col("own.line"), "file")
        .when(has_own, "header")
        .when(F.col("above").isNotNull(), "directory")
        .alias("origin"),
        F.when(has_own, -F.col("own.minus")).alias("cosine"),
        F.when(~has_own, F.col("from_dir")).alias("from_dir"),
    )
