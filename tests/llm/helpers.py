"""Small tables of awkward documents, and plain definitions to hold results against."""

from __future__ import annotations

import random
import re
from collections import defaultdict

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside; a user's table may have them too.
CLASHES = ["score", "n_found", "_text", "_made", "rid", "_doc", "_gone", "_row_key", "row_key", "digest", "keys", "a.b"]


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=5):
    """Nulls, empty and blank texts, one very long text, ties, near and exact copies."""
    rng = random.Random(seed)
    base = prose(rng, 200)
    words = base.split()
    near = []
    for k in range(12):
        copy = list(words)
        copy[rng.randrange(200)] = f"x{k}"
        near.append(" ".join(copy))
    texts = [None, "", " \n\t ", "one", "two words", base, base, base.upper(), *near]
    texts += [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    texts += [prose(rng, 20_000, 3000), "line\n" * 50, "ünï çödé 日本語 \U0001f600 text", "  a  b ", "a\r\nb\r\n"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(5, base), (7, "same id, other text"), (None, base), (None, "no id at all")]
    return rows


def frame(spark, rows, clashes=False):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA).repartition(4)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASSES_OF(df)])
    return df


def CLASSES_OF(df):
    return [c for c in CLASHES if c not in df.columns]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, n):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute_components(sets, percent):
    """Index -> smallest index reachable by links, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(sets))]


def groups(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
