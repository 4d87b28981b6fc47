"""Importance resampling of documents towards a target's word n-grams.

Every run of one to three words is a feature, hashed to a bucket. Bucket counts
of all documents and of all target texts give each bucket a gain, the logarithm
of its smoothed ratio; a document's weight is the sum of its features' gains,
scored on whole arrays. With Gumbel noise added, the highest scores are a draw
without replacement in proportion to the weights. The k-th highest is found by
a distributed quickselect: random pivot keys, the exact numbers of keys below,
at and above each, and only the keys between the two nearest pivots go on. The
winners alone are sorted, and ranked by prefix sums over the ranges.
(Xie et al., "Data Selection for Language Models via Importance Resampling", 2023.)
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.words import chunks, lower_bytes, text_bytes, words_of
from podium.operators import free_name
from podium.sources import materialize, scratch_scope

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
SEED = 42
# Pivot keys of one round of the selection, on average; so many keys are settled without pivots.
PIVOTS = 12
_SETTLED = 256

# Words are runs of digits, small letters (after A-Z became a-z) and bytes beyond ASCII.
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = True
_IS_WORD[0x61:0x7B] = True
_IS_WORD[0x80:] = True

# --- checksums of n-grams ---------------------------------------------------

# Shifts past so many bytes are looked up at once, longer ones in steps.
_STEP = 64


def _byte_table() -> np.ndarray:
    """CRC-32 of each byte value, with the usual reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = _byte_table()


def _shift_tables() -> np.ndarray:
    """[n, k, b]: what byte ``b`` at place ``k`` of a checksum becomes ``n`` bytes later."""
    table = np.empty((_STEP + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_STEP):
        table[n + 1] = _CRC[table[n] & 255] ^ (table[n] >> np.uint32(8))
    return table


_SHIFT = _shift_tables()
_SPACE = zlib.crc32(b" ")


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of ``crc`` in the checksum of a string that goes on for ``n`` more bytes."""
    out, n = crc.astype(np.uint32), n.copy()
    todo = np.flatnonzero(n >= 0)
    while len(todo):
        c, step = out[todo], np.minimum(n[todo], _STEP)
        moved = _SHIFT[step, 0, c & 255]
        for k in range(1, 4):
            moved = moved ^ _SHIFT[step, k, (c >> np.uint32(8 * k)) & 255]
        out[todo] = moved
        n[todo] -= step
        todo = todo[n[todo] > 0]
    return out


def crc_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes from each start to its end."""
    lengths = ends - starts
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    short = np.flatnonzero(lengths <= _STEP)
    at = 0
    while len(short):
        c = crc[short]
        crc[short] = _CRC[(c ^ raw[starts[short] + at]) & 255] ^ (c >> np.uint32(8))
        at += 1
        short = short[lengths[short] > at]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _STEP).tolist():
        crc[i] = zlib.crc32(raw[starts[i] : ends[i]])
    return crc


def gram_buckets(
    texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Buckets of all 1-, 2-, ... ``longest``-grams, the words that each starts at, and
    each text's first word plus the end."""
    raw, offsets = text_bytes(texts)
    raw = lower_bytes(raw)
    starts, ends, first = words_of(raw, offsets, _IS_WORD)
    own = crc_of(raw, starts, ends)
    length = ends - starts
    # Of a space and the word.
    spaced = _shifted(np.full(len(own), _SPACE, np.uint32), length) ^ own
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, crc = np.arange(len(own)), own
    grams, words = [], []
    for n in range(1, longest + 1):
        if n > 1:
            # Grams go on by a word if the text has one more.
            goes_on = at + n - 1 < len(own)
            at, crc = at[goes_on], crc[goes_on]
            same = text[at + n - 1] == text[at]
            at, crc = at[same], crc[same]
            crc = _shifted(crc, length[at + n - 1] + 1) ^ spaced[at + n - 1]
        grams.append((crc % np.uint32(buckets)).astype(np.int64))
        words.append(at)
    return grams, words, first


# --- counts, gains and weights ----------------------------------------------


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all rows of ``texts`` (text) in each bucket. A task sends a row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch):
                for grams in gram_buckets(part.column(0), buckets, longest)[0]:
                    total += np.bincount(grams, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket bigint, n bigint")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares) of each bucket."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1.0) * (s.sum() + n) / ((s + 1.0) * (t.sum() + n))
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio.tolist()], np.int64)


def weighted(docs: DataFrame, of_bucket: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """(doc_id, tie, n_words, n_features, weight) of each row; ``tie`` is a hash of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(of_bucket)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in chunks(batch):
                texts = part.column(part.schema.get_field_index("text"))
                grams, words, first = gram_buckets(texts, len(own), longest)
                n_words = np.diff(first)
                by_word, n_features = np.zeros(first[-1], np.int64), np.zeros(len(n_words), np.int64)
                for n, (g, at) in enumerate(zip(grams, words)):
                    by_word[at] += own[g]
                    n_features += np.maximum(n_words - n, 0)
                sums = np.concatenate([[0], np.cumsum(by_word)])
                columns = [n_words, n_features, sums[first[1:]] - sums[first[:-1]]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("doc_id")),
                        part.column(part.schema.get_field_index("tie")),
                        *[pa.array(c, pa.int64()) for c in columns],
                    ],
                    names=["doc_id", "tie", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    return rows.mapInArrow(
        weigh, "doc_id bigint, tie bigint, n_words bigint, n_features bigint, weight bigint"
    )


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from a hash of the seed and the id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


# --- selection --------------------------------------------------------------

# The composite key, smallest first: no two rows share it.
_KEY = ["below", "no_id", "doc_id", "tie", "row_no"]


def _key(values: tuple | None = None) -> Column:
    if values is None:
        return F.struct(*_KEY)
    types = {"no_id": "boolean"}
    return F.struct(*[F.lit(v).cast(types.get(n, "bigint")).alias(n) for n, v in zip(_KEY, values)])


def kth_key(keys: DataFrame, n: int, k: int, folder: str, *, pivots: int = PIVOTS) -> tuple:
    """The ``k``-th smallest (from 1) of the ``n`` composite keys, none of them equal.

    Each round draws random keys as pivots by a hash of the row number. One
    aggregate counts the keys below, at and above each pivot exactly; the keys
    between the two pivots that enclose the place go on, written anew. Hence
    the rounds grow with the logarithm of ``n``, and the driver holds a few
    hundred keys at most: the drawn ones, or the last ``_SETTLED``.
    """
    number, order = 0, F.col("row_no")
    while n > _SETTLED:
        number += 1
        share = min(1.0, pivots / n)
        drawn = F.pmod(F.xxhash64(order, F.lit(number)), F.lit(1 << 40)) < int(share * (1 << 40)) + 1
        chosen = sorted((tuple(r) for r in keys.where(drawn).collect()), key=_sortable)
        if not chosen:
            continue
        counts = keys.agg(
            *[F.count_if(_key() < _key(p)).alias(f"below_{i}") for i, p in enumerate(chosen)],
            *[F.count_if(_key() == _key(p)).alias(f"at_{i}") for i, p in enumerate(chosen)],
        ).head()
        below = list(counts[: len(chosen)])
        at = list(counts[len(chosen) :])
        low, high, before, end = None, None, 0, n
        for pivot, b, e in zip(chosen, below, at):
            if b < k <= b + e:
                return pivot
            if b + e < k:
                low, before = pivot, b + e
            elif high is None:
                high, end = pivot, b
        if low is not None:
            keys = keys.where((_key() > _key(low)) & (F.col("below") >= low[0]))
        if high is not None:
            keys = keys.where((_key() < _key(high)) & (F.col("below") <= high[0]))
        n, k = end - before, k - before
        keys = materialize(keys, f"keys-{number}", folder=folder)
    return sorted((tuple(r) for r in keys.collect()), key=_sortable)[k - 1]


def _sortable(key: tuple) -> tuple:
    return tuple((v is not None, v or 0) for v in key)


def _ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` in the order of their keys, from 1."""
    spread = winners.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)
    place = F.monotonically_increasing_id()
    spread = spread.withColumns({"range": F.shiftright(place, 33), "at": place.bitwiseAND((1 << 33) - 1)})
    spread = materialize(spread, "winners")
    # A row for each range.
    sizes = spread.groupBy("range").agg(F.count("*").alias("n"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return spread.join(F.broadcast(bases), "range").withColumn("rank", F.col("base") + F.col("at") + 1)


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = 5,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, tie, n_features, weight, score, rank) of each row of ``docs`` (doc_id, text).

    ``target`` is (text). Of the N rows with ``least_words`` words or more, the
    floor(``percent`` * N / 100) with the highest scores are drawn; ties go to
    the smaller id (null ids last), then to the smaller hash of the text
    (``tie``); rows that repeat both take any order. Ranks are from 1, null for
    rows that are not drawn. A null or empty text has no features and weight 0.
    Without target texts all buckets are rated against an even spread; without
    documents there are no rows. Other columns are not read. Texts are read
    twice, for the counts and for the weights; the gains (``buckets`` numbers)
    are broadcast.
    """
    of_bucket = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighted(docs, of_bucket).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    keyed = scored.withColumns(
        {"below": -F.col("score"), "no_id": F.col("doc_id").isNull(), "row_no": F.monotonically_increasing_id()}
    )
    keyed = materialize(keyed, "scored")
    columns = ["doc_id", "tie", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("bigint").alias("rank")
    may = F.col("n_words") >= least_words
    n = keyed.where(may).count()
    k = percent * n // 100
    if k == 0:
        return keyed.select(*columns, unranked)
    with scratch_scope(docs.sparkSession, "quickselect") as temp:
        last = kth_key(keyed.where(may).select(*_KEY), n, k, temp)
    is_drawn = may & (_key() <= _key(last))
    drawn = _ranked(keyed.where(is_drawn & (F.col("below") <= last[0])))
    rest = keyed.where(~is_drawn)
    return drawn.select(*columns, "rank").unionByName(rest.select(*columns, unranked))


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, and ``rank`` (such a column is replaced)."""
    drawn = importance_ranks(docs, target, **options).where("rank is not null")
    docs = docs.drop("rank")
    own_id, own_tie, tie = (free_name([*docs.columns, "rank"], c) for c in ("_id", "_tie", "_text_hash"))
    drawn = drawn.select(F.col("doc_id").alias(own_id), F.col("tie").alias(own_tie), "rank")
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)) & (F.col(tie) == F.col(own_tie))
    rows = docs.withColumn(tie, F.xxhash64("text")).join(drawn, same, "left_semi")
    # Rows that repeat both an id and a text: any of them stands for each.
    rows = rows.dropDuplicates(["doc_id", tie])
    return rows.join(drawn, same).select(*[F.col(f"`{c}`") for c in docs.columns], "rank")
