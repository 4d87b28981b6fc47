"""Benchmark decontamination: passages of documents within an edit distance of an item.

Words are compared, so an edit is a word put in, left out or replaced. A
random walk (CGK) maps a window of words to a sequence in which positions
that differ count its edits from another window: at each step the walk writes
the word it stands on and moves on if a random bit of that word says so. Hashes
of a few random positions (bit sampling) then agree with good chance for near
windows; walks and hashes are repeated to reach the target recall. A walk only
reads the first words of a window, so one walk serves the windows of all item
sizes that start at a word. Starts in documents are a few words apart, and an
item is indexed by all its suffixes, so that each occurrence holds several of
them. Every candidate is verified by its exact edit distance on whole words.

(Chakraborty, Goldenberg and Koucky, "Streaming Algorithms for Embedding and
Computing Edit Distance in the Low Distance Regime", 2016; Zhang and Zhang,
"EmbedJoin", 2017.)
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.llm.tables import map_batches
from podium.llm.words import Lookup, chunks, hash_words, lower_bytes, mix, text_bytes, words_of

# Share of an item's words that may be edited: a similarity of 0.8 or more.
EDITS = 0.2
# Words between the starts in a document.
STRIDE = 4
# Steps of a walk, walks, hashes of each walk, and positions in a hash.
STEPS, WALKS, HASHES, SAMPLED = 14, 4, 4, 4
# Items with fewer words are found by their halves, of which an edit leaves one whole.
SHORT = 10
# Suffixes of fewer words are not indexed.
_LEAST_SUFFIX = 7
# Characters of items that are indexed and broadcast at a time.
BLOCK_CHARS = 8_000_000
_HITS = "item_id bigint, distance int, item_words int, first_word int, last_word int"

_RANDOM = np.random.default_rng(20_160_619)
_BITS = _RANDOM.integers(1, 1 << 62, (WALKS, STEPS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Sampled positions lie apart, else they would often be the same word.
_SAMPLES = np.stack(
    [
        [np.sort(_RANDOM.choice(STEPS // 2, SAMPLED, replace=False) * 2 + h % 2) for h in range(HASHES)]
        for _ in range(WALKS)
    ]
)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[128:] = True
for _range in (range(48, 58), range(65, 91), range(97, 123)):
    _IS_WORD[list(_range)] = True


def words_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of letters and digits, A-Z as a-z, and each text's first plus the end."""
    raw, offsets = text_bytes(texts)
    raw = lower_bytes(raw)
    starts, ends, first = words_of(raw, offsets, _IS_WORD)
    return hash_words(raw, starts, ends), first


def sketches(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the window from each start on, a row for each; a walk past
    ``ends`` stands on nothing."""
    padded = np.append(words, np.uint64(0))
    out = np.empty((WALKS * HASHES, len(starts)), np.uint64)
    for walk in range(WALKS):
        at = starts.copy()
        seen = np.empty((STEPS, len(starts)), np.uint64)
        for step in range(STEPS):
            seen[step] = padded[np.where(at < ends, at, len(words))]
            at += ((seen[step] * _BITS[walk, step]) >> np.uint64(63)).astype(np.int64)
        for h in range(HASHES):
            row = walk * HASHES + h
            value = np.full(len(starts), row + 1, np.uint64)
            for position in _SAMPLES[walk, h]:
                value = (value ^ seen[position]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            out[row] = mix(value)
    return out


def best_match(item: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(distance, first, last + 1) of the part of ``text`` nearest to ``item``, if within ``most``.

    Bit-parallel edit distance (Myers): one step for each word of the text. Of
    equal distances the first end counts, then the longest part.
    """

    def scan(pattern: list[int], words: list[int], free_start: bool) -> list[int]:
        masks: dict[int, int] = {}
        for i, word in enumerate(pattern):
            masks[word] = masks.get(word, 0) | (1 << i)
        n = len(pattern)
        full, top = (1 << n) - 1, 1 << (n - 1)
        up, down, score, scores = full, 0, n, []
        for word in words:
            equal = masks.get(word, 0)
            x = equal | down
            d0 = (((equal & up) + up) ^ up) | x
            plus, minus = down | (full & ~(d0 | up)), up & d0
            score += ((plus & top) != 0) - ((minus & top) != 0)
            plus = ((plus << 1) | (0 if free_start else 1)) & full
            up, down = (((minus << 1) & full) | (full & ~(d0 | plus))), plus & d0
            scores.append(score)
        return scores

    pattern, words = item.tolist(), text.tolist()
    scores = scan(pattern, words, True)
    if not scores or min(scores) > most:
        return None
    distance = min(scores)
    end = scores.index(distance) + 1
    back = scan(pattern[::-1], words[:end][::-1], False)
    length = max((i + 1 for i, s in enumerate(back) if s == distance), default=end)
    return distance, end - length, end


@dataclass(frozen=True)
class Index:
    """Items of one block by their sketches; ``entries`` are (item, words skipped)."""

    ids: np.ndarray
    words: list[np.ndarray]
    lookup: Lookup
    starts: np.ndarray  # of each distinct hash in the entries, plus the end
    entries: np.ndarray
    halves: dict[int, dict[int, list[tuple[int, int]]]]  # length -> hash -> (item, words before)

    @staticmethod
    def of(items: pd.DataFrame) -> Index:
        words, first = words_in(pa.array(items["text"], pa.string()))
        own = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        hashes, entries, halves = [], [], {}
        for i, item in enumerate(own):
            n = len(item)
            if n >= SHORT:
                skip = np.arange(n - _LEAST_SUFFIX + 1)
                hashes.append(sketches(item, skip, np.full(len(skip), n)).ravel())
                pair = np.stack([np.full(len(skip), i), skip], 1)
                entries.append(np.tile(pair, (WALKS * HASHES, 1)))
            elif n:
                cuts = [(0, n)] if int(EDITS * n) == 0 else [(0, n // 2), (n // 2, n)]
                for a, b in cuts:
                    key = int(_sequence(item, np.array([a]), b - a)[0])
                    halves.setdefault(b - a, {}).setdefault(key, []).append((i, a))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        table = np.concatenate(entries) if entries else np.zeros((0, 2), np.int64)
        order = np.argsort(flat, kind="stable")
        distinct, at = np.unique(flat[order], return_index=True)
        return Index(
            items["item_id"].to_numpy(), own, Lookup(distinct), np.append(at, len(flat)), table[order], halves
        )

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(text, item, place where the item would start), distinct."""
        counts = np.diff(first)
        grid = -(-counts // STRIDE)
        text = np.repeat(np.arange(len(counts)), grid)
        nth = np.arange(grid.sum()) - np.repeat(np.cumsum(grid) - grid, grid)
        starts, ends = first[:-1][text] + STRIDE * nth, first[1:][text]
        found = []
        if len(self.entries):
            for row in sketches(words, starts, ends):
                place = self.lookup.find(row)
                hit = np.flatnonzero(place >= 0)
                times = self.starts[place[hit] + 1] - self.starts[place[hit]]
                entry = np.repeat(self.starts[place[hit]], times)
                entry += np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                at = np.repeat(hit, times)
                item, skip = self.entries[entry].T
                found.append(np.stack([text[at], item, starts[at] - first[text[at]] - skip], 1))
        for length, known in self.halves.items():
            many = np.maximum(counts - length + 1, 0)
            of = np.repeat(np.arange(len(counts)), many)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            lookup = Lookup(np.array(list(known), np.uint64))
            place = lookup.find(_sequence(words, first[:-1][of] + at, length))
            pairs = list(known.values())
            for k in np.flatnonzero(place >= 0):
                found.extend(
                    np.array([[of[k], item, at[k] - skip]]) for item, skip in pairs[place[k]]
                )
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def hits(self, words: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple]:
        """(text, item) -> (distance, first word, last word), verified; the best of each pair."""
        best: dict[tuple[int, int], tuple] = {}
        done: set[tuple[int, int, int]] = set()
        for text, item, start in self.candidates(words, first).tolist():
            own = self.words[item]
            most = int(EDITS * len(own))
            # Candidates of one occurrence differ by its edits: one look covers them all.
            bucket = start // (most + 1)
            if (text, item, bucket) in done:
                continue
            done.add((text, item, bucket))
            low = max(0, bucket * (most + 1) - most)
            high = (bucket + 1) * (most + 1) + len(own) + most
            window = words[first[text] : first[text + 1]][low:high]
            match = best_match(own, window, most)
            if match is not None:
                hit = (match[0], low + match[1], low + match[2] - 1)
                key = (text, item)
                best[key] = min(best.get(key, hit), hit)
        return best


def _sequence(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    value = np.full(len(starts), length, np.uint64)
    for k in range(length):
        value = mix(value ^ words[starts + k])
    return value


def _blocks(items: DataFrame) -> Iterator[pd.DataFrame]:
    """All items, block by block, each small enough for the driver and a broadcast."""
    items = items.select("item_id", "text").where("item_id is not null and text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).head()[0]
    n = max(1, -(-chars // BLOCK_CHARS))
    for block in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).toPandas()


def _matched(docs: DataFrame, index, schema: T.StructType) -> DataFrame:
    """``docs`` once for each item found in it, with what was found."""
    names = schema.names

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = index.value
        for batch in batches:
            for part in chunks(batch):
                words, first = words_in(part.column(part.schema.get_field_index("text")))
                hits = own.hits(words, first)
                if not hits:
                    continue
                keys = list(hits)
                rows = part.take(pa.array([text for text, _ in keys]))
                item = [i for _, i in keys]
                distance, start, end = zip(*hits.values())
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.array(own.ids[item], pa.int64()),
                        *[
                            pa.array(x, pa.int32())
                            for x in (distance, [len(own.words[i]) for i in item], start, end)
                        ],
                    ],
                    names=names,
                )

    return docs.mapInArrow(match, schema)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, item_words, first_word, last_word): items found in ``docs``.

    A row of ``docs`` (doc_id, text) holds an item (item_id, text) if some run of
    its words is within ``EDITS`` times the item's words of it; the best place
    is given, counted in words (runs of letters and digits) from 0. Null texts
    and texts without words hold nothing; items that are null, have no id or no
    words are in nothing. Items with equal ids or texts are found separately,
    rows that repeat are reported as often. Other columns are not read. One
    pass over the documents for each block of items; no exchange.
    """
    docs = docs.select("doc_id", "text")
    found = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(_HITS).fields])
    spark, out = docs.sparkSession, None
    for block in _blocks(items):
        index = spark.sparkContext.broadcast(Index.of(block))
        matched = _matched(docs, index, found).drop("text")
        out = matched if out is None else out.unionByName(matched)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold none of the items, all columns kept.

    Block by block, in the pass that searches: no join, and no key that a row
    would need. Definitions are those of ``contaminated``.
    """
    spark = docs.sparkSession
    for block in _blocks(items):
        index = spark.sparkContext.broadcast(Index.of(block))

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch):
                    words, first = words_in(part.column(part.schema.get_field_index("text")))
                    keep = np.ones(part.num_rows, bool)
                    keep[[text for text, _ in index.value.hits(words, first)]] = False
                    yield part.filter(pa.array(keep))

        docs = map_batches(docs, clean)
    return docs
