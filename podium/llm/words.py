"""Words and word n-grams of whole texts as 64-bit hashes, computed on byte buffers.

A word is a run of bytes other than ASCII white space; A-Z count as a-z. Its
hash is a polynomial over a random number for each byte, mixed. Equal words
have equal hashes; two of ten billion different words collide with about one
chance in a few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are hashed together; a longer document is one piece of its own.
CHUNK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20_240_501)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(1 << 40, 1 << 62)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_STEP = [np.uint64(int(x) * 2 + 1) for x in _RANDOM.integers(1 << 40, 1 << 62, 8)]
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, of exponents 0 to n - 1 at least."""
    if len(_POWERS[0]) < n:
        for k, x in enumerate((_BASE, _INVERSE)):
            factors = np.full(n, np.uint64(x), np.uint64)
            factors[0] = 1
            _POWERS[k] = np.multiply.accumulate(factors)
    return _POWERS


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each starts, plus the end. Null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text, a row at least."""
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text)))
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def words_of(
    raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = _IS_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after it, and each text's first word plus the end."""
    is_word = word_bytes[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], is_word[:-1]]) if len(raw) else is_word
    after = np.concatenate([is_word[1:], [False]]) if len(raw) else is_word
    starts = np.flatnonzero(is_word & (~before | cut[:-1]))
    ends = np.flatnonzero(is_word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return _LOWER[raw]


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from each start to its end."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, A-Z as a-z, and each text's first word plus the end."""
    raw, offsets = text_bytes(texts)
    raw = lower_bytes(raw)
    starts, ends, first = words_of(raw, offsets)
    return hash_words(raw, starts, ends), first


def ngram_hashes(
    words: np.ndarray, first: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n-gram, and each text's first plus the end.

    A text with words, but fewer than ``n``, has its whole sequence as one.
    """
    counts = np.diff(first)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_first = np.concatenate([[0], np.cumsum(grams)])
    text = np.repeat(np.arange(len(counts)), grams)
    at = first[:-1][text] + np.arange(out_first[-1]) - out_first[:-1][text]
    length = np.minimum(counts[text], n)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    h = length.astype(np.uint64)
    for k in range(n):
        h = h + np.where(length > k, padded[at + k] * _STEP[k], np.uint64(0))
    return mix(h), out_first


def split_distinct(texts: list[str], separator: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of texts cut at a separator, which of them each word is, and each text's
    first word plus the end."""
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), separator)
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), offsets - offsets[0]


def gathered(parts: list[bytes], which: np.ndarray, first: np.ndarray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """``parts[w]`` of all words ``which``, end to end, and where each text's begin, plus the end.

    ``parts`` are bytes of integers of ``dtype``; a text's words are those from its ``first`` on.
    """
    width = np.dtype(dtype).itemsize
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(parts), dtype)
    own = sizes[which]
    ends = np.concatenate([[0], np.cumsum(own)])
    at = np.repeat(starts[which] - ends[:-1], own)
    at += np.arange(len(at))
    return flat[at], ends[first]


class Lookup:
    """Finds 64-bit hashes in a list of distinct ones, many at a time.

    The list is cut by the hashes' first bits into buckets of one entry or so;
    ``find`` looks through a bucket entry by entry, for all queries at once.
    """

    def __init__(self, hashes: np.ndarray) -> None:
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        bits = max(1, int(len(hashes)).bit_length())
        self.shift = np.uint64(64 - bits)
        bounds = np.searchsorted(self.sorted >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))
        self.start = bounds.astype(np.int64)
        self.longest = int(np.diff(self.start).max()) if len(hashes) else 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in the list, or -1."""
        place = np.full(len(hashes), -1, np.int64)
        if not len(self.sorted):
            return place
        start = self.start[(hashes >> self.shift).astype(np.int64)]
        for k in range(self.longest):
            at = np.minimum(start + k, len(self.sorted) - 1)
            hit = self.sorted[at] == hashes
            place[hit] = self.order[at[hit]]
        return place
