"""Token ids of whole texts, by the tokenizers library, with a word cache.

A byte-level BPE splits a text into words before it merges anything, and a word
starts wherever a space follows a non-space and precedes one. So a text without
runs of spaces is cut at its spaces, each piece with its leading space is
encoded once by the library, and the ids are kept in a bounded cache: equal to
encoding the whole text (tested), several times as fast. Texts go in batches,
whose distinct words are looked up once. All other texts, and all pieces not in
the cache, go to the library itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from podium.llm.words import gathered, split_distinct

# Entries of one generation of the cache; two are kept, about 200 bytes each.
CACHE_WORDS = 200_000
# Bytes of text that are encoded together; a longer text is a slice of its own.
SLICE_BYTES = 1 << 21
# Tail of a word that is a run of ASCII punctuation. The apostrophe is left
# out: a byte-level BPE splits some contractions at it.
_TAIL = '.,!*&%$#|?;:)("'


def _byte_letters() -> dict[int, str]:
    """The letter for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others for the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Little-endian ids of a text, ``dtype`` ``<u2`` or ``<u4``, end id appended."""

    def __init__(self, path: str, end_id: int, dtype: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # Cutting at spaces holds for a byte-level BPE without normaliser and prefix space.
        self.by_word = self.tokenizer.normalizer is None and "add_prefix_space=False" in repr(
            self.tokenizer.pre_tokenizer
        )
        self.dtype = np.dtype(dtype)
        self.letters = _byte_letters()
        self.end = np.array([end_id], self.dtype).tobytes()
        # Keys: a word for the word after a space, "\n" + word for one at a line's start.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _letters(self, text: str) -> bytes:
        """Of one run of letters, perhaps after a space: a single word to the BPE model."""
        word = text.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(word)], self.dtype).tobytes()

    def _keep(self, key: str, ids: bytes) -> bytes:
        if len(self.young) >= CACHE_WORDS:
            self.old, self.young = self.young, {}
        self.young[key] = ids
        return ids

    def _get(self, key: str) -> bytes:
        ids = self.young.get(key)
        if ids is None:
            ids = self._miss(key)
        return ids

    def _miss(self, key: str) -> bytes:
        """Ids of a word that the young generation lacks."""
        ids = self.old.get(key)
        if ids is not None:
            return self._keep(key, ids)
        text, start = (key[1:], "\n") if key[:1] == "\n" else (" " + key, "")
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._keep(key, self._letters(text))
        head, line, rest = text.partition("\n")
        if line and head and rest and not head[-1].isspace() and not rest[0].isspace():
            # A single line feed between two words is a token of its own.
            return self._get(start + head.removeprefix(" ")) + self._line() + self._get("\n" + rest)
        core = text.rstrip(_TAIL)
        if not line and core != text and core and core[-1].isalpha():
            # Letters and punctuation never share a token.
            inner = start + core.removeprefix(" ")
            common = inner in self.young
            ids = self._get(inner) + self._get("\n" + text[len(core) :])
            return self._keep(key, ids) if common else ids
        return self._keep(key, self._direct(text))

    def _line(self) -> bytes:
        return self.young.get("\n\n") or self._keep("\n\n", self._direct("\n"))

    def encode(self, text: str | None) -> bytes:
        """Ids of the text, then the end id; an empty or null text has the end id only."""
        return self.encode_batch([text])[0].tobytes()

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with its end id, and where each begins, plus the end."""
        regular = [self._by_words(t) for t in texts]
        # The first word of a text has no space before it; its key tells so.
        words, which, first = split_distinct(["\n" + t if r else "" for t, r in zip(texts, regular)], " ")
        parts = []
        for word in words:
            ids = self.young.get(word)
            parts.append(self._miss(word) if ids is None else ids)
        # The end id is a word of its own behind each text's words; another text is one word.
        parts.append(self.end)
        ends = np.full(len(texts), len(parts) - 1)
        for i, (text, r) in enumerate(zip(texts, regular)):
            if not r:
                which[first[i]] = len(parts)
                parts.append(self._direct(text) if text else b"")
        counts = np.diff(first)
        placed = np.empty(len(which) + len(texts), np.int64)
        behind = first[1:] + np.arange(len(texts))
        inside = np.ones(len(placed), bool)
        inside[behind] = False
        placed[inside], placed[behind] = which, ends
        own_first = np.concatenate([[0], np.cumsum(counts + 1)])
        return gathered(parts, placed, own_first, self.dtype.str)

    def _by_words(self, text: str | None) -> bool:
        return bool(
            text
            and self.by_word
            and "  " not in text
            and " \n" not in text
            and text[0] not in " \n"
            and text[-1] not in " \n"
        )


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder(path: str, end_id: int, dtype: str = "<u2") -> WordEncoder:
    """One encoder for each Python worker, kept over its tasks with its cache."""
    key = (path, end_id, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, end_id, dtype)
    return _ENCODERS[key]


def rows_of(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """The rows of a batch, one at a time: no list of all its texts is made."""
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in columns]
    for i in range(batch.num_rows):
        yield tuple(a[i].as_py() for a in arrays)
