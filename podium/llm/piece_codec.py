"""Piece ids of whole texts for merge-type (BPE) sentencepiece vocabularies, and back.

A text's characters start as symbols; of all adjacent pairs whose union is a
piece, the one with the best score (the leftmost of equals) is merged, until
there is none. The agenda of these pairs is kept in score order. No piece has a
space mark behind another character, so no merge crosses the start of a word,
nor any two characters that stand side by side in no piece: texts are cut at
these places, and the parts are merged on their own and cached. The new parts
of a batch are merged together, each by its own agenda, one merge of every part
at a time; very long parts have a heap. In every Arrow batch the library checks
the new parts, or, if wanted, all texts.
"""

from __future__ import annotations

import codecs
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from podium.llm.tables import map_batches
from podium.llm.words import chunks, gathered

SPACE = "▁"
# Parts in the cache, and those of one batch besides, about 200 bytes each.
CACHE_PARTS = 200_000
# Parts of more characters have a heap of their own, and are not cached.
_WIDTHS = (8, 16, 32, 64)
# Bytes of text that are encoded together; a longer text is a slice of its own.
_SLICE_BYTES = 1 << 21
# Ids that are decoded together; a longer list is a slice of its own.
_SLICE_IDS = 1 << 18
_NONE = np.iinfo(np.int32).max


def _one_for_each_byte(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd", error.start + 1


# As the library decodes byte pieces: each byte that is not part of a character is one U+FFFD.
codecs.register_error("podium-each-byte", _one_for_each_byte)


class _PairTable:
    """Rank and union of pairs of symbols, found many at a time by open addressing."""

    def __init__(self, pairs: dict[int, tuple[int, int]]) -> None:
        keys = np.fromiter(pairs, np.int64, len(pairs))
        found = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.last = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.rank, self.piece = np.full(size, _NONE, np.int32), np.full(size, -1, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            # Of those that want a free slot, the last one written has it.
            self.keys[slot[todo[free]]] = keys[todo[free]]
            placed = self.keys[slot[todo]] == keys[todo]
            own = todo[placed]
            self.rank[slot[own]], self.piece[slot[own]] = found[own, 0], found[own, 1]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and union of each pair; ``_NONE`` where there is none. Symbols below 0 have no pairs."""
        # A negative symbol makes a key that is in no slot.
        keys = (left.astype(np.int64) << 32) | right
        keys[right < 0] = -2
        slot = self._slot(keys)
        other = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & self.last
            there = self.keys[slot[other]]
            other = other[(there != keys[other]) & (there >= 0)]
        hit = self.keys[slot] == keys
        return np.where(hit, self.rank[slot], _NONE), self.piece[slot]


class PieceCodec:
    """Ids of a text by score-ordered merges, and the text of ids.

    For vocabularies of type BPE without user-defined symbols; others do not
    fail, but the check against the library shows that the ids differ.
    """

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, size = self.library, len(self.library)
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(self.bytes) < 256 or any(sp.is_unused(i) for i in range(size)):
            raise ValueError("only vocabularies with all byte pieces and no unused ones are supported")
        plain = [(p, i) for i, p in enumerate(pieces) if not special[i]]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in plain):
            raise ValueError("pieces with a space mark inside are not supported")
        symbols = dict(plain)
        # Characters that only occur inside of pieces get ids behind the vocabulary.
        for c in sorted({c for p, _ in plain for c in p}):
            symbols.setdefault(c, len(symbols) + size)
        self.size = size
        self.names = {i: p for p, i in symbols.items()}
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        # Best score first; equal scores share a rank, and the leftmost pair goes first.
        scores = np.array([-sp.get_score(i) for _, i in plain])
        ranks = np.unique(scores, return_inverse=True)[1]
        pairs: dict[int, tuple[int, int]] = {}
        for (p, i), rank in zip(plain, ranks.tolist()):
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = (rank, i)
        self.pairs, self.table = pairs, _PairTable(pairs)
        # Characters that stand side by side in some piece, by classes of characters.
        sides = sorted({p[k : k + 2] for p, _ in plain for k in range(len(p) - 1)})
        members = sorted({c for pair in sides for c in pair})
        self.side = np.zeros(0x110000, np.int32)
        self.side[[ord(c) for c in members]] = np.arange(1, len(members) + 1)
        self.beside = np.zeros((len(members) + 1, len(members) + 1), bool)
        for left, right in sides:
            self.beside[self.side[ord(left)], self.side[ord(right)]] = True
        # A character that the library leaves as it is, and that is in no piece.
        alone = (c for c in "\n\ue000\uf8ff" if self.char[ord(c)] < 0 and sp.normalize(c).endswith(c))
        self.apart = next(alone, None)
        if self.apart is None:
            raise ValueError("no character is left that joins no other")
        self.apart_ids = np.array(sp.encode(self.apart), "<i4").tobytes()
        # What ids decode to. Controls give nothing; the unknown one has a surface of its own.
        text = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in range(size):
            if sp.is_control(i):
                text[i] = b""
            elif sp.is_byte(i):
                text[i] = bytes([int(pieces[i][3:5], 16)])
            elif sp.is_unknown(i):
                text[i] = sp.decode([i]).encode()
        self.text = text
        # Whether a space at the very start of the text is dropped.
        marked = next((i for p, i in plain if p[0] == SPACE and p[1:2] not in ("", SPACE)), None)
        self.drops_space = marked is not None and not sp.decode([marked]).startswith(" ")
        self.marked = np.array([p.startswith(SPACE) and not s for p, s in zip(pieces, special)])
        self.control = np.array([sp.is_control(i) for i in range(size)])
        self.parts: dict[str, bytes] = {}

    # --- encoding ---

    def _merge_together(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge parts given as rows of ``symbols``, padded behind ``counts``; rows and their counts."""
        n, width = symbols.shape
        out, counts = symbols.copy(), counts.copy()
        # The agenda of each part: rank and union of each symbol and the next one.
        rank, piece = self.table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        rank, piece = rank.reshape(n, -1), piece.reshape(n, -1)
        active, own = np.arange(n), symbols
        while width > 1:
            going = np.flatnonzero(rank.min(axis=1) != _NONE)
            if len(going) < len(active):
                done = np.ones(len(active), bool)
                done[going] = False
                out[active[done], :width] = own[done]
                active, own, rank, piece = active[going], own[going], rank[going], piece[going]
            if not len(active):
                return out, counts
            rows = np.arange(len(active))
            j = rank.argmin(axis=1)
            own[rows, j] = piece[rows, j]
            # Each row loses one symbol and one pair, so all stay equally wide.
            stays = np.ones(own.shape, bool)
            stays[rows, j + 1] = False
            own = own[stays].reshape(len(active), -1)
            stays = np.ones(rank.shape, bool)
            stays[rows, j] = False
            rank, piece = rank[stays].reshape(len(active), -1), piece[stays].reshape(len(active), -1)
            width -= 1
            counts[active] -= 1
            # Only the pairs of the new symbol with its neighbours are new.
            for first in (j - 1, j):
                real = np.flatnonzero((first >= 0) & (first < width - 1))
                f = first[real]
                rank[real, f], piece[real, f] = self.table.find(own[real, f], own[real, f + 1])
        out[active, :width] = own
        return out, counts

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """Merge one word of any length: a heap of pairs in score order over a linked list."""
        n, pairs = len(symbols), self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def add(i: int, k: int) -> None:
            a, b = symbols[i], symbols[k]
            found = pairs.get((a << 32) | b) if a >= 0 and b >= 0 else None
            if found is not None:
                heapq.heappush(agenda, (found[0], i, a, b, found[1]))

        for i in range(n - 1):
            add(i, i + 1)
        gone = -(1 << 40)
        while agenda:
            _, i, a, b, union = heapq.heappop(agenda)
            k = after[i]
            if symbols[i] != a or k >= n or symbols[k] != b:
                continue
            symbols[i], symbols[k] = union, gone
            after[i] = after[k]
            if after[i] < n:
                before[after[i]] = i
                add(i, after[i])
            if before[i] >= 0:
                add(before[i], i)
        return [s for s in symbols if s != gone]

    def _ids(self, symbols: list[int], points: list[int]) -> list[int]:
        """Ids of merged symbols; ``points`` are the characters that are in no piece, in order."""
        out: list[int] = []
        chars = iter(points)
        for s in symbols:
            if 0 <= s < self.size:
                out.append(s)
            else:
                name = self.names[s] if s >= 0 else chr(next(chars))
                out += [self.bytes[b] for b in name.encode()]
        return out

    def _encode_segments(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment (no merge crosses their borders), as little-endian 32-bit integers."""
        out: list[bytes | None] = [None] * len(segments)
        lengths = np.array([len(s) for s in segments], np.int64)
        low = 0
        for width in _WIDTHS:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            if not len(chosen):
                continue
            sizes = lengths[chosen]
            points = np.frombuffer("".join(segments[i] for i in chosen).encode("utf-32-le"), "<u4")
            inside = np.arange(width)[None, :] < sizes[:, None]
            rows = np.full((len(chosen), width), -1, np.int32)
            rows[inside] = self.char[points]
            odd = ((rows < 0) | (rows >= self.size)) & inside
            merged, counts = self._merge_together(rows, sizes)
            flat = merged.astype("<i4").tobytes()
            has_odd = odd.any(axis=1).tolist()
            for k, (i, count) in enumerate(zip(chosen.tolist(), counts.tolist())):
                if has_odd[k]:
                    unknown = [ord(c) for c in segments[i] if self.char[ord(c)] < 0]
                    out[i] = np.array(self._ids(merged[k, :count].tolist(), unknown), "<i4").tobytes()
                else:
                    at = k * width * 4
                    out[i] = flat[at : at + count * 4]
        for i in np.flatnonzero(lengths > low).tolist():
            points = np.frombuffer(segments[i].encode("utf-32-le"), "<u4")
            symbols = self._merge_long(self.char[points].tolist())
            out[i] = np.array(self._ids(symbols, points[self.char[points] < 0].tolist()), "<i4").tobytes()
        return out

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct parts of normalised texts, which of them each part is, and each text's first part
        plus the end. No merge crosses the border of two parts."""
        joined = "".join(texts)
        borders = np.cumsum([0, *map(len, texts)])
        if not joined:
            return [], np.zeros(0, np.int64), np.zeros(len(borders), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        side = self.side[points]
        starts = np.ones(len(points), bool)
        np.logical_not(self.beside[side[:-1], side[1:]], out=starts[1:])
        starts[borders[borders < len(points)]] = True
        starts = np.flatnonzero(starts)
        # Where each character begins in UTF-8.
        sizes = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate([[0], np.cumsum(sizes)])
        offsets = at[np.append(starts, len(points))]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())]
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.searchsorted(starts, borders)

    def encode_batch(self, texts: list[str | None], check: bool = False) -> tuple[np.ndarray, np.ndarray, set[int]]:
        """Ids of all texts end to end, and where each one's begin, plus the end.

        An empty or null text has none. With ``check`` the library encodes all
        parts that were not in the cache; the places of texts with parts on
        which it differs are returned too.
        """
        parts, which, first = self._cut([self.library.normalize(t) if t else "" for t in texts])
        if len(self.parts) >= CACHE_PARTS:
            # What this batch needs goes on.
            self.parts = {p: self.parts[p] for p in parts if p in self.parts}
        known = self.parts
        new = [p for p in parts if p not in known]
        known.update(zip(new, self._encode_segments(new)))
        wrong = self._wrong(new) if check and new else set()
        ids, ends = gathered([known[p] for p in parts], which, first, "<i4")
        texts_wrong: set[int] = set()
        if wrong:
            is_wrong = np.array([p in wrong for p in parts])[which]
            texts_wrong = {i for i in range(len(texts)) if is_wrong[first[i] : first[i + 1]].any()}
        for p in new:
            if len(p) > _WIDTHS[-1] or p in wrong:
                del known[p]
        return ids, ends, texts_wrong

    def _wrong(self, parts: list[str]) -> set[str]:
        """Parts that the library encodes in another way, behind a character that joins no other."""
        wanted = self.library.encode([self.apart + p.replace(SPACE, " ") for p in parts], num_threads=1)
        got = [self.apart_ids + self.parts[p] for p in parts]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        if np.array_equal(np.fromiter(map(len, wanted), np.int64, len(wanted)) * 4, sizes):
            flat = np.fromiter(itertools.chain.from_iterable(wanted), "<i4", int(sizes.sum()) // 4)
            if flat.tobytes() == b"".join(got):
                return set()
        return {p for p, a, b in zip(parts, wanted, got) if np.array(a, "<i4").tobytes() != b}

    # --- decoding ---

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. Byte pieces that form no character give U+FFFD, one for each byte."""
        controls = np.flatnonzero(self.control[ids]) if len(ids) else ()
        # Bytes on both sides of a control form no character together.
        runs = [r[r != c] for r, c in zip(np.split(ids, controls), [-1, *ids[controls]])] if len(controls) else [ids]
        out = ""
        for run in runs:
            if not len(run):
                continue
            parts = [self.text[i] for i in run.tolist()]
            if self.drops_space and not out and self.marked[run[0]]:
                parts[0] = parts[0][1:]
            out += b"".join(parts).decode("utf-8", "podium-each-byte")
        return out


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec for each Python worker, kept over its tasks with its cache."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def _texts(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``_SLICE_IDS`` elements of a list column, a row at least."""
    lengths = pc.list_value_length(batch.column(batch.schema.get_field_index(column)))
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + _SLICE_IDS, "right")))
        yield batch.slice(start, end - start)
        start = end


def encode_documents(docs: DataFrame, model_path: str, *, check: str | None = "parts") -> DataFrame:
    """``docs`` with ``ids`` (its text's piece ids) and ``ids_agree``; such named columns are replaced.

    No begin or end ids, no sampling. A null or empty text has an empty list.
    ``ids_agree`` tells whether the library gives the same ids: for each new
    part of a word in a batch (``check="parts"``), or for all whole texts
    (``"texts"``); it is null without a check. Texts are taken whole; a batch is worked on in
    slices of about two megabytes of text, a row at least. One pass, no exchange;
    rows that repeat are encoded as often.
    """
    docs = docs.drop("ids", "ids_agree")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            for part in chunks(batch, size=_SLICE_BYTES):
                texts = _texts(part, "text")
                flat, ends, wrong = own.encode_batch(texts, check == "parts")
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                if check == "texts":
                    wanted = own.library.encode([t or "" for t in texts], num_threads=1)
                    wrong = {i for i, w in enumerate(wanted) if w != flat[ends[i] : ends[i + 1]].tolist()}
                agree = pa.array([None if check is None else i not in wrong for i in range(len(texts))], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids, agree], names=[*part.schema.names, "ids", "ids_agree"]
                )

    return map_batches(
        docs,
        encode,
        [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_agree", T.BooleanType())],
    )


def decode_documents(docs: DataFrame, model_path: str, *, check: bool = True) -> DataFrame:
    """``docs`` with ``decoded``, the text of its ``ids``, and ``text_agrees``; such named columns are replaced.

    A null or empty list decodes to an empty text. ``text_agrees`` tells whether
    the library decodes the same text, and is null without ``check``.
    """
    docs = docs.drop("decoded", "text_agrees")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path)
        for batch in batches:
            for part in _slices(batch, "ids"):
                column = part.column(part.schema.get_field_index("ids"))
                lists = [np.zeros(0, np.int32) if x is None else x.to_numpy() for x in (c.values for c in column)]
                texts = [own.decode(ids) for ids in lists]
                agree = pa.nulls(len(texts), pa.bool_())
                if check:
                    wanted = own.library.decode([ids.tolist() for ids in lists], num_threads=1)
                    agree = pa.array([w == t for w, t in zip(wanted, texts)], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string()), agree],
                    names=[*part.schema.names, "decoded", "text_agrees"],
                )

    return map_batches(
        docs,
        decode,
        [T.StructField("decoded", T.StringType()), T.StructField("text_agrees", T.BooleanType())],
    )
