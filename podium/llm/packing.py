"""Best-fit packing of token pieces, certified by lower bounds.

Each partition packs its own pieces by best-fit decreasing. Dual-feasible
functions give a lower bound on the sequences that its pieces need at least, and
one on those that all pieces need. As long as the number of sequences is above
the latter, partitions keep their well-filled sequences, and the documents of
the others are dealt out anew among fewer partitions and packed again; of a
partition that meets its own bound, these are what the rounding up of that
bound leaves. That ends when the number is certified by the bound of all
pieces, when all that is left is packed in one partition, or when several
exchanges in a row have not brought the number down; the best packing met is
the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.tokens import SLICE_BYTES, encoder
from podium.llm.words import chunks
from podium.sources import materialize

CAPACITY = 1024
# Pieces that one partition packs; about 50 bytes each in its task.
PIECES_PER_PARTITION = 65_536
# Exchanges in a row that may save nothing, and all exchanges at most.
PATIENCE = 5
ROUNDS = 40
# Room that a sequence which takes no part in the next exchange may have.
_ROOM = CAPACITY // 100

_PIECES = "rid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = _PIECES + ", sequence_id bigint, offset bigint, fill bigint, partition_gap bigint"


def piece_lengths(n_tokens: int, capacity: int = CAPACITY) -> list[int]:
    """A document longer than ``capacity`` is cut so that only its first piece may be shorter."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [first] + [capacity] * ((n_tokens - first) // capacity)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Every document's pieces: place in the document, length and checksum of the ids.

    ``rid`` numbers the rows, so documents that share an id, and rows that
    repeat, stay apart. A null or empty text is one piece, its end id. The ids
    themselves stay in the task; the pieces are written to the shared folder.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path, end_id, "<u2")
        rid = TaskContext.get().partitionId() << 40
        for part in (p for batch in batches for p in chunks(batch, size=SLICE_BYTES)):
            rows = []
            doc_ids, texts = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text"))
            every, ends = code.encode_batch(texts)
            every = every.astype("<u4")
            for doc_id, begin, end in zip(doc_ids, ends[:-1].tolist(), ends[1:].tolist()):
                start = 0
                for piece, length in enumerate(piece_lengths(end - begin)):
                    crc = zlib.crc32(every[begin + start : begin + start + length])
                    rows.append((rid, doc_id, piece, start, length, crc))
                    start += length
                    rid += 1
            columns = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["rid", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return materialize(docs.select("doc_id", "text").mapInArrow(cut, _PIECES), "pieces")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The most that the dual-feasible functions prove: no packing has fewer sequences.

    Two families, on the histogram of lengths: lengths above ``capacity - e``
    count as whole and those below ``e`` as nothing, for every ``e``; and
    lengths rounded to multiples of ``1 / k``.
    """
    return histogram_bound(np.bincount(lengths, minlength=capacity + 1).astype(np.int64))


def histogram_bound(count: np.ndarray) -> int:
    """``lower_bound`` of ``count[n]`` pieces of each length ``n`` up to the capacity."""
    capacity = len(count) - 1
    size = np.arange(capacity + 1)
    best = -(-int(count @ size) // capacity)
    for e in range(1, capacity // 2 + 1):
        weight = np.where(size > capacity - e, capacity, np.where(size < e, 0, size))
        best = max(best, -(-int(count @ weight) // capacity))
    for k in range(1, 51):
        whole, rest = np.divmod((k + 1) * size, capacity)
        # Times k * capacity, to stay in integers.
        weight = np.where(rest == 0, size * k, whole * capacity)
        best = max(best, -(-int(count @ weight) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, ...]:
    """(bin, offset) of each length, and the fill of each bin.

    The open bins are kept by their room, of which there are ``capacity``
    values, so the fullest bin that fits is found by a bit scan.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = open_rooms >> length
        if fits:
            r = length + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - r
        if r > length:
            room[r - length].append(b)
            open_rooms |= 1 << (r - length)
    fill = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
    return bins, offsets, fill


def _pack_round(pieces: DataFrame, n_pieces: int, number: int, per_partition: int) -> DataFrame:
    """Deal the pieces out at random, the same way each time, and pack every partition."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(batches)
        rows = pd.concat(frames) if frames else pd.DataFrame()
        if not len(rows):
            return
        lengths = rows["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths)
        first = (number << 52) + (TaskContext.get().partitionId() << 24)
        yield rows.assign(
            sequence_id=first + bins,
            offset=offsets,
            fill=fill[bins],
            partition_gap=len(fill) - lower_bound(lengths),
        )

    partitions = max(1, -(-n_pieces // per_partition))
    dealt = pieces.repartition(partitions, F.xxhash64("rid", F.lit(number)))
    return materialize(dealt.mapInPandas(pack, _PACKED), f"packed-{number}")


def best_fit_pack(
    pieces: DataFrame, *, per_partition: int = PIECES_PER_PARTITION, rounds: int = ROUNDS
) -> DataFrame:
    """Each piece with its ``sequence_id``, its ``offset`` there, gapless from 0, and ``partition_gap``.

    ``pieces`` is a table such as ``token_pieces`` gives. Full pieces are
    sequences of their own. An empty table packs into nothing. A length that is
    null, below 1 or above the capacity raises: no piece is left out.
    ``partition_gap`` is how many sequences the partition that the piece was
    packed in has above its bound: 0 certifies that it needs no fewer.
    """
    length = F.col("length")
    fits = F.coalesce((length >= 1) & (length <= CAPACITY), F.lit(False))
    # A row for each length.
    counts = pieces.groupBy(F.when(fits, length).alias("length")).agg(F.count("*").alias("n")).collect()
    count = np.zeros(CAPACITY + 1, np.int64)
    for row in counts:
        if row["length"] is None:
            raise ValueError(f"{row['n']} pieces have no length from 1 to {CAPACITY}")
        count[row["length"]] = row["n"]
    n_full, n_pieces = int(count[CAPACITY]), int(count[:CAPACITY].sum())
    kept = [
        pieces.where(length == CAPACITY).select(
            "*",
            (-F.col("rid") - 1).alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset"),
            F.lit(0).cast("bigint").alias("partition_gap"),
        )
    ]
    columns = kept[0].columns
    if n_pieces == 0:
        return kept[0]
    bound = histogram_bound(count)
    first = F.col("offset") == 0
    # Sequences that are done, the least number of all met so far, and the tables of that packing.
    n_done, least, best, since = n_full, None, kept, 0
    pool = pieces.where(length < CAPACITY)
    for number in range(rounds + 1):
        packed = _pack_round(pool.select(pieces.columns), n_pieces, number, per_partition)
        open_ = F.col("fill") < CAPACITY - _ROOM
        n, n_open, left = packed.agg(
            F.count_if(first), F.count_if(first & open_), F.count_if(open_)
        ).head()
        if least is None or n_done + n < least:
            least, best, since = n_done + n, [*kept, packed.select(columns)], 0
        else:
            since += 1
        if least == bound or left == 0 or n_pieces <= per_partition or since >= PATIENCE:
            break
        kept = [*kept, packed.where(~open_).select(columns)]
        n_done, pool, n_pieces = n_done + n - n_open, packed.where(open_), left
    out = best[0]
    for part in best[1:]:
        out = out.unionByName(part)
    return out


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences of a packing, the least that any packing of its pieces has by the bounds).

    Equal numbers prove the packing optimal. The driver gets a row for each length.
    """
    lengths = packed.groupBy("length").agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("firsts"))
    count, n = np.zeros(capacity + 1, np.int64), 0
    for row in lengths.collect():
        count[row["length"]], n = row["n"], n + row["firsts"]
    return n, histogram_bound(count) if n else 0


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, partition_gap) of every piece."""
    return best_fit_pack(token_pieces(docs, tokenizer_path, end_id)).drop("rid")
