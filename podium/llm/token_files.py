"""Token ids as flat binary files with 64-bit document offsets.

A part file ``part-*.bin`` holds the ids of its documents back to back as
unsigned little-endian integers (16 bits where the vocabulary allows, else 32).
Its index ``part-*.idx`` holds little-endian 64-bit integers: for each document
its id, 1 or 0 for a null id, and the offset at which it ends. Parts are in
ascending document order; the base of a part is the number of ids in all parts
before it, from prefix sums over the parts' totals.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from podium.llm.tokens import SLICE_BYTES, encoder, rows_of
from podium.llm.words import chunks
from podium.sources import materialize, scratch_dir

_MANIFEST = "part int, path string, n_docs bigint, n_tokens bigint"
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
# Documents in one batch that the reader returns.
_READ_DOCS = 4096


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or ":/" in path else f"file://{path}")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocabulary: int = 50_257
) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files; the manifest, a row for each part.

    Documents are in ascending ``doc_id`` order, null ids first; rows with the
    same id are ordered by a hash of their text. A null or empty text is its
    end id alone. Other columns are not read. No documents, no parts. A range
    exchange deals the texts, repeated ids included, so no key fills a task. A
    task that is run again writes files of its own name, and the manifest,
    itself on shared storage, names those of the attempt that counted.
    """
    dtype = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer_path, end_id, dtype)
        part = TaskContext.get().partitionId()
        fs, base = _filesystem(folder)
        path, index, at = f"part-{part:06d}-{uuid.uuid4().hex}", [], 0
        out = None
        for batch in batches:
            for rows in chunks(batch, size=SLICE_BYTES):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{path}.bin")
                doc_ids, texts = (rows.column(rows.schema.get_field_index(c)) for c in ("doc_id", "text"))
                ids, ends = code.encode_batch(texts.to_pylist())
                out.write(ids.tobytes())
                numbers, null = doc_ids.fill_null(0).to_numpy(), doc_ids.is_null().to_numpy(zero_copy_only=False)
                index.append(np.stack([numbers, null, at + ends[1:]], 1).astype("<i8"))
                at += len(ids)
        if out is not None:
            out.close()
            n_docs = sum(map(len, index))
            with fs.open_output_stream(f"{base}/{path}.idx") as f:
                f.write(np.concatenate(index).tobytes())
            row = [[part], [path], [n_docs], [at]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)],
                names=["part", "path", "n_docs", "n_tokens"],
            )

    order = ["doc_id", "_tie"]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(parts.mapInArrow(write, _MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str, dtype: str = "<u2") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files.

    The part bases are prefix sums over the manifest, which has one row for
    each part. Local files are memory-mapped.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def ids_of(path: str) -> np.ndarray:
        where = urlparse(f"{folder}/{path}")
        if where.scheme in ("", "file") and os.path.exists(where.path):
            return np.memmap(where.path, np.dtype(dtype), "r")
        fs, base = _filesystem(folder)
        with fs.open_input_file(f"{base}/{path}") as f:
            return np.frombuffer(f.read(), dtype)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder_path = _filesystem(folder)
        for batch in batches:
            for path, base in rows_of(batch, "path", "base"):
                with fs.open_input_file(f"{folder_path}/{path}.idx") as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
                ids, ends = ids_of(f"{path}.bin"), index[:, 2]
                starts = np.concatenate([[0], ends[:-1]])
                for i in range(0, len(index), _READ_DOCS):
                    cut = slice(i, i + _READ_DOCS)
                    sums = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(starts[cut], ends[cut])
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(index[cut, 0], pa.int64(), mask=index[cut, 1] == 1),
                            pa.array(base + starts[cut], pa.int64()),
                            pa.array(ends[cut] - starts[cut], pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # About one part a task.
    return parts.repartition(max(1, manifest.count()), "part").mapInArrow(read, _READ)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a folder of the shared storage and read the files back."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, tokenizer_path, end_id)
    return read_token_files(manifest, folder)
