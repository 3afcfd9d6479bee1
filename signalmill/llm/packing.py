"""What blocks send through exchanges: packed documents, and sorted integers as compressed byte planes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytekernel as K
from .storage import small_batches, text_digest

#: Texts of about so many bytes are dealt together.
DEAL_BYTES = 16 << 20


def squeeze(x: np.ndarray) -> bytes:
    """Integers as byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def expand(blob: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view(np.uint64).reshape(-1)


def deal_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """block, packed: the documents' doc_id, text and digest, dealt into blocks by hash of doc_id and digest and compressed."""
    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids = rows.column("doc_id").fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
        named = K.mix64(ids + np.uint64(1)) ^ rows.column("digest").to_numpy().view(np.uint64)
        block = (K.mix64(named) % np.uint64(blocks)).astype(np.int64)
        by = np.argsort(block, kind="stable")
        numbers, counts = np.unique(block, return_counts=True)
        out = []
        for end, n in zip(np.cumsum(counts), counts, strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows.take(pa.array(by[end - n : end])))
            out.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(out, pa.binary())], names=["block", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for i, j in K.chunks(K.text_buffer(b.column(1))[1], DEAL_BYTES):
                held.append(b.slice(i, j - i))
                size += held[-1].nbytes
                if size >= DEAL_BYTES:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    slim = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_digest(F.col("text")).alias("digest"))
    return slim.mapInArrow(lean_batches(run), "block int, packed binary")


def unpack(rows: pa.Table) -> pa.Table:
    """doc_id, text and digest of a block."""
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in rows.column("packed").to_pylist()]).combine_chunks()


def trim() -> None:
    """Give back what the allocator holds from the block before."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def lean_batches(f):
    """``f`` over batches, giving memory back when a task's last batch is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        trim()

    return run


def lean_group(f):
    """The same for a function of a key and its rows."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        out = f(key, rows)
        trim()
        return out

    return run


def lean_cogroup(f):
    """The same for a function of a key and the rows of two tables."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = f(key, left, right)
        trim()
        return out

    return run
