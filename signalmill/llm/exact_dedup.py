r"""Exact dedup by counting quotient filters.

Texts are equal when identical after deleting every character of ``[\x20\x09-\x0D]``. Of equal
texts the row with the most code points in its original text stays, of those the one with the
smallest doc_id (a null one comes last), and of rows that agree in these too one.

1. One scan names every text by the SHA-256 of its normalised bytes; the first 64 bits are
   its fingerprint. The names are written, with a number for each row.
2. Each scan partition builds counting quotient filters of its fingerprints, one for each range
   of them (the first bits). A filter is a table of slots: a fingerprint's quotient is its home slot, its
   remainder stands in the first free slot from there on, sorted, and three bits a slot say which
   quotients occur, which remainders continue a run and which lie off their home. Each slot has a count.
3. Filters of the same range merge without loss: their remainders, read back with their quotients in
   sorted order, are merged, and the counts of equal ones added. Copies within a partition
   are one entry with a count already, so a group of copies of any size sends one entry a filter.
4. Only texts whose fingerprint counts above one are read again and compared byte by byte:
   normalised texts are a grouping key, after copies inside a batch have been joined.
5. Only rows with a repeated fingerprint are grouped by digest, which gives each group's row that stays: a broadcast bitmap of the repeated
   fingerprints leaves the others where they are.
6. Groups go back to their rows by digest. Digests that more than a thousandth of the rows
   have (a thousand at most) are broadcast, so that no task receives the rows of one group.

A document is a row: rows that share a doc_id but not the text are different documents, and
the filter tells rows apart by doc_id and 64 bits of the original text. Null texts are empty, and empty texts are
equal to each other. A repeated row (same doc_id, same text) is kept once, whatever its other columns hold; which of
them is not said. An empty table gives no rows. A text of any length is one value of a batch of bounded bytes. Extra columns take no part
and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import lean_batches, lean_group
from .storage import join_sized, materialise, only_with, shuffle_width, small_batches, text_digest, without_rows

DELETED = bytes([0x20, *range(0x09, 0x0E)])
#: Entries of a partition's filters at most; then they are sent and new ones begun, so memory doesn't follow the partition.
FILTER_ENTRIES = 1 << 20
#: Slots of a filter an entry.
SLOTS_AN_ENTRY = 4 / 3


def _name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sha, size = [], []
        for raw in b.column(1).to_pylist():
            raw = raw or ""
            sha.append(hashlib.sha256(raw.encode().translate(None, DELETED)).digest())
            size.append(len(raw))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), _fingerprints(sha), pa.array(sha, pa.binary()), pa.array(size, pa.int64())], names=["doc_id", "digest", "fp", "sha", "n_points"])


def _fingerprints(sha: list[bytes]) -> pa.Array:
    return pa.array(np.frombuffer(b"".join(s[:8] for s in sha), dtype=">i8").astype(np.int64))


def _slim(docs: DataFrame) -> DataFrame:
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_digest(F.col("text")).alias("digest"))


def name_texts(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the original text, fp, sha, n_points (code points of the original text) of every row."""
    return _slim(docs).mapInArrow(lean_batches(_name_rows), "doc_id long, digest long, fp long, sha binary, n_points long")


class QuotientFilter:
    """A counting quotient filter of fingerprints of ``bits`` bits, without loss: quotient and remainder are all of them."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, bits: int):
        order = np.argsort(fingerprints, kind="stable")
        fp, c = fingerprints[order], counts[order]
        first = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]][: len(fp)])
        fp, c = fp[first], np.add.reduceat(c, first) if len(fp) else c
        n = len(fp)
        self.bits, self.quotient_bits = bits, min(bits, max(1, int(np.ceil(np.log2(max(2, n * SLOTS_AN_ENTRY))))))
        remainder_bits = bits - self.quotient_bits
        quotient = (fp >> np.uint64(remainder_bits)).astype(np.int64) if remainder_bits < 64 else np.zeros(n, np.int64)
        # the first free slot from home on, for all in sorted order: slot k is max(home k, slot of k - 1, plus one)
        slot = np.maximum.accumulate(quotient - np.arange(n)) + np.arange(n) if n else quotient
        size = max(1 << self.quotient_bits, int(slot[-1]) + 1 if n else 0)
        self.occupied, self.continuation, self.shifted = (np.zeros(size, dtype=bool) for _ in range(3))
        self.remainders, self.counts = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        self.occupied[quotient] = True
        self.continuation[slot[1:]] = quotient[1:] == quotient[:-1]
        self.shifted[slot] = slot != quotient
        self.remainders[slot], self.counts[slot] = fp & np.uint64((1 << remainder_bits) - 1), c

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints, ascending, and their counts. The k-th run belongs to the k-th occupied quotient."""
        used = np.flatnonzero(self.occupied | self.continuation | self.shifted)
        run = np.cumsum(~self.continuation[used]) - 1
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotient << np.uint64(self.bits - self.quotient_bits)) | self.remainders[used], self.counts[used]

    def pack(self) -> bytes:
        """Sizes, the three bits of every slot, and what the slots in use hold."""
        used = self.occupied | self.continuation | self.shifted
        head = np.array([self.bits, self.quotient_bits, len(used)], dtype=np.uint64)
        planes = np.concatenate([np.packbits(x) for x in (self.occupied, self.continuation, self.shifted)])
        return head.tobytes() + planes.tobytes() + self.remainders[used].tobytes() + self.counts[used].tobytes()

    @classmethod
    def unpack(cls, blob: bytes) -> QuotientFilter:
        f = cls.__new__(cls)
        f.bits, f.quotient_bits, size = np.frombuffer(blob, np.uint64, 3).astype(np.int64).tolist()
        width = -(-size // 8)
        f.occupied, f.continuation, f.shifted = (np.unpackbits(np.frombuffer(blob, np.uint8, width, 24 + k * width), count=size).astype(bool) for k in range(3))
        used = np.flatnonzero(f.occupied | f.continuation | f.shifted)
        f.remainders, f.counts = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.int64)
        f.remainders[used] = np.frombuffer(blob, np.uint64, len(used), 24 + 3 * width)
        f.counts[used] = np.frombuffer(blob, np.int64, len(used), 24 + 3 * width + 8 * len(used))
        return f

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        entries = [f.entries() for f in filters]
        return cls(np.concatenate([fp for fp, _ in entries]), np.concatenate([c for _, c in entries]), filters[0].bits)


def repeated_fingerprints(named: DataFrame, ranges: int) -> DataFrame:
    """The fingerprints that occur more than once, from filters built per partition and merged by range. ``ranges`` is rounded up to a power of two."""
    range_bits = max(0, ranges - 1).bit_length()
    bits = 64 - range_bits

    def send(fps: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        part = (fps >> np.uint64(bits)).astype(np.int64) if range_bits else np.zeros(len(fps), np.int64)
        order = np.argsort(part, kind="stable")
        numbers, first = np.unique(part[order], return_index=True)
        packed = [QuotientFilter(fps[x] & np.uint64((1 << bits) - 1), counts[x], bits).pack() for x in np.split(order, first[1:])]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], names=["part", "filter"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            u, c = np.unique(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), return_counts=True)
            fps, counts = np.concatenate([fps, u]), np.concatenate([counts, c])
            if len(fps) >= FILTER_ENTRIES:
                yield send(fps, counts)
                fps, counts = fps[:0], counts[:0]
        if len(fps):
            yield send(fps, counts)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        fp, counts = QuotientFilter.merged([QuotientFilter.unpack(x) for x in table.column("filter").to_pylist()]).entries()
        if range_bits:
            fp = fp | (np.uint64(key[0].as_py()) << np.uint64(bits))
        return pa.table({"fp": pa.array(fp[counts > 1].view(np.int64))})

    packed = named.select("fp").mapInArrow(lean_batches(build), "part int, filter binary")
    return packed.groupBy("part").applyInArrow(lean_group(merge), "fp long")


def _distinct_in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen: dict[bytes, int] = {}
        for raw in b.column(0).to_pylist():
            body = (raw or "").encode().translate(None, DELETED)
            seen[body] = seen.get(body, 0) + 1
        sha = [hashlib.sha256(x).digest() for x in seen]
        yield pa.RecordBatch.from_arrays([_fingerprints(sha), pa.array(sha, pa.binary()), pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["fp", "sha", "body", "n"])


def verified_groups(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """sha and group_size of each group of byte-equal normalised texts with a repeated fingerprint."""
    texts = _slim(docs).select("text").mapInArrow(lean_batches(_distinct_in_batch), "fp long, sha binary, body binary, n long")
    return only_with(texts, repeated, "fp").groupBy("fp", "sha", "body").agg(F.sum("n").alias("group_size")).select("sha", "group_size")


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, digest and sha of every row, and of rows of groups keep_id, group_size and whether it is the row that stays."""
    named = materialise(name_texts(docs).withColumn("row", F.monotonically_increasing_id()), "exact-named")
    repeated = materialise(repeated_fingerprints(named, shuffle_width(docs.sparkSession)), "exact-repeated")
    # the greatest of lengths, then of complements: the smallest doc_id, null last, and the smallest number
    best = F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("doc"), F.bitwise_not("row").alias("row"))).alias("best")
    first = only_with(named, repeated, "fp").groupBy("sha").agg(best, F.count("*").alias("n")).where("n > 1")
    groups = verified_groups(docs, repeated).where("group_size > 1").join(first, "sha")
    groups = materialise(groups.select("sha", "group_size", F.bitwise_not("best.doc").alias("keep_id"), F.bitwise_not("best.row").alias("keep_row")), "exact-groups")
    joined = join_sized(named, groups, "sha", "group_size")
    return joined.select("doc_id", "digest", "sha", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("stays"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    grouped = F.col("group_size").isNotNull()
    return _marked(docs).select(
        "doc_id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("stays", F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marks = _marked(docs).where("group_size is not null").groupBy("doc_id", "digest").agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
    marks = materialise(marks.where("not stays or n > 1"), "exact-marks")
    return without_rows(docs, marks.where("not stays"), marks.where("stays"))
