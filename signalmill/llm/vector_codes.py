r"""Compression of vectors to product codes by integer Lloyd rounds.

Every component x becomes the integer floor(4096 * x). Vectors are cut into PARTS equal consecutive parts. Each part has
a codebook, which starts as that part of the ENTRIES smallest vec_ids. A round assigns every part to the nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by floor(sum / count) of its parts; an entry without parts stays.

1. Rows that take part are filtered by expressions and written as columnar blocks: of up to BLOCK_ROWS vectors the integers, one
   dimension after another, in the narrowest type that holds them. Rounds read these blocks only.
2. A round is one ``treeAggregate`` over the RDD of blocks. In a block distances of all entries accumulate dimension by dimension, so
   the largest temporary array has entries x rows of one part; ``np.add.at`` adds the parts into int64 tensors of sums and counts. These
   tensors (entries x dimensions, some kilobytes whatever the table's size) merge through a tree of executors; the last few reach the driver.
3. The codebooks, as small, go out with the next round's function. The last assignment writes code and error of each row.
4. Errors are added up by label with partial aggregates; sums of labels that many rows share meet their rows by broadcast, others by join.

All arithmetic is on integers, so neither the order of rows nor the number of blocks changes a digit.
Rows whose vector is null, or holds a null or non-finite component, are dropped. The dimension is that of the vector with the smallest vec_id; rows of
another length are dropped too, and empty vectors always. A dimension that PARTS doesn't divide is filled up with zeros behind. vec_ids that repeat are rows of their own: the
first entries go by vec_id (null last), then by vector. With fewer rows than ENTRIES there are so many entries. Components of 2^28 and more after
scaling are calculated with Python's integers instead of int64 ones; an error beyond 2^63 - 1 stands as that. An empty table, or one with no
row that takes part, gives no rows. Extra columns take no part and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import lean_batches
from .storage import join_sized, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a block at most.
BLOCK_ROWS = 8192
#: Integers below this in size have squared distances of a part within int64.
WIDE = 1 << 28
_MOST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """Entries of every part: ``entries[e, d]`` is component d of entry e; the parts lie beside each other."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[1] // PARTS

    def sha256(self) -> str:
        """Of all components by part, entry and place in the part, as decimals with commas between."""
        n = self.width
        each = [str(int(x)) for p in range(PARTS) for row in self.entries[:, p * n : (p + 1) * n] for x in row]
        return hashlib.sha256(",".join(each).encode()).hexdigest()


def _takes_part(vector: Column) -> Column:
    """Not null, not empty, and without components that are null or not finite. In the vector's own type a null is told from a NaN."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x): in double precision the product of a number and a power of two is exact."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= WIDE:
        out = np.empty(scaled.shape, dtype=object)
        out.ravel()[:] = [int(x) for x in scaled.ravel()]
        return out
    return scaled.astype(np.int64)


def _filled(rows: np.ndarray) -> np.ndarray:
    missing = -rows.shape[1] % PARTS
    return np.hstack([rows, np.zeros((len(rows), missing), dtype=rows.dtype)]) if missing else rows


def _pack(columns: np.ndarray) -> tuple[str, bytes]:
    """Type and bytes of the integers (dimensions x rows); decimals where they are too wide."""
    if columns.dtype == object:
        return "decimal", ",".join(map(str, columns.ravel())).encode()
    most = int(np.abs(columns).max(initial=0))
    kind = next(k for k in ("int16", "int32", "int64") if most <= np.iinfo(k).max)
    return kind, columns.astype(kind).tobytes()


def _unpack(kind: str, data: bytes, n: int) -> np.ndarray:
    if kind == "decimal":
        out = np.empty(data.count(b",") + 1, dtype=object)
        out[:] = [int(x) for x in data.split(b",")]
        return out.reshape(-1, n)
    return np.frombuffer(data, dtype=kind).reshape(-1, n).astype(np.int64)


def pack_blocks(vectors: DataFrame, dimension: int) -> DataFrame:
    """n, kind, integers, vec_ids and labels of blocks of up to BLOCK_ROWS rows of ``vectors`` (vec_id, label, vector), whose vectors have this dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, BLOCK_ROWS) for i in range(0, whole.num_rows, BLOCK_ROWS)):
                rows = _integers(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension))
                kind, data = _pack(np.ascontiguousarray(_filled(rows).T))
                named = [pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([b.column(1).to_pylist()], pa.list_(pa.string()))]
                arrays = [pa.array([b.num_rows], pa.int32()), pa.array([kind]), pa.array([data], pa.binary()), *named]
                yield pa.RecordBatch.from_arrays(arrays, names=["n", "kind", "integers", "vec_ids", "labels"])

    return vectors.mapInArrow(lean_batches(run), "n int, kind string, integers binary, vec_ids array<long>, labels array<string>")


def assign(columns: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Of each part (PARTS x rows): the nearest entry and its squared distance."""
    width, n = books.width, columns.shape[1]
    kind = object if object in (columns.dtype, books.entries.dtype) else np.int64
    codes, errors = np.zeros((PARTS, n), dtype=np.int64), np.zeros((PARTS, n), dtype=kind)
    for p in range(PARTS):
        distance = np.zeros((len(books.entries), n), dtype=kind)
        for d in range(p * width, (p + 1) * width):
            off = columns[d][None, :] - books.entries[:, d][:, None]
            distance += off * off
        codes[p] = np.argmin(distance, axis=0)  # the first of equal ones
        errors[p] = distance[codes[p], np.arange(n)]
    return codes, errors


Tally = tuple[np.ndarray, np.ndarray]


def add_block(tally: Tally | None, columns: np.ndarray, books: Codebooks) -> Tally:
    """Sums (entries x dimensions) and counts (entries x parts) with those of a block added."""
    codes, _ = assign(columns, books)
    kind = object if object in (columns.dtype, books.entries.dtype) else np.int64
    sums, counts = np.zeros(books.entries.shape, dtype=kind), np.zeros((len(books.entries), PARTS), dtype=np.int64)
    for p in range(PARTS):
        part = slice(p * books.width, (p + 1) * books.width)
        np.add.at(sums[:, part], codes[p], columns[part].T)
        np.add.at(counts[:, p], codes[p], 1)
    return merge(tally, (sums, counts))


def merge(a: Tally | None, b: Tally | None) -> Tally | None:
    if a is None or b is None:
        return b if a is None else a
    return a[0] + b[0], a[1] + b[1]


def moved(books: Codebooks, tally: Tally) -> Codebooks:
    """Every entry at floor(sum / count) of its parts; unused ones where they were."""
    sums, counts = tally
    each = np.repeat(counts, books.width, axis=1)
    return Codebooks(np.where(each > 0, sums // np.maximum(each, 1), books.entries))


def _prepared(vectors: DataFrame, vector: str) -> DataFrame:
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col(vector).alias("vector"))
    return slim.where(_takes_part(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))


def train(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after so many rounds over written blocks, from these first entries."""
    books = Codebooks(first)
    rdd = blocks.select("n", "kind", "integers").rdd
    for _ in range(rounds):
        now = books
        tally = rdd.treeAggregate(None, lambda t, row, now=now: add_block(t, _unpack(row[1], bytes(row[2]), row[0]), now), merge, depth=3)
        books = moved(books, tally)
    return books


def encode(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, codes (an index a part) and error of every row of ``vectors`` that takes part, and the codebooks (None if there is no row)."""
    schema = "vec_id long, label string, codes array<int>, error long"
    rows = _prepared(vectors, vector)
    by_id = (F.col("vec_id").asc_nulls_last(), F.col("vector"))
    head = rows.orderBy(*by_id).select(F.size("vector").alias("n")).first()
    if head is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    dimension = head["n"]
    rows = rows.where(F.size("vector") == dimension)
    first = [r["vector"] for r in rows.orderBy(*by_id).limit(ENTRIES).collect()]
    blocks = materialise(pack_blocks(rows, dimension), "vector-blocks")
    books = train(blocks, _filled(_integers(np.array(first))), rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, kind, data, ids, labels in zip(*(c.to_pylist() for c in b.columns), strict=True):
                codes, errors = assign(_unpack(kind, data, n), books)
                total = [min(int(x), _MOST) for x in errors.sum(axis=0)]
                arrays = [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(codes.T.tolist(), pa.list_(pa.int32())), pa.array(total, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "codes", "error"])

    return blocks.mapInArrow(lean_batches(run), schema), books


def compress(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (of all rows with the same label, nulls being one) and codebooks_sha256 of every row that takes part."""
    coded, books = encode(vectors, vector, rounds)
    # a label gets a mark before it, so that none is equal to what stands for null
    key = F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit(""))
    coded = materialise(coded.withColumn("label", key), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    groups = coded.groupBy("label").agg(total.alias("label_error"), F.count("*").alias("rows"))
    joined = join_sized(coded, materialise(groups, "vector-labels"), "label", "rows")
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    return joined.select("vec_id", code.alias("code"), "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))
