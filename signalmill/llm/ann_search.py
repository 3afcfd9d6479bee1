"""Approximate nearest neighbours by collision counting.

Nearness is the largest inner product. With M the greatest length of a vector, every vector x becomes
(x, sqrt(M^2 - |x|^2)) / M and every query q becomes (q, 0) / |q|; then the nearest by distance on
the unit sphere are those with the largest inner product.

Vectors are dealt into shards. A shard's index is ``PROJECTIONS`` sorted arrays, each of the
shard's vectors along one random direction. A query opens a window around its own place in
every array and counts for each vector in how many windows it lies. Vectors whose count reaches ``THRESHOLD`` of the arrays
are verified by their inner product in double precision. Then the windows widen by ``WIDEN``
(virtual rehashing: the arrays stay, the windows' ends move along them, and only the vectors that they pass are counted anew), until
the k-th best verified is nearer by ``SLACK`` than the distance at which the share of collisions is expected to be the
threshold, or the windows hold the whole arrays. A first window that holds more than half of its arrays is counted by what
lies outside of it. The best of the shards are merged exactly. No shard is searched exhaustively by rule, however small;
the result is approximate at every size.

Queries go to the shards in blocks; every row is indexed. Vectors that are null, zero, of no
component, or with null or non-finite components take no part; vectors of different lengths are
never compared. Rows with the query's own vec_id are not its candidates; of a repeated query the least vector counts. Repeated rows are
candidates each. Ties go to the smaller vec_id. Scores are sums in the order of the components. An empty table gives no
rows. There are no texts here; vectors of any length do. Extra columns take no part.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
THRESHOLD = 0.9
WIDEN = 1.2
FIRST_WINDOW = 0.15
SLACK = 1.17
#: Steps below the end of the last search at which a search begins; a wider first window can only verify more.
STEPS_BACK = 2
#: Vectors of a shard on average.
SHARD_ROWS = 16_384
BLOCK_QUERIES = 2_048
SEED = 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, and their length."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


class ShardIndex:
    """Sorted arrays of projections of a shard's vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, longest: float):
        self.ids, self.x, self.longest, n = ids, x, longest, len(ids)
        unit = x / longest
        lift = np.sqrt(np.maximum(0.0, 1.0 - (unit**2).sum(axis=1)))
        self.directions = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, PROJECTIONS))
        at = (np.column_stack([unit, lift]) @ self.directions).T
        order = np.argsort(at, axis=1, kind="stable")
        self.reach = float(np.abs(at).max())
        # one after another, each array moved beyond the one before, so that one search finds the places in all of them
        self.step = 4 * max(self.reach, float(np.linalg.norm(self.directions, axis=0).max())) + 1
        self.arrays = (np.take_along_axis(at, order, axis=1) + self.step * np.arange(PROJECTIONS)[:, None]).ravel()
        self.rows = order.astype(np.int32).ravel()
        self.borders = np.arange(PROJECTIONS + 1) * n
        #: vectors verified in all searches
        self.verified = 0

    def _passed(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each vector stands in these slices of the arrays."""
        return np.bincount(np.concatenate([self.rows[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), minlength=len(self.ids))

    def _nearest(self, own: np.ndarray, query: np.ndarray, place: np.ndarray, k: int, width: float) -> tuple[np.ndarray, float]:
        """Rows that may be among the k nearest verified of one query, and the last window's width. ``own`` aren't candidates."""
        need, expected = int(np.ceil(THRESHOLD * PROJECTIONS)), NormalDist().inv_cdf((1 + THRESHOLD) / 2)
        length, whole = np.linalg.norm(query), self.reach + float(np.abs(place).max())
        at = place + self.step * np.arange(PROJECTIONS)
        done = own.copy()
        rows, scores = np.zeros(0, np.int64), np.zeros(0)
        low = high = counts = None
        while True:
            a, b = np.searchsorted(self.arrays, at - width, "left"), np.searchsorted(self.arrays, at + width, "right")
            a, b = np.maximum(a, self.borders[:-1]), np.minimum(b, self.borders[1:])
            if counts is not None:
                counts += self._passed(np.r_[a, high], np.r_[low, b])
            elif 2 * int((b - a).sum()) > len(self.rows):
                counts = PROJECTIONS - self._passed(np.r_[self.borders[:-1], b], np.r_[a, self.borders[1:]])
            else:
                counts = self._passed(a, b)
            low, high = a, b
            more = np.flatnonzero((counts >= need) & ~done)
            if len(more):
                done[more] = True
                rows, scores = np.r_[rows, more], np.r_[scores, self.x[more] @ query]
            kth = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else -np.inf
            distance = np.sqrt(max(0.0, 2 - 2 * kth / (self.longest * length)))
            enough = distance * SLACK * expected
            if enough <= width or width >= whole:
                break
            width = min(enough, width * WIDEN)
        self.verified += len(rows)
        return rows[scores >= kth - 1e-9 * max(1.0, abs(kth))] if np.isfinite(kth) else rows, width

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query position, row and score of the k nearest found of each query."""
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        places = np.column_stack([unit, np.zeros(len(unit))]) @ self.directions
        by = np.argsort(query_ids, kind="stable")
        found, width = [], FIRST_WINDOW
        for q in by.tolist():
            rows, last = self._nearest(self.ids == query_ids[q], queries[q], places[q], k, width)
            found.append(rows)
            width = max(FIRST_WINDOW, last / WIDEN**STEPS_BACK)
        q, rows = np.repeat(by, [len(r) for r in found]), np.concatenate([np.zeros(0, np.int64), *found])
        exact = np.zeros(len(rows))
        for j in range(self.x.shape[1]):
            exact += self.x[rows, j] * queries[q, j]
        best = np.lexsort((self.ids[rows], -exact, q))
        q, rows, exact = q[best], rows[best], exact[best]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        return q[rank < k], rows[rank < k], exact[rank < k]


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest found of every row for which ``is_query`` (over vec_id) holds."""
    rows = usable(vectors)
    size = rows.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()
    shards, blocks, longest = max(1, -(-size[0] // SHARD_ROWS)), max(1, -(-size[1] // BLOCK_QUERIES)), float(size[2] or 1.0)

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # every shard meets every block of queries: the smaller side of each is repeated
    data = rows.withColumn("dim", F.size("v")).withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn("block", numbers(blocks))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("shard", numbers(shards))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return t.column("vec_id").to_numpy(), flat.reshape(t.num_rows, -1)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            ids, x = matrix(left)
            query_ids, queries = matrix(right)
            for i in range(0, len(ids), 2 * SHARD_ROWS):  # a shard is larger only where whole rows repeat
                own = slice(i, i + 2 * SHARD_ROWS)
                q, r, s = ShardIndex(ids[own], x[own], longest).search(query_ids, queries, k)
                found.append((query_ids[q], ids[own][r], s))
        return pa.table({name: pa.array(np.concatenate(c)) for name, c in zip(("query_id", "vec_id", "score"), zip(*found, strict=True), strict=True)})

    keys = ("dim", "shard", "block")
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
