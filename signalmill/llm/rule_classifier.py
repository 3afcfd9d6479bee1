"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of whole texts: shares of byte classes, word and line shapes, repetition.
2. Small regression trees are grown one after another on the gradient of the logistic loss.
   Every path from a root to a node is a rule, a conjunction of comparisons of statistics.
3. Lasso logistic regression over the rules (0 or 1 each) leaves few with a weight.
4. The rules with a weight are compiled into one Spark column expression; scoring is that
   expression over the statistics.

The fit takes at most ``sample_rows`` labelled documents, chosen by hash of doc_id, and only those that
``train`` admits; labels are never read for scoring. Null and empty texts have zeros as statistics
and are scored like others, and so are repeated rows. Labels that are null are left out; a document that is labelled twice counts with its least label, and
of rows that share a doc_id the one with the least statistics is fitted on. Without labels of both kinds, or statistics that tell them apart, the score is the share of good ones (0.5 without labels).
A null doc_id isn't held out, and has no label. Ties between splits go to the first statistic and limit. An empty table gives no rows. A very long text
is measured whole, in memory in proportion to it. Extra columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytekernel as K
from .packing import lean_batches
from .storage import small_batches

#: The bound of the documents that the driver fits on: about 20,000 x 19 numbers.
SAMPLE_ROWS = 20_000

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".?", "comma": b",;:",
    "bang": b"!", "bar": b"|", "symbol": b"#$%&*@^~_=+<>\\{}[]/`", "quote": b"\"'()-", "line": b"\n",
}
FEATURES = (
    *(f"{k}_share" for k in _CLASSES), "high_share", "space_share", "log_bytes", "log_words", "word_bytes", "distinct_words", "same_next_word", "distinct_lines", "words_a_line",
)


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each document."""
    n, size = len(off) - 1, np.diff(off).astype(np.float64)
    least = np.maximum(size, 1)
    code = np.full(256, len(_CLASSES) + 2, dtype=np.int64)
    code[K.IS_SPACE] = len(_CLASSES) + 1
    code[128:] = len(_CLASSES)
    for k, chars in enumerate(_CLASSES.values()):
        code[list(chars)] = k
    width = len(_CLASSES) + 3
    doc = np.repeat(np.arange(n), np.diff(off))
    counts = np.bincount(doc * width + code[buf], minlength=n * width).reshape(n, width).astype(np.float64)
    words, woff = K.word_hashes(buf, off)
    n_words = np.diff(woff).astype(np.float64)
    same = np.zeros(n)
    if len(words) > 1:
        owner = np.repeat(np.arange(n), np.diff(woff))
        same = np.bincount(owner[1:], weights=(words[1:] == words[:-1]) & (owner[1:] == owner[:-1]), minlength=n)
    # lines by a hash of the words in them
    line_of = np.concatenate([[0], np.cumsum(buf == 10)]) if len(buf) else np.zeros(1, np.int64)
    starts = K.word_spans(buf, off)[0]
    distinct_words, distinct_lines, n_lines = np.zeros(n), np.zeros(n), np.zeros(n)
    for d in range(n):
        a, b = int(woff[d]), int(woff[d + 1])
        if a == b:
            continue
        w = words[a:b]
        distinct_words[d] = len(np.unique(w))
        lines = line_of[starts[a:b]]
        edge = np.flatnonzero(np.r_[True, lines[1:] != lines[:-1]])
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(w, edge)
        n_lines[d], distinct_lines[d] = len(edge), len(np.unique(sums))
    some = np.maximum(n_words, 1)
    columns = [counts[:, k] / least for k in range(len(_CLASSES) + 2)]
    columns += [np.log1p(size), np.log1p(n_words), (size - counts[:, -2] - counts[:, list(_CLASSES).index("line")]) / some, distinct_words / some, same / some, distinct_lines / np.maximum(n_lines, 1), n_words / np.maximum(n_lines, 1)]
    return np.column_stack(columns)


def _measured(column: pa.Array) -> list[pa.Array]:
    buf, off = K.text_buffer(column)
    parts = [statistics(buf[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in K.chunks(off)]
    x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
    return [pa.array(x[:, k]) for k in range(x.shape[1])]


def with_statistics(docs: DataFrame, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and FEATURES, whose names begin with ``prefix``."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *_measured(b.column(at))], names=[*names, *(prefix + f for f in FEATURES)])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + f, T.DoubleType()) for f in FEATURES)])
    return small_batches(docs).mapInArrow(lean_batches(run), schema)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  #: greater than the limit, else at most
    limit: float


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self, prefix: str = "") -> Column:
        """The score as a column expression over the statistics, whose columns' names begin with ``prefix``."""
        total = F.lit(self.intercept)
        for weight, conditions in self.rules:
            holds = F.lit(True)
            for c in conditions:
                holds = holds & ((F.col(prefix + c.feature) > c.limit) if c.above else (F.col(prefix + c.feature) <= c.limit))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: np.ndarray, edges: list[np.ndarray], residual: np.ndarray, curve: np.ndarray, rows: np.ndarray, depth: int, path: tuple[Condition, ...], out: list, step: np.ndarray, leaf_rows: int) -> None:
    """Split ``rows`` on the binned statistics ``x``; append each path to ``out``, write each leaf's value to ``step``."""
    if path:
        out.append(path)
    best = (1e-9, -1, -1)
    if depth:
        g, h = residual[rows], curve[rows]
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            bins = x[rows, f]
            left_g, left_h = (np.cumsum(np.bincount(bins, weights=v, minlength=len(cuts) + 1))[:-1] for v in (g, h))
            left_n = np.cumsum(np.bincount(bins, minlength=len(cuts) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - g.sum() ** 2 / (h.sum() + 1)
            gain[(left_n < leaf_rows) | (len(rows) - left_n < leaf_rows)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), f, k)
    _, f, k = best
    if f < 0:
        step[rows] = residual[rows].sum() / (curve[rows].sum() + 1)
        return
    left = x[rows, f] <= k
    for side, above in ((rows[left], False), (rows[~left], True)):
        _grow(x, edges, residual, curve, side, depth - 1, (*path, Condition(FEATURES[f], above, float(edges[f][k]))), out, step, leaf_rows)


def _paths(x: np.ndarray, y: np.ndarray, trees: int, depth: int) -> list[tuple[Condition, ...]]:
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 49))) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    edges = [e if len(e) else np.zeros(0) for e in edges]
    out: list[tuple[Condition, ...]] = []
    margin, step = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), np.zeros(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        _grow(binned, edges, y - p, p * (1 - p), np.arange(len(y)), depth, (), out, step, max(5, len(y) // 1000))
        margin += 0.3 * step
    return list(dict.fromkeys(out))


def _holds(x: np.ndarray, path: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in path:
        v = x[:, FEATURES.index(c.feature)]
        out &= (v > c.limit) if c.above else (v <= c.limit)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 16, depth: int = 3, penalty: float = 4e-4, rounds: int = 400) -> Model:
    """Rules of boosted trees with lasso logistic weights, by accelerated proximal gradient steps."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    paths = _paths(x, y, trees, depth) if len(y) and y.min() < y.max() else []
    if not paths:  # no labels of both kinds, or no statistic that tells them apart
        return Model(float(np.log(share / (1 - share))), ())
    r = np.column_stack([_holds(x, p) for p in paths]).astype(np.float32)
    kept = np.unique(r, axis=1, return_index=True)[1]  # rules that hold for the same rows count once
    paths, r = [paths[k] for k in sorted(kept)], r[:, sorted(kept)]
    center = r.mean(axis=0)
    r -= center
    v = np.ones(r.shape[1], dtype=np.float32)
    for _ in range(30):
        v = r.T @ (r @ v)
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 4 * len(y) / max(top, 1e-9)
    w, bias = np.zeros(r.shape[1], dtype=np.float32), float(np.log(y.mean() / (1 - y.mean())))
    z, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 0.5 * (1 + np.tanh((r @ z + bias) / 2))  # the logistic function, which can't overflow so
        bias += 4 * float((y - p).mean())
        nxt = z + rate * (r.T @ (y - p).astype(np.float32)) / len(y)
        nxt = np.sign(nxt) * np.maximum(np.abs(nxt) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = nxt + (t - 1) / t2 * (nxt - w), nxt, t2
    return Model(bias - float(center @ w), tuple((float(a), p) for a, p in zip(w, paths, strict=True) if a))


def train(docs: DataFrame, labels: DataFrame, admitted: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents for which ``admitted`` (over doc_id) holds."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")).where(admitted).dropna()
    marked = marked.groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = with_statistics(_slim(docs).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi"))
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(*FEATURES)).alias("x")).join(F.broadcast(sample), "doc_id")
    got = rows.select("doc_id", "x.*", "label").toPandas().sort_values("doc_id")
    return fit(got[list(FEATURES)].to_numpy(np.float64), got["label"].to_numpy(np.float64))


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept from the fit; not of one without doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 if score >= limit) of every row."""
    return with_statistics(_slim(docs)).select("doc_id", model.score().alias("score")).withColumn("predicted", (F.col("score") >= limit).cast("int"))


def keep_good(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with their own columns."""
    prefix = "statistic_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    return with_statistics(docs, prefix).where(model.score(prefix) >= limit).select(*docs.columns)
