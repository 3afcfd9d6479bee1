"""Product codes of vectors against plain Python."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalmill.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    """Rows (vec_id, vector, label) that take part, with Python's integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(order[0][1])
    pad = [0] * (-n % parts)
    order = [(i, [math.floor(4096 * x) for x in v] + pad, label) for i, v, label in order if len(v) == n]
    w = len(order[0][1]) // parts
    cut = [(i, [v[p * w : (p + 1) * w] for p in range(parts)], label) for i, v, label in order]
    books = [[cut[e][1][p] for e in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(books[p]))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v, _ in cut:
            for p in range(parts):
                groups[p, nearest(p, v[p])[1]].append(v[p])
        books = [[[sum(c) // len(groups[p, e]) for c in zip(*groups[p, e])] if groups[p, e] else y for e, y in enumerate(book)] for p, book in enumerate(books)]
    out, labels = [], defaultdict(int)
    for i, v, label in cut:
        best = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        labels[label] += out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for book in books for y in book for x in y).encode()).hexdigest()
    return [(i, code, min(error, 2**63 - 1), min(labels[label], 2**63 - 1), sha) for i, code, error, label in out]


def results(df):
    out = vector_codes.compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_against_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 17)
    rnd = random.Random(2)
    rows = [(3 * i - 40, [rnd.gauss(0, 1) for _ in range(16)], rnd.choice([0, 1, 1, 1, None])) for i in range(150)]
    rows += [(i + 1000, rows[7][1], 1) for i in range(30)]  # ties
    assert results(spark.createDataFrame(rows, SCHEMA).repartition(5)) == sorted(plain(rows), key=repr)


def test_floats_are_scaled_in_double(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=8)], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert results(df) == sorted(plain(rows), key=repr)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.25, -0.5, 1.0, -1e-9, 0.0, 2.0, 3.0, 4.0]
    rows = [(1, None, 0), (2, [], 0), (3, [nan] + v[1:], 0), (4, [None] + v[1:], 0), (5, [inf] + v[1:], 0), (6, v, None), (6, v, None), (7, v[::-1], 1), (8, v[:5], 1), (None, v, 1)]
    got = results(spark.createDataFrame(rows, SCHEMA))
    assert got == sorted(plain(rows), key=repr) and len(got) == 4
    assert results(spark.createDataFrame(rows[:5], SCHEMA)) == []
    assert results(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("dimension", [1, 5, 12])
def test_dimensions_that_parts_do_not_divide(spark, dimension):
    rnd = random.Random(dimension)
    rows = [(i, [rnd.uniform(-2, 2) for _ in range(dimension)], i % 3) for i in range(30)]
    assert results(spark.createDataFrame(rows, SCHEMA)) == sorted(plain(rows), key=repr)


def test_wide_components(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([1e3, 1e9, -1e12]) * rnd.random() for _ in range(8)], 0) for i in range(40)]
    assert results(spark.createDataFrame(rows, SCHEMA)) == sorted(plain(rows), key=repr)


def test_extra_columns_and_labels_as_strings(spark):
    rows = [(i, [float(i % 7), 1.0, 0.5, 0.0, -1.0, i / 9, 0.0, 1.0], ["", "=", None][i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for c in ("code", "error", "codes", "vector", "rows", "n", "kind", "label_error"):
        df = df.withColumn(c, F.lit("extra"))
    assert results(df) == sorted(plain(rows), key=repr)
