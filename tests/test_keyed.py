"""Keyed updates: what is written, what readers see, and what a crash leaves."""

import pytest
from pyspark.sql import functions as F

from signalmill.sources import keyed


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("a"), (F.col("id") * 2).alias("b"))
    keyed.create(rows, path, "k", 16)
    return path


def content(spark, path, version=None):
    return {r["k"]: (r["a"], r["b"]) for r in keyed.read(spark, path, version).collect()}


def files(tmp_path):
    return {p for p in (tmp_path / "t/data").rglob("*.parquet")}


def test_one_key_writes_one_bucket(spark, tmp_path, table):
    before = files(tmp_path)
    touched = keyed.update(spark.createDataFrame([(7, "new", None)], "k long, a string, b long"), table, ["a", "b"])
    new = files(tmp_path) - before
    assert len(touched) == 1 and {p.parent.name for p in new} == {f"bucket_={touched[0]}"} and before <= files(tmp_path)
    assert content(spark, table) == {k: ("new" if k == 7 else "old", 2 * k) for k in range(1000)}
    assert content(spark, table, 1) == {k: ("old", 2 * k) for k in range(1000)}


def test_crash_before_the_swap_changes_nothing(spark, table, monkeypatch):
    updates = spark.createDataFrame([(k, "new") for k in range(50)], "k long, a string")
    with monkeypatch.context() as m:
        m.setattr(keyed, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            keyed.update(updates, table, ["a"])
    assert keyed.versions(spark, table) == [1] and all(a == "old" for a, _ in content(spark, table).values())
    keyed.update(updates, table, ["a"])
    assert sum(a == "new" for a, _ in content(spark, table).values()) == 50 and len(content(spark, table)) == 1000


def test_the_second_of_two_writers_is_refused(spark, table):
    now = keyed.manifest(spark, table, 1)
    keyed.update(spark.createDataFrame([(1, "first")], "k long, a string"), table, ["a"])
    with pytest.raises(keyed.Conflict):
        keyed.commit(spark, table, 2, now)
    assert content(spark, table)[1] == ("first", 2)


def test_inserts_empty_updates_and_vacuum(spark, tmp_path, table):
    keyed.update(spark.createDataFrame([(5000, "x"), (3, "y"), (None, "z")], "k long, a string"), table, ["a"], insert=True)
    got = content(spark, table)
    assert got[5000] == ("x", None) and got[3] == ("y", 6) and len(got) == 1001 and keyed.versions(spark, table) == [1, 2]
    assert keyed.update(spark.createDataFrame([], "k long, a string"), table, ["a"]) == [] and keyed.versions(spark, table) == [1, 2]
    keyed.update(spark.createDataFrame([(4, "v")], "k long, a string"), table, ["a"])
    few = len(files(tmp_path))
    assert keyed.vacuum(spark, table, 1) and keyed.versions(spark, table) == [3] and len(files(tmp_path)) < few
    assert content(spark, table)[4] == ("v", 8) and len(content(spark, table)) == 1001
    with pytest.raises(ValueError):
        keyed.create(spark.createDataFrame([(None, "x")], "k long, a string"), str(tmp_path / "u"), "k")
