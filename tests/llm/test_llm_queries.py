"""The queries of the training-data operators and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _names():
    from signalmill.llm import queries

    return list(queries.queries())


@pytest.mark.parametrize("name", _names())
def test_query(spark, duck, name):
    from signalmill.llm import queries

    df = queries.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got
    if sql := queries.oracle_sql().get(name):
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(df.columns)
        order = [names.index(c) for c in df.columns]
        assert sorted(map(repr, got)) == sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    kept = out.count()
    assert 0 < kept < docs.count() and out.where("not same").count() == 0
    assert out.join(docs, "doc_id", "left_anti").count() == 0 and out.select("doc_id").distinct().count() == kept
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stage = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert stage.columns == docs.columns
    assert stage.join(labels.where("quality = 0"), "doc_id").count() == 0
