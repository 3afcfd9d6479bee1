"""The pipeline's rows against a plain version of every stage."""

import hashlib
import os
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def good(model, text):
    from signalmill.llm import bytekernel, rule_classifier

    x = rule_classifier.statistics(*bytekernel.text_buffer(pa.array([text], pa.string())))
    total = model.intercept + sum(w for w, path in model.rules if rule_classifier._holds(x, path)[0])
    return 1 / (1 + np.exp(-total)) >= 0.3


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def fill(budget, children):
    """Shares of children (name: (capacity, weight)); those that are full leave, their shortage goes to the others."""
    share, open_ = {}, dict(children)
    while open_:
        left = budget - sum(share.values())
        level = left / sum(w for _, w in open_.values())
        full = [n for n, (c, w) in open_.items() if c <= w * level * (1 + 1e-12)]
        if not full:
            return share | {n: w * level for n, (_, w) in open_.items()}
        for n in full:
            share[n] = float(open_.pop(n)[0])
    return share


def mixed(docs, mix):
    tokens, by = {d: len(words(r["text"])) for d, r in docs.items()}, defaultdict(list)
    for d, r in docs.items():
        n = int(r["source"][3:])
        by["crawl" if n == 0 else "library" if n < 10 else "forum", r["lang"], r["source"]].append(d)
    size = {leaf: sum(tokens[d] for d in ids) for leaf, ids in by.items()}
    cap = lambda prefix: sum(s for leaf, s in size.items() if leaf[: len(prefix)] == prefix) * mix.max_epochs
    kept = set()
    domains = fill(int(sum(size.values()) * mix.share), {x: (cap((x,)), mix.domains[x]) for x in {leaf[0] for leaf in size}})
    for x, budget in domains.items():
        languages = fill(budget, {y: (cap((x, y)), mix.languages[y]) for y in {leaf[1] for leaf in size if leaf[0] == x}})
        for y, part in languages.items():
            for z, quota in fill(part, {z: (cap((x, y, z)), mix.default_weight) for a, b, z in size if (a, b) == (x, y)}).items():
                leaf, quota = (x, y, z), int(round(quota, 6))
                epochs = quota // size[leaf]
                rest = quota - epochs * size[leaf]
                if epochs:
                    kept |= set(by[leaf])
                for d in sorted(by[leaf], key=lambda d: hashlib.md5(f"{mix.seed}:{epochs}:{d}".encode()).hexdigest()):
                    rest -= tokens[d]
                    if rest < 0:
                        break
                    kept.add(d)
    return {d: docs[d] for d in docs if d in kept}


def test_pipeline_is_the_plain_one(spark):
    import sentencepiece

    import corpus_pipeline
    from signalmill.llm import piece_codec, rule_classifier

    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = rule_classifier.train(table, spark.read.parquet(f"{SF}/labels.parquet"), ~rule_classifier.held_out(F.col("doc_id")))
    docs = {r["doc_id"]: r for r in table.collect()}
    docs = {d: r for d, r in docs.items() if good(model, r["text"])}
    groups = defaultdict(list)
    for d, r in docs.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append(d)
    docs = {d: docs[d] for d in (min(g, key=lambda d: (-len(docs[d]["text"] or ""), d)) for g in groups.values())}
    sets, label = {d: shingles(r["text"]) for d, r in docs.items()}, {d: d for d in docs}
    for _ in range(4):
        for a in docs:
            for b in docs:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    docs = mixed({d: r for d, r in docs.items() if label[d] == d}, corpus_pipeline.MIX)
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL)
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {d: sp.encode(r["text"] or "") for d, r in docs.items()} and len(got) > 50


def written(df, path, name):
    df.write.parquet(f"{path}/{name}.parquet")


DOCS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int"


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    written(spark.createDataFrame([], DOCS), tmp_path, "documents")
    written(spark.createDataFrame([], LABELS), tmp_path, "labels")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, shared doc_ids and columns of the stages' own names; without labels all documents are good."""
    import corpus_pipeline

    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    data = [
        (1, None, None, None, None), (2, "", "en", "src1", 0), (3, "wörd " * 30_000, "de", "src0", 1), (3, "wörd " * 30_000, "de", "src0", 1), (None, "no id", "en", None, 3), (5, " \n\t", "fr", "odd", 4),
        (6, a, "en", "src0", 0), (6, b, "en", "src0", 0), (7, a + " ", "en", "src0", 0), (8, b + " z", "en", "src12", 0), (9, "own words", "es", "src3", 0),
    ]
    docs = spark.createDataFrame(data, DOCS).withColumn("digest", F.lit("x")).withColumn("row", F.lit(1)).withColumn("label", F.lit(None).cast("string")).withColumn("copies", F.array(F.lit(0)))
    written(docs, tmp_path, "documents")
    written(spark.createDataFrame([], LABELS), tmp_path, "labels")
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        ids = sorted((r["doc_id"] or 0, (r["text"] or "")[:3]) for r in kept.collect())
        if k == 1:  # of the empty ones the longest, of a's copies the longer, of the repeated row one
            assert ids == [(0, "no "), (3, "wör"), (5, " \n\t"), (6, "b0 "), (7, "a0 "), (8, "b0 "), (9, "own")]
        if k == 2:
            assert ids == [(0, "no "), (3, "wör"), (5, " \n\t"), (6, "b0 "), (7, "a0 "), (9, "own")]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in kept.collect()} and out.where("not same").count() == 0
