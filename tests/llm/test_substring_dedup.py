"""Removal of repeated passages against plain Python, with colliding hashes too."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalmill.llm import bytekernel, substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in enumerate(texts)], DOCS)


def plain(texts, window):
    """n_words, spans and kept text of each."""
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if counts[tuple(d[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        edges = [i for i in range(len(d) + 1) if (gone[i] if i < len(d) else False) != (gone[i - 1] if i else False)]
        out.append((len(d), list(zip(edges[::2], edges[1::2])), " ".join(w for w, g in zip(d, gone) if not g)))
    return out


def results(df, window, hash_bits=64):
    out = substring_dedup.remove_repeats(df, window, texts=True, hash_bits=hash_bits).collect()
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept_text"].encode()).hexdigest() for r in out)
    return {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["removed"]], r["kept_text"]) for r in out}


def passages(rnd, n, window):
    """Texts of own words and of shared passages of every length around the window, cut, joined, overlapping and repeated within a text."""
    own = (f"w{k}é" for k in range(10**9))
    shared = [[f"s{k}.{j}" for j in range(3 * window)] for k in range(6)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += [next(own) for _ in range(rnd.choice([0, 1, 3, window]))]
            s, i = rnd.choice(shared), rnd.randrange(window)
            words += s[i : i + rnd.choice([window - 1, window, window + 1, 2 * window])]
        out.append(rnd.choice([" ", "\n", " \t "]).join(words))
    return out


@pytest.mark.parametrize(("window", "seed"), [(8, 1), (12, 2), (35, 3)])
def test_shared_passages(spark, monkeypatch, window, seed):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 1500)
    texts = [*passages(random.Random(seed), 60, window), None, "", " \n", "one two", " ".join("ab" * window)]
    want = plain(texts, window)
    got = results(documents(spark, texts), window)
    assert [got[i] for i in range(len(texts))] == want
    assert any(spans for _, spans, _ in want) and any(not spans for n, spans, _ in want if n > window)


def test_few_words_branch_everywhere(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 400)
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 40))) for _ in range(60)] + ["a " * 50, "a " * 50, "a b " * 30]
    got = results(documents(spark, texts), 9)
    assert [got[i] for i in range(len(texts))] == plain(texts, 9)


@pytest.mark.parametrize("bits", [4, 9, 13])
def test_windows_that_only_hashes_make_equal_stay(spark, monkeypatch, bits):
    """Hashes of so few bits collide everywhere, and windows are told apart by their words."""
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 3000)
    texts = passages(random.Random(bits), 25, 10)
    docs, corpus = documents(spark, texts), substring_dedup.Corpus
    looked = []
    monkeypatch.setattr(corpus, "false_windows", lambda self, *a, f=corpus.false_windows: looked.append(1) or f(self, *a))
    got = results(docs, 10, bits)
    assert looked and [got[i] for i in range(len(texts))] == plain(texts, 10)


def test_copies_meet_as_few_paths(spark):
    """A group of copies is one path each, whatever their number and length."""
    texts = [" ".join(f"c{k}" for k in range(5000))] * 30 + [" ".join(f"d{i}.{k}" for k in range(100)) for i in range(20)]
    corpus = substring_dedup.Corpus(documents(spark, texts), 35, 64)
    walked = corpus.walked(corpus.repeated_edges(), False)
    paths = walked.where("path is not null").select("path.*").collect()
    assert len(paths) == 30 and {p["windows"] for p in paths} == {5000 - 34} and len({p["words"] for p in paths}) == 1
    seeds = corpus.repeated_seeds().select("seed").distinct().count()
    assert seeds < 5000 / 5  # about two in so many runs as a window holds


def test_seeds_are_equal_where_windows_are():
    x = np.random.default_rng(0).integers(0, 2**63, 300).astype(np.uint64)
    for n in (1, 2, 3, 7, 28):
        assert bytekernel.sliding(x, n, np.minimum).tolist() == [x[i : i + n].min() for i in range(len(x) - n + 1)]
    words = np.concatenate([x[:100], x[200:], x[:100]])
    hashes = bytekernel.run_hashes(words, 35)
    assert hashes[:66].tolist() == hashes[200:266].tolist() and len(set(hashes.tolist())) == len(hashes) - 66


def test_nulls_repeats_long_texts_and_extra_columns(spark):
    long = " ".join(f"x{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, "a b"), (None, long[: 5000]), (None, None), (5, " \n\t"), (6, " ".join("q" for _ in range(36)))]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for c in ("block", "digest", "edge", "words", "at", "part", "removed", "path", "doc", "size", "seed"):
        df = df.withColumn(c, F.lit("extra"))
    out = substring_dedup.removal_digest(substring_dedup.remove_repeats(df))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = plain([t for _, t in rows], 35)
    expected = [(i, n, sum(b - a for a, b in spans), hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, spans, kept) in zip(rows, want)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)
    assert substring_dedup.remove_repeats(df.where("doc_id > 99")).collect() == []
    assert substring_dedup.without_repeats(df.where("doc_id in (4, 6)")).orderBy("doc_id").collect()[0]["text"] == "a b"
