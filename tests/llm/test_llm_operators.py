"""The training-data operators against brute force, and their edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalmill.llm import ann_search, bytekernel, chat, exact_dedup, jaccard_join, lm_scoring, mixing, packing, piece_codec, rule_classifier, secret_scan, storage, token_counts
from signalmill.operators import components as joins
from signalmill.operators.components import smallest_labels

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "wörd " * 30_000 + "x" * 20_000


def documents(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "src0", 0) for i, t in enumerate(texts)], schema)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def odd(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, and extra columns with the operators' own names."""
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, LONG, "de", "src0", 1), (3, LONG, "de", "src0", 1), (4, "a b", None, "src9", 2), (None, "no id", "en", None, 3), (5, " \n\t", "fr", "src2", 4)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, names)
    for c in ("block", "size", "label", "domain", "tokens_", "copies", "signature", "token", "keep_id", "score", "statistic_x", "log_bytes", "part", "spans", "epochs"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# bytes

@given(st.lists(st.text(max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    buf, off = bytekernel.text_buffer(pa.array(texts, pa.string()))
    starts, ends, woff = bytekernel.word_spans(buf, off)
    got = [[buf[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(woff[:-1], woff[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    hashes, _ = bytekernel.word_hashes(buf, off)
    flat = [w for t in texts for w in words(t)]
    assert len(set(flat)) == len(set(hashes.tolist()))


@given(st.lists(st.integers(0, 2**64 - 1), max_size=20))
@settings(max_examples=40, deadline=None)
def test_packing_round_trip(values):
    x = np.array(values, dtype=np.uint64)
    assert packing.expand(packing.squeeze(x), len(x)).tolist() == values


# 1

def backoff(texts, order=3, alpha=0.4):
    counts, own, n_all = [Counter() for _ in range(order + 1)], [], 0
    docs = [words(t) for t in texts]
    for d in docs:
        mine = [Counter(tuple(d[i : i + n]) for i in range(len(d) - n + 1)) for n in range(order + 1)]
        own.append(mine)
        for n in range(1, order + 1):
            counts[n].update(mine[n])
        n_all += len(d)
    out = []
    for d, mine in zip(docs, own):
        total = 0
        for i in range(len(d)):
            most = min(i, order - 1)
            for n in range(most + 1, 0, -1):
                g = tuple(d[i - n + 1 : i + 1])
                c = counts[n][g] - mine[n][g]
                if c > 0:
                    below = counts[n - 1][g[:-1]] - mine[n - 1][g[:-1]] if n > 1 else n_all - len(d)
                    s = alpha ** (most + 1 - n) * (c / below)
                    break
            else:
                s = alpha ** (most + 1.0) / (n_all - len(d) + 1)
            total += round(math.log(s) * 1e6)
        out.append((len(d), total))
    return out


def test_backoff_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 60)  # many blocks and ranges
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("the of And x y z. q".split()) for _ in range(rnd.randint(0, 40))) for _ in range(40)] + ["the of and x"] * 3 + [None, ""]
    got = {r["doc_id"]: (r["n_words"], r["total_micro"]) for r in lm_scoring.score(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == backoff(texts)
    four = {r["doc_id"]: (r["n_words"], r["total_micro"]) for r in lm_scoring.score(documents(spark, texts), order=4).collect()}
    assert [four[i] for i in range(len(texts))] == backoff(texts, 4)
    plain = lm_scoring.score(documents(spark, ["a b a b"]), leave_one_out=False).first()
    assert plain["total_micro"] == sum(round(math.log(x) * 1e6) for x in (2 / 4, 2 / 2, 1 / 2, 1 / 1))


# 2

def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, label))]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard_join, "BLOCK_CHARACTERS", 2_000)
    monkeypatch.setattr(jaccard_join, "HOT_LEVEL", 3)  # salts
    monkeypatch.setattr(jaccard_join, "SALT_MEMBERS", 3)
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(3, 70))]
        base = base + passage if rnd.random() < 0.5 else base
        for _ in range(rnd.randint(1, 7)):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [None, "", " \n", "A b", "a B", "one two three four five", "one two three four five"]
    got = rows(jaccard_join.join_components(documents(spark, texts)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == components(texts)


def test_near_copies_are_dropped_by_row(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    kept = lambda data: rows(jaccard_join.keep_one_of_each(spark.createDataFrame(data, "doc_id long, text string, digest string, label string")), "doc_id", "text")
    x = ("same names", "as inside")
    assert kept([(5, a, *x), (5, a, *x), (5, b, *x)]) == sorted([(5, a), (5, b)])
    assert kept([(1, a, *x), (2, a, *x), (2, b, *x), (3, b + " z", *x)]) == sorted([(1, a), (2, b)])
    assert kept([(None, a, *x), (None, a, *x), (4, None, *x), (4, "", *x), (4, None, *x), (6, a, *x)]) == sorted([(None, a), (None, a), (4, None), (4, ""), (4, None), (6, a)], key=repr)
    # two texts of one doc_id in one component: one of them stays
    assert len(kept([(7, c, *x), (7, c + " z", *x), (8, c + " y", *x), (9, a, *x)])) == 2
    got = rows(jaccard_join.join_components(spark.createDataFrame([(1, a), (2, a), (2, b), (3, b + " z"), (0, b + " y")], "doc_id long, text string")))
    assert sorted(got) == [(0, 37, 0), (1, 36, 1), (2, 36, 0), (2, 36, 1), (3, 37, 0)]


def test_jaccard_components_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 2)
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(50)]
    texts = [" ".join([*base[:25], f"x{rnd.randint(0, 40)}", *base[25:]]) for _ in range(60)] + [" ".join(base)] * 40 + [f"own words of {i} are few" for i in range(30)] + [""] * 40
    assert sorted(rows(jaccard_join.join_components(documents(spark, texts)), "doc_id", "n_shingles", "component_id")) == components(texts)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)]
    got = dict(rows(smallest_labels(spark.createDataFrame(edges, "a long, b long")), "node", "label"))
    assert set(got[i] for i in range(61)) == {0} and got[101] == 100


# 3

def exact_neighbours(x, q, k):
    scores = np.zeros(len(x))
    for j in range(x.shape[1]):
        scores += x[:, j] * x[q, j]
    order = np.lexsort((np.arange(len(x)), -scores))
    return [(int(i), float(scores[i])) for i in order[order != q][:k]]


def recalls(found, x, queries, k):
    """Of each query, the share of its k nearest that were found, after a look at order and scores."""
    out = []
    for q in queries:
        exact = dict(exact_neighbours(x, q, len(x)))
        assert len(found[q]) == k and found[q] == sorted(found[q], key=lambda p: (-p[1], p[0]))
        assert all(abs(exact[v] - s) <= 1e-12 * max(1.0, abs(s)) for v, s in found[q])
        out.append(len({v for v, _ in found[q]} & {v for v, _ in exact_neighbours(x, q, k)}) / k)
    return out


def nearest_found(spark, data, k, kind="array<double>"):
    by = defaultdict(list)
    for r in sorted(ann_search.search(spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int", verifySchema=False), F.col("vec_id") % 20 == 0, k).collect(), key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(by[r["query_id"]])
    return by


def test_recall_of_shards_of_thousands(spark, monkeypatch):
    """Two shards of about 6,000 vectors on the sphere, the hardest case; nothing is scanned whole."""
    monkeypatch.setattr(ann_search, "SHARD_ROWS", 6_000)
    x = np.random.default_rng(3).standard_normal((12_000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = recalls(nearest_found(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)], 20), x, range(0, 12_000, 20), 20)
    print("recall: mean", np.mean(got), "least", min(got))
    assert np.mean(got) >= 0.95 and min(got) >= 0.3
    index = ann_search.ShardIndex(np.arange(6_000), x[:6_000], 1.0)
    index.search(np.arange(0, 6_000, 100), x[:6_000:100], 20)
    assert index.verified < 0.5 * 60 * 6_000
    near = x[:6_000:10][np.random.default_rng(4).integers(0, 600, 6_000)] + 0.02 * np.random.default_rng(5).standard_normal((6_000, 48))
    index = ann_search.ShardIndex(np.arange(6_000), near, float(np.linalg.norm(near, axis=1).max()))
    index.search(np.arange(0, 6_000, 100), near[::100], 5)
    assert index.verified < 0.1 * 60 * 6_000  # where vectors have near ones, few others are looked at


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 8)) * rng.uniform(0.5, 2, (900, 1))
    x[40] = x[80] = x[100]
    data = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [], 0), (904, [None] * 8, 0), (None, [1.0] * 8, 0), (920, [1.0, 2.0], None), (940, [2.0, 1.0], 0)]
    by = nearest_found(spark, data, 5)
    assert np.mean(recalls(by, x, range(0, 900, 20), 5)) >= 0.95
    assert [v for v, _ in by[920]] == [940] and not any(900 <= k < 905 for k in by)
    same = nearest_found(spark, [(20, [1.0, 0.0], 0)] * 3 + [(20, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0)], 5)
    assert same == {20: [(1, 1.0), (1, 1.0)]}
    assert ann_search.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


# 4

def test_pieces_are_those_of_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL)
    rnd = random.Random(4)
    alphabet = [" ", "  ", "e", "t", "the", "in", "\n", "\t", "é", "漢", "😀", "ing", "tion", "|", "\x00", "1", "==="]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200))) for _ in range(120)] + [None, "", " ", "a" * 2000, " " * 40, LONG]
    got = {r["doc_id"]: r for r in piece_codec.encode_documents(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == sp.encode(t or "") and got[i]["n_tokens"] == len(got[i]["ids"]) and got[i]["same"]
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert not piece_codec.encode_documents(documents(spark, ["a▁b"])).first()["same"]


def test_units_with_one_name(monkeypatch):
    codec = piece_codec.Codec(piece_codec.Vocabulary.read(piece_codec.MODEL))
    want = [x[2].tolist() for x in codec.encode(*codec.prepared(["the cat", "a dog"]))]
    monkeypatch.setattr(piece_codec.Codec, "_names", staticmethod(lambda buf, off, starts, ends: np.zeros(len(starts), np.uint64)))
    assert [x[2].tolist() for x in codec.encode(*codec.prepared(["the cat", "a dog"]))] == want


# 5

def test_budgets(spark):
    leaves = spark.createDataFrame([("a", "en", "s1", 100), ("a", "en", "s2", 10), ("a", "de", "s3", 50), ("b", "en", "s4", 1000)], "domain string, language string, origin string, tokens long")
    quota = {r["origin"]: r["quota"] for r in mixing.budgets(leaves, mixing.Mix(share=0.5, max_epochs=1, domains={"a": 50, "b": 50}, languages={"en": 50, "de": 50})).collect()}
    # 580 tokens: a can use 160 of its 290, so b gets 420; nothing is left over
    assert quota == {"s1": 100, "s2": 10, "s3": 50, "s4": 420}
    one = {r["origin"]: r["quota"] for r in mixing.budgets(leaves, mixing.Mix(share=0.1, max_epochs=1, domains={"a": 50, "b": 50}, languages={"en": 80, "de": 20})).collect()}
    # 58 for a: 46.4 for en, where s2's shortage (10 of 23.2) goes to its sibling s1 first
    assert one == {"s1": 36, "s2": 10, "s3": 11, "s4": 58}


def test_prefix_of_epochs(spark):
    rnd = random.Random(5)
    texts = ["w " * rnd.randint(0, 9) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, ("en", "de")[i % 2], f"src{i % 3}", 0) for i, t in enumerate(texts)], DOCS)
    mix = mixing.Mix(share=0.8, max_epochs=2, languages={"en": 90, "de": 10})
    got = {r["id"]: r["copies"] for r in mixing.select_mix(docs, F.lit("d"), mix).select(F.col("row.doc_id").alias("id"), "copies").collect()}
    plan = {(r["language"], r["origin"]): r for r in mixing.cuts(docs, F.lit("d"), mix).collect()}
    for (lang, src), p in plan.items():
        ids = [i for i in range(300) if ("en", "de")[i % 2] == lang and f"src{i % 3}" == src]
        size = {i: len(texts[i].split()) for i in ids}
        order = sorted(ids, key=lambda i: hashlib.md5(f"{mix.seed}:{p['epochs']}:{i}".encode()).hexdigest())
        want, used = {i: p["epochs"] for i in ids}, 0
        for i in order:
            used += size[i]
            if used > p["quota"] - p["epochs"] * p["tokens"]:
                break
            want[i] += 1
        assert {i: c for i, c in want.items() if c} == {i: got[i] for i in ids if i in got}
    assert mixing.taken_rows(docs, F.lit("d"), mix).count() == sum(got.values())


# 6

@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool"]), st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", " ", "\n", "a", "é"]), max_size=6).map("".join)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_grammar_round_trip(turns):
    assert chat.parse("".join(chat.render_turn(*t) for t in turns)) == turns


def test_conversations(spark):
    data = [(1, 1, "assistant", "</s>"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (3, None, "assistant", "a" * 50_000), (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\n</s>\n") and (got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, sha("</s>"))
    assert got[2]["n_turns"] == 2 and got[2]["turns_sha256"] == sha("\nx\n\nx\n") and got[2]["loss_sha256"] == sha("")
    assert got[3]["loss_chars"] == 50_000 and got[-7]["loss_chars"] == 21 and got[-7]["formatted_chars"] == 2 * (21 + 3) + 15 + 9
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_conversations_that_come_in_another_order(spark):
    data = [(c, t, ("user", "assistant")[t % 2], f"text {t}", "x", 1) for c in (1, 2, None) for t in range(6)]
    rendered = chat.format_turns(spark.createDataFrame(data, "conv_id long, turn long, role string, text string, seq string, formatted int"))
    want = rows(chat.read_back(rendered))
    assert len(want) == 3 and {r[1] for r in want} == {6}
    mixed = rendered.orderBy(F.col("seq").desc()).withColumn("extra", F.lit("x")).select("extra", "seq", "formatted", "conv_id", "loss_end", "loss_start")
    assert rows(chat.read_back(mixed, sort=True)) == want
    for wrong in (mixed, rendered.where("seq <> 2"), rendered.where("seq <> 0")):
        with pytest.raises(Exception, match="out of its place"):
            chat.read_back(wrong).collect()


# 7

def test_rules_learn_what_junk_is(spark):
    rnd = random.Random(7)
    texts, labels = [], []
    for i in range(800):
        good = rnd.random() < 0.8
        w = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 60))]
        texts.append(" ".join(w) + "." if good else " | ".join(x.upper() + "!!" for x in w))
        labels.append((i, int(good)))
    docs = documents(spark, texts)
    marked = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = rule_classifier.train(docs, marked, ~rule_classifier.held_out(F.col("doc_id")))
    assert 0 < len(model.rules) < 100
    got = {r["doc_id"]: r for r in rule_classifier.classify(docs, model).collect()}
    assert all(got[i]["predicted"] == y for i, y in labels) and all(0 <= r["score"] <= 1 for r in got.values())
    kept = rule_classifier.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(y for _, y in labels)
    nothing = rule_classifier.train(docs, marked.limit(0), F.lit(True))
    assert rule_classifier.classify(odd(spark), nothing).where("score = 0.5").count() == 7
    assert rule_classifier.keep_good(odd(spark), model).columns == odd(spark).columns


def plain_statistics(text):
    raw, n = text.encode(), max(1, len(text.encode()))
    w = words(text)
    lines = [tuple(words(x)) for x in text.split("\n") if words(x)]
    some = max(1, len(w))
    shares = [sum(b in chars for b in raw) / n for chars in rule_classifier._CLASSES.values()]
    spaces = sum(b in b" \t\n\x0b\x0c\r" for b in raw) - raw.count(b"\n")
    return [
        *shares, sum(b > 127 for b in raw) / n, spaces / n, math.log1p(len(raw)), math.log1p(len(w)), (len(raw) - spaces - raw.count(b"\n")) / some, len(set(w)) / some,
        sum(a == b for a, b in zip(w, w[1:])) / some, len(set(lines)) / max(1, len(lines)), len(w) / max(1, len(lines)),
    ]


@given(st.lists(st.lists(st.sampled_from(["a", "A", "b b", "7", ".", "!", "|", "#", '"', ",", "\n", "\n\n", " ", "\t", "é", "漢", "word word"]), max_size=30).map("".join), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_statistics_are_the_plain_ones(texts):
    got = rule_classifier.statistics(*bytekernel.text_buffer(pa.array(texts, pa.string())))
    assert np.allclose(got, [plain_statistics(t) for t in texts], rtol=1e-12, atol=1e-12)


def labelled(n=600, seed=9):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, len(rule_classifier.FEATURES)))
    margin = 2.0 * ((x[:, 0] > 0.3) & (x[:, 3] <= 0.5)) - 1.5 * (x[:, 7] > 0) + 0.3 * x[:, 9]
    return x, (rng.random(n) < 1 / (1 + np.exp(-margin))).astype(float)


def test_first_split_is_the_best_of_all():
    """The first tree of depth one, against every statistic and limit tried."""
    x, y = labelled()
    path = rule_classifier._paths(x, y, 1, 1)
    p = y.mean()
    gain = {}
    for f in range(x.shape[1]):
        for limit in np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 49))):
            sides = [x[:, f] <= limit, x[:, f] > limit]
            if min(s.sum() for s in sides) >= 5:
                gain[f, float(limit)] = sum((y - p)[s].sum() ** 2 / (p * (1 - p) * s.sum() + 1) for s in sides)
    f, limit = max(gain, key=gain.get)
    assert path == [(rule_classifier.Condition(rule_classifier.FEATURES[f], above, limit),) for above in (False, True)]


def test_lasso_weights_are_optimal():
    """At the optimum the loss's slope is the penalty where a rule has a weight, and no steeper where it has none."""
    x, y = labelled()
    penalty = 4e-3
    model = rule_classifier.fit(x, y, penalty=penalty, rounds=4000)
    weights = {p: w for w, p in model.rules}
    paths = rule_classifier._paths(x, y, 16, 3)
    holds = {p: np.array([all((row[rule_classifier.FEATURES.index(c.feature)] > c.limit) == c.above for c in p) for row in x]) for p in paths}
    score = 1 / (1 + np.exp(-(model.intercept + sum(w * holds[p] for p, w in weights.items()))))
    assert abs((y - score).mean()) < 1e-4 and 0 < len(weights) < len(paths)
    for p in paths:
        slope = float((holds[p] * (y - score)).mean())
        if p in weights:
            assert abs(slope - penalty * np.sign(weights[p])) < 2e-4
        else:
            assert abs(slope) < penalty + 2e-4


def test_scores_are_those_of_the_rules(spark):
    texts = ["Good words here. And more of them.", "BAD!! | BAD!! | BAD!!", "", None, "x " * 500, LONG]
    path = (rule_classifier.Condition("upper_share", True, 0.2), rule_classifier.Condition("bar_share", True, 0.0))
    model = rule_classifier.Model(0.5, ((-3.0, path), (1.25, (rule_classifier.Condition("same_next_word", True, 0.5),)), (0.5, (rule_classifier.Condition("log_bytes", False, 0.0),))))
    got = {r["doc_id"]: r for r in rule_classifier.classify(documents(spark, texts), model).collect()}
    for i, t in enumerate(texts):
        x = dict(zip(rule_classifier.FEATURES, plain_statistics(t or ""), strict=True))
        total = model.intercept + sum(w for w, p in model.rules if all((x[c.feature] > c.limit) == c.above for c in p))
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-total))) < 1e-12 and got[i]["predicted"] == int(got[i]["score"] >= 0.3)
    assert got[1]["predicted"] == 0


def test_labels_of_repeated_and_missing_doc_ids(spark):
    held = {r["d"]: r["h"] for r in spark.createDataFrame([(None,), (1,), (2,), (3,), (4,), (5,), (6,)], "d long").select("d", rule_classifier.held_out(F.col("d")).alias("h")).collect()}
    import zlib

    assert held == {None: False, **{i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(1, 7)}}
    docs = spark.createDataFrame([(i, t, "x") for i in range(40) for t in (("aaa bbb.", "ccc ") if i % 2 else ("AAA!", "B|"))], "doc_id long, text string, label string")
    marked = spark.createDataFrame([(i, i % 2, "y") for i in range(40)], "doc_id long, quality int, label string")
    one, two = (rule_classifier.train(d, marked, F.lit(True)) for d in (docs, docs.orderBy(F.col("text").desc()).repartition(3)))
    assert one == two and one.rules  # of rows that share a doc_id always the same one is fitted on
    same = rule_classifier.train(docs.withColumn("text", F.lit("same")), marked, F.lit(True))
    assert same.rules == () and abs(same.intercept) < 1e-9


# 8

def spans_of(text):
    out = []
    for r, rule in enumerate(secret_scan.RULES):
        out += [(m.start(), m.end(), r) for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.least]
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


@given(st.lists(st.lists(st.sampled_from(["password", "Token", "api_key", "APIKEY", ":", "=", " ", '"', "'", "abcdef", "AKIA", "ABCDEFGH1234", "0123456789abcdef", ".", "\n", "é", "-----BEGIN ", "PRIVATE KEY-----", "eyJabcdefghij", "ghp_" + "a" * 36, "xoxb-1234567890"]), max_size=25).map("".join), max_size=4))
@settings(max_examples=200, deadline=None)
def test_spans_are_those_of_the_patterns(texts):
    buf, off = bytekernel.text_buffer(pa.array(texts, pa.string()))
    assert secret_scan.find_spans(buf, off) == [(d, *s) for d, t in enumerate(texts) for s in spans_of(t)]


SECRET_PARTS = ["password", "Token", "api_key", ":", "=", " ", '"', "abcdef", "AKIA", "ABCDEFGH1234", "0123456789abcdef", ".", "\n", "é", "-----BEGIN ", "PRIVATE KEY-----", "eyJ", "eyJabcdefgh", "ghp_", "a" * 36, "xoxb-", "x", "0"]


@pytest.mark.parametrize("segment", [3, 7, 64])
def test_spans_over_cut_segments(monkeypatch, segment):
    """Stretches without a byte that resets the automaton are cut, and states are carried over the cuts."""
    monkeypatch.setattr(secret_scan, "SEGMENT_BYTES", 16)
    monkeypatch.setattr(secret_scan, "LONG_SEGMENT", segment)
    monkeypatch.setattr(secret_scan, "RUN_BYTES", 100)
    rnd = random.Random(segment)
    for _ in range(150):
        texts = ["".join(rnd.choice(SECRET_PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(1, 4))]
        buf, off = bytekernel.text_buffer(pa.array(texts, pa.string()))
        assert secret_scan.find_spans(buf, off) == [(d, *s) for d, t in enumerate(texts) for s in spans_of(t)]


def test_overlapping_begins_of_a_rule():
    rules = (secret_scan.Rule("a", "(?:ab|a)(?:c|bcd)?"), secret_scan.Rule("b", "aba"))
    buf, off = bytekernel.text_buffer(pa.array(["ababa aabcdab", "abababa", ""], pa.string()))
    assert secret_scan.find_spans(buf, off, rules) == [(0, 0, 2, 0), (0, 0, 3, 1), (0, 2, 4, 0), (0, 4, 5, 0), (0, 6, 7, 0), (0, 7, 11, 0), (0, 11, 13, 0), (1, 0, 2, 0), (1, 0, 3, 1), (1, 2, 4, 0), (1, 4, 6, 0), (1, 4, 7, 1), (1, 6, 7, 0)]
    with pytest.raises(ValueError):
        secret_scan.compile_rules((secret_scan.Rule("c", "a{3}"),))
    with pytest.raises(ValueError):
        secret_scan.compile_rules((secret_scan.Rule("c", "é"),))


def test_a_long_text_without_a_break():
    letters = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", dtype=np.uint8)
    raw = letters[np.random.default_rng(8).integers(0, 64, 3_000_000)]
    raw = np.r_[np.frombuffer(b"eyJhead", np.uint8), raw, np.frombuffer(b".eyJbody.", np.uint8), raw, np.frombuffer(b" ", np.uint8), np.full(3_000_000, ord("a"), np.uint8)]
    assert secret_scan.find_spans(raw, np.array([0, len(raw)])) == [(0, *s) for s in spans_of(raw.tobytes().decode())]


@pytest.mark.parametrize("which", [0, 1])
def test_automaton_is_minimal(which):
    a = secret_scan.compile_rules()[which]
    table = a.table.reshape(-1, a.columns) // a.columns
    rows_ = {(int(b), tuple(r)) for b, r in zip(a.accepts, table.tolist())}
    assert len(rows_) == len(a.accepts)
    if not which:
        assert a.resets[ord("\n")] and not a.resets[ord(" ")]


def test_scan_of_long_and_null_texts(spark):
    long = "x" * 300_000 + " password = hunter22 " + "deadbeef" * 4
    got = {r["doc_id"]: r for r in secret_scan.span_digest(secret_scan.scan(documents(spark, [None, "", long, "é token: abcdefg"]))).collect()}
    assert (got[2]["n_assign"], got[2]["n_hex"]) == (1, 1) and got[3]["spans"] == "assign:2:16" and got[0]["spans"] == ""


# 9

@given(st.lists(st.integers(1, 6), max_size=20), st.lists(st.integers(0, 80), max_size=4))
@settings(max_examples=150, deadline=None)
def test_tokens_are_allocated_by_the_rule(sizes, cuts):
    ends = np.cumsum(np.array(sizes, dtype=np.int64))
    size = int(ends[-1]) if len(ends) else 0
    borders = np.array([0, *sorted(c for c in cuts if c <= size), size])
    want, crossing = [0] * (len(borders) - 1), [0] * (len(borders) - 1)
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        held = [max(0, min(b, borders[k + 1]) - max(a, borders[k])) for k in range(len(borders) - 1)]
        k = held.index(max(held))
        want[k] += 1
        crossing[k] += sum(h > 0 for h in held) > 1
    got, x = token_counts.allocate(ends, borders)
    assert got.tolist() == want and x.tolist() == crossing


def test_tokens_of_sections_are_those_of_a_plain_count(spark):
    texts = ["Titel é\nbody\nbody 2\nend", "one line of words", None, "", "\n\n", "a\n" * 5, "漢字😀 título\n  spaces   \n\nthé end", "x" * 300 + "\n" + "y " * 50 + "\n" + "é" * 40, LONG]
    with open(token_counts.VOCABULARY, "rb") as f:
        encoder, _ = token_counts._encoder(f.read())
    want = []
    for i, t in enumerate(texts):
        t = t or ""
        sections, at = token_counts.title_body_closing(t), 0
        borders = [(len(t[:s].encode()), len(t[:e].encode())) for _, s, e in sections]
        count, crossing = [0] * 3, [0] * 3
        for token in encoder.encode_ordinary(t):
            end = at + len(encoder.decode_single_token_bytes(token))
            held = [max(0, min(end, b) - max(at, a)) for a, b in borders]
            k = max(range(3), key=lambda j: (held[j], -j))
            count[k] += 1
            crossing[k] += sum(h > 0 for h in held) > 1
            at = end
        want += [(i, name, s, e, count[k], crossing[k]) for k, (name, s, e) in enumerate(sections)]
    assert rows(token_counts.count_tokens(documents(spark, texts)), "doc_id", "section", "start", "end", "n_tokens", "n_crossing") == sorted(want, key=repr)


def test_sections_add_up(spark):
    texts = ["Titel é\nbody\nbody 2\nend", "one line", None, "", "\n\n", "a\n" * 5, LONG]
    got = defaultdict(int)
    for r in token_counts.count_tokens(documents(spark, texts)).collect():
        got[r["doc_id"]] += r["n_tokens"]
    with open(token_counts.VOCABULARY, "rb") as f:
        encoder, _ = token_counts._encoder(f.read())
    assert [got[i] for i in range(len(texts))] == [len(encoder.encode_ordinary(t or "")) for t in texts]
    assert [s[1:] for s in token_counts.title_body_closing("a\nb\nc")] == [(0, 2), (2, 4), (4, 5)]


# 10

def test_exact_groups(spark):
    rnd = random.Random(10)
    texts = [rnd.choice(["a b", "ab", "a\tb ", "abc", "", None, " \n", "c", "a b"]) if rnd.random() < 0.7 else f"own {i}" for i in range(200)]
    body = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    groups = defaultdict(list)
    for i, b in enumerate(body):
        groups[b].append(i)
    want = []
    for i, b in enumerate(body):
        keep = min(groups[b], key=lambda j: (-len(texts[j] or ""), j))
        want.append((i, keep, len(groups[b]), i == keep, hashlib.sha256(b.encode()).hexdigest()))
    got = rows(exact_dedup.dedup(documents(spark, texts)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(got) == want
    kept = rows(exact_dedup.keep_first_copies(documents(spark, texts)), "doc_id")
    assert sorted(kept) == [(i,) for i, _, _, k, _ in want if k]


def test_a_repeated_row_stays_once(spark):
    docs = spark.createDataFrame([(1, "x y", "en", "s", 0)] * 3 + [(2, "xy", "en", "s", 0)], DOCS)
    assert rows(exact_dedup.dedup(docs), "doc_id", "keep_id", "group_size", "kept").count((1, 1, 4, True)) == 1
    assert rows(exact_dedup.keep_first_copies(docs), "doc_id") == [(1,)]


def test_rows_that_share_a_doc_id_are_different_documents(spark):
    kept = lambda data: rows(exact_dedup.keep_first_copies(spark.createDataFrame(data, "doc_id long, text string, sha string, row string")), "doc_id", "text")
    x = ("same names", "as inside")
    assert kept([(5, "alpha", *x), (5, "alpha", *x), (5, "beta", *x)]) == [(5, "alpha"), (5, "beta")]
    assert kept([(1, "same text", *x), (2, "same text", *x), (2, "unique text of id two", *x)]) == [(1, "same text"), (2, "unique text of id two")]
    assert kept([(None, "a", *x), (None, "a", *x), (None, "b", *x), (3, "b", *x), (3, "b ", *x)]) == [(3, "b "), (None, "a")]
    assert kept([(None, None, *x), (None, "", *x), (7, " ", *x), (-(2**63), "c", *x), (2**63 - 1, "c", *x)]) == [(-(2**63), "c"), (7, " ")]
    # copies of a row whose other columns differ
    assert len(kept([(1, "a", "p", "q"), (1, "a", "r", "s"), (1, "a", None, None)])) == 1


def test_exact_groups_with_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 50)
    texts = ["hot copy"] * 300 + ["cold copy"] * 20 + [f"own {i}" for i in range(300)]
    got = rows(exact_dedup.dedup(documents(spark, texts)), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(((i, 0, 300, i == 0) if i < 300 else (i, 300, 20, i == 300) if i < 320 else (i, i, 1, True) for i in range(620)), key=repr)


@given(st.lists(st.lists(st.integers(0, 2**10 - 1), max_size=60), min_size=1, max_size=4), st.sampled_from([1, 10, 64]))
@settings(max_examples=80, deadline=None)
def test_filters_merge_without_loss(partitions, bits):
    """Fingerprints of few bits fill whole runs; those of 64 have remainders."""
    spread = (lambda v: v % 2) if bits == 1 else (lambda v: v) if bits == 10 else lambda v: v * 0x9E3779B97F4A7C15 % 2**64
    partitions = [[spread(v) for v in p] for p in partitions]
    sent = [exact_dedup.QuotientFilter(np.array(p, dtype=np.uint64), np.ones(len(p), np.int64), bits).pack() for p in partitions]
    fp, counts = exact_dedup.QuotientFilter.merged([exact_dedup.QuotientFilter.unpack(x) for x in sent]).entries()
    assert fp.tolist() == sorted(fp.tolist()) and dict(zip(fp.tolist(), counts.tolist())) == Counter(v for p in partitions for v in p)


def test_repeated_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_ENTRIES", 8)
    values = [i * 0x9E3779B97F4A7C15 % 2**64 - 2**63 for i in [*range(300), *range(100, 180), 7, 7]]
    named = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    for ranges in (1, 3, 8):
        assert rows(exact_dedup.repeated_fingerprints(named, ranges)) == sorted(((v,) for v, n in Counter(values).items() if n > 1), key=repr)


# all

OPERATORS = {
    "1": lm_scoring.score, "2": jaccard_join.join_components, "4": piece_codec.encode_documents, "5": lambda d: mixing.select_mix(d, F.lit(None).cast("string"), mixing.Mix()), "6": None,
    "7": lambda d: rule_classifier.with_statistics(rule_classifier._slim(d)), "8": secret_scan.scan, "9": token_counts.count_tokens, "10": exact_dedup.dedup,
}


@pytest.mark.parametrize("name", [n for n, f in OPERATORS.items() if f])
def test_empty_table_and_odd_rows(spark, name):
    """Columns of the operators' own names change nothing: the rows are those of the table without them."""
    assert OPERATORS[name](empty(spark)).count() == 0
    got, plain = OPERATORS[name](odd(spark)), OPERATORS[name](odd(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    columns = [c for c in plain.columns if c != "row"]
    assert rows(got, *columns) == rows(plain, *columns)
    if name != "5":
        assert got.count() == {"9": 21}.get(name, 7)
        return
    # 30,001 + 30,001 words in de/src0 and 2 + 2 elsewhere; 36,004 is the budget, of which the small leaves have all they can use
    taken = {(r["domain"], r["language"], r["origin"]): r["copies"] for r in got.where("tokens_ > 0").collect()}
    assert taken == {("unknown", "unknown", "src9"): 2, ("unknown", "en", "unknown"): 2}


def test_filters_keep_the_columns(spark):
    for f in (jaccard_join.keep_one_of_each, exact_dedup.keep_first_copies, lambda d: mixing.taken_rows(d, F.lit("x"), mixing.Mix(max_epochs=1))):
        assert f(odd(spark)).columns == odd(spark).columns and f(empty(spark)).count() == 0


def test_only_rows_with_a_repeated_fingerprint_are_grouped(spark):
    df = documents(spark, [f"text {i}" for i in range(300)] + ["a copy"] * 9 + [" text 7"])
    named = exact_dedup.materialise(exact_dedup.name_texts(df), "test-named")
    repeated = exact_dedup.materialise(exact_dedup.repeated_fingerprints(named, 4), "test-repeated")
    assert exact_dedup.only_with(named, repeated, "fp").count() == 11
    bitmap = storage._bitmap(repeated.select(storage._place(F.col("fp")).alias("place")))
    met = storage._with_bit(named.withColumn("place", storage._place(F.col("fp"))), bitmap)
    assert met.where("may_").count() == 11 and met.count() == 310  # before anything is exchanged
