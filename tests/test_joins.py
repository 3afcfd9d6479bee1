"""Joins, marking and medians that are spread over many tasks, against plain Python, and what they leave out."""

import os
import random
import re
import statistics
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from signalmill import session
from signalmill.functions import html, text
from signalmill.operators import cells, dedup, links
from signalmill.queries import REGISTRY
from signalmill.sources import readers, writers
from signalmill.streaming import runs

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


# titles

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def near_titles(keys, threshold=88.0):
    keys = sorted(set(keys) - {""})
    out = []
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if 100.0 * 2 * min(len(a), len(b)) >= threshold * (len(a) + len(b)) and (score := 200.0 * lcs(a, b) / (len(a) + len(b))) >= threshold:
                out.append((a, b, score))
    return out


@tables
def test_fuzzy_title_pairs_are_all_pairs(spark):
    titles = spark.read.parquet(f"{SF}/documents.parquet").select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("t"))
    keys = [r[0] for r in titles.select(dedup.sorted_tokens(text.dedup_title(F.col("t")))).collect()]
    got = sorted(tuple(r[c] for c in ("a", "b", "score")) for r in REGISTRY["fuzzy_title_pairs"][0](spark, SF).collect())
    assert got == near_titles([k for k in keys if k is not None])


def test_title_pairs_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_ROWS", 7)
    rnd = random.Random(1)
    keys = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(1, 24))).strip() for _ in range(120)] + ["x" * 10 + c for c in "abcdefghijklmnopq"] + ["same key", "same key", ""]
    got = sorted(map(tuple, dedup.title_pairs(spark.createDataFrame([(k,) for k in keys], "key string")).select("a", "b", "score").collect()))
    assert got == near_titles(keys)
    assert dedup.title_pairs(spark.createDataFrame([("",)], "key string")).collect() == []


def test_only_lengths_that_may_be_near_meet():
    counts = [(n, 5000) for n in range(10, 400, 3)]
    blocks = dedup._length_blocks(counts, 0.88)
    met = sum(last - first + 1 for _, _, n, first, last in blocks for _ in range(n))
    many = sum(n for _, _, n, _, _ in blocks)
    assert met < 0.45 * many**2
    of = {length: (first, last) for length, _, _, first, last in blocks}
    start = {length: (block, block + n - 1) for length, block, n, _, _ in blocks}
    for a in (10, 100, 250):
        for b, _ in counts:
            if 2 * min(a, b) >= 0.88 * (a + b):
                assert of[a][0] <= start[b][1] and start[b][0] <= of[a][1]


def test_lcs_stops_only_below_its_bound():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 70))) for _ in range(2))
        full, least = dedup._lcs(a, b), rnd.randint(0, 70)
        assert full == lcs(a, b)
        assert (dedup._lcs(a, b, least) == full) if full >= least else dedup._lcs(a, b, least) <= full


def test_sequences_of_many_pairs_side_by_side():
    rnd = random.Random(4)
    for longest in (1, 30, 64, 65, 200):
        texts = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(1, longest))) for _ in range(40)]
        texts += [t[: len(t) // 2] + "x" + t[len(t) // 2 + 1 :] for t in texts]
        a, b = map(np.array, zip(*((i, j) for i in range(len(texts)) for j in range(i))))
        least = np.array([int(0.44 * (len(texts[i]) + len(texts[j]))) for i, j in zip(a, b)])
        for i, j, n, got in zip(a, b, least, dedup._lcs_lengths(texts, a, b, least)):
            full = lcs(texts[i], texts[j])
            assert got == full if full >= n else got < n


def test_titles_are_sifted_by_their_rare_characters(monkeypatch):
    """Titles of the same few syllables share most characters, but few of their pairs are followed as a whole; none that is near is lost."""
    rnd = random.Random(8)
    syllables = ["the", "an", "er", "on", "ing", "ti", "é", "wh", "sh", "ou", "ed", "or"]
    keys = [" ".join(sorted("".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(40))) for _ in range(90)]
    keys += [k[:100] + "x" + k[101:] for k in keys[:10]] + [k[9:] for k in keys[10:20]]
    whole = []
    monkeypatch.setattr(dedup, "_lcs_of_codes", lambda *x, f=dedup._lcs_of_codes: whole.append(len(x[2]) if len(x) == 6 else 0) or f(*x))
    near = sorted(near_titles(keys))
    assert sorted(dedup._near_titles(keys, keys, True, 88.0)) == near and len(near) >= 20
    assert sum(whole) < 3 * len(near) < sum(len(i) for i, _, _ in dedup._sharing(*2 * (sorted(keys, key=len),), True, 0.88)) / 10
    odd = ["a" * n for n in range(40, 80)] + ["ab" * 30 + c for c in "abcé\U0001f600"]
    for few in (0, 1000):
        monkeypatch.setattr(dedup, "SIFTED_CHARACTERS", 0)
        monkeypatch.setattr(dedup, "SIFTED_LENGTH", 0)
        monkeypatch.setattr(dedup, "LCS_FEW", few)
        for left, right in ((odd, odd), (keys[:30] + odd, keys[80:])):
            found = dedup._near_titles(left, right, left is right, 88.0)
            assert sorted(found) == sorted(p for p in near_titles(left + right) if left is right or (p[0] in left) != (p[1] in left))


def test_names_meet_all_texts_at_once(monkeypatch):
    """The ratios of a block of names and texts are those of one pair after the other; only windows that may be near are followed."""
    monkeypatch.setattr(links, "HAY_CHARACTERS", 300)
    rnd = random.Random(5)
    names = ["".join(rnd.choice("abcde é") for _ in range(rnd.randint(1, 18))) for _ in range(30)] + ["abca", "z" * 300]
    hays = ["".join(rnd.choice("abcde é") for _ in range(rnd.choice((0, 3, 10, 90)))) for _ in range(40)]
    hays += [names[3] + " b", "x" + names[4][1:], names[5][:-1], "z" * 280]
    for least in (60.0, 85.0):
        want = {(x, k): score for x, n in enumerate(names) for k, h in enumerate(hays) if (score := links.partial_ratio(n, h, least)) >= least}
        assert want and {(x, k): score for x, k, score in links._partial_ratios(names, hays, least)} == want
    monkeypatch.setattr(links, "partial_ratio", None)  # no pair is looked at alone where texts are the longer ones
    assert dict(((x, k), s) for x, k, s in links._partial_ratios(["near by"], ["it is nearby", "far off from it"], 85.0)).keys() == {(0, 0)}


def test_long_texts_meet_names_in_pieces(monkeypatch):
    """Each window of a text in pieces counts once, and none hangs over a piece's ends."""
    monkeypatch.setattr(links, "HAY_CHARACTERS", 40)
    rnd = random.Random(6)
    names = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 18))) for _ in range(25)] + ["abcab" * 12]
    hays = ["".join(rnd.choice("abcde ") for _ in range(n)) for n in (0, 5, 57, 58, 59, 99, 100, 101, 140, 300)]
    hays += ["e" * n + names[-1][1:] + "e" * k for n in range(30, 50, 3) for k in (0, 1, 90)]
    for least in (60.0, 85.0):
        want = {(x, k): score for x, n in enumerate(names) for k, h in enumerate(hays) if (score := links.partial_ratio(n, h)) >= least}
        got = list(links._partial_ratios(names, hays, least))
        assert {(x, k): score for x, k, score in got} == want and len(got) == len(want)


def test_facility_candidates_reads_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "north hall two and more")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["x " * 900 + "north hall twa", "north hall two", "x " * 900, "x " * 70_000 + "north hall two"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"]: r["confidence"] for r in REGISTRY["facility_candidates"][0](spark, str(tmp_path)).collect()}
    assert got == {0: round(26 / 28, 3), 1: 1.0, 3: 1.0}


# vectors

def clusters(n_clusters, size, dimensions=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_clusters, dimensions))
    return [(c * size + k, (centres[c] + 0.03 * rng.normal(size=dimensions)).tolist()) for c in range(n_clusters) for k in range(size)]


@pytest.mark.parametrize(("rows", "threshold"), [(clusters(12, 20), 0.95), (clusters(40, 4, 8, 1), 0.5), ([(i, v) for i, (_, v) in enumerate(clusters(90, 1, 6, 2))], 0.3)])
def test_cosine_pairs_by_pivots(spark, monkeypatch, rows, threshold):
    monkeypatch.setattr(dedup, "BLOCK_ROWS", 16)
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = x @ x.T
    want = {(min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])) for i, j in zip(*np.nonzero(c >= threshold)) if i != j}
    df = spark.createDataFrame([*rows, (10_000, [0.0] * len(rows[0][1]))], "id long, v array<double>")
    got = [(r["a"], r["b"]) for r in dedup.cosine_pairs(df, threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_clusters_of_vectors_meet_few_others(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_ROWS", 40)
    rows = clusters(20, 20)
    df = spark.createDataFrame(rows, "id long, v array<double>")
    meetings = dedup.cosine_meetings(df, 0.95)
    of_pairs = meetings.groupBy("cell", "i", "j").agg(F.sum(F.when(F.col("side") == 0, 1)).alias("n"), F.sum(F.col("side")).alias("m"))
    compared = sum(r["n"] * (r["m"] if r["i"] != r["j"] else r["n"]) for r in of_pairs.collect() if r["n"])
    assert compared < 0.25 * len(rows) ** 2  # all pairs are half of the square, and a block with itself counts whole
    assert dedup.cosine_pairs(df, 0.95).count() == 20 * 20 * 19 // 2
    assert dedup.cosine_pairs(df.where("id < 0"), 0.95).count() == 0
    with pytest.raises(ValueError):
        dedup.cosine_pairs(df, 0.0)


def test_pairs_of_vectors_leave_in_tiles(spark, monkeypatch):
    """Where all vectors are near, neither a batch's copies for its meetings nor a meeting's pairs are held at once."""
    monkeypatch.setattr(dedup, "BLOCK_ROWS", 64)
    monkeypatch.setattr(dedup, "TILE_ROWS", 8)
    monkeypatch.setattr(dedup, "DEALT_ROWS", 16)
    rng = np.random.default_rng(7)
    rows = [(i, (np.ones(8) + 0.2 * rng.normal(size=8)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>").coalesce(1)
    steps = []
    for kind, name in ((type(df), "mapInArrow"), (type(df.groupBy()), "applyInArrow")):
        monkeypatch.setattr(kind, name, lambda self, f, schema, do=getattr(kind, name): steps.append(f) or do(self, f, schema))
    assert dedup.cosine_pairs(df, 0.5).count() == 300 * 299 // 2
    deal, meet = steps[-2:]
    vectors = pa.array([v for _, v in rows], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), vectors, pa.array([True] * 300), pa.array(range(300), pa.int64())], names=["id", "v", "fresh", "draw"])
    dealt = list(deal(iter([batch])))
    assert sum(b.num_rows for b in dealt) > 300 and max(b.num_rows for b in dealt) <= 64
    met = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([i % 2 for i in range(300)], pa.int32())], names=["id", "v", "fresh", "side"])
    tiles = list(meet((pa.scalar(0), pa.scalar(0), pa.scalar(1)), iter([met])))
    assert sum(b.num_rows for b in tiles) == 150 * 150 and max(b.num_rows for b in tiles) <= 8 * 150


@tables
def test_pages_come_in_short_batches(spark):
    """A batch of pages is bounded by bytes, and pages are taken out of it one by one."""
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 30))
        assert REGISTRY["page_main_text"][0](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == session.PAGE_BYTES
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    long = "<article><p>" + "real words " * 30 + "</p></article>"
    out = list(html.page_text.func(iter([pa.array([long, None, "<p>short</p>"]), pa.array([], pa.string())])))
    assert [x.to_pylist() for x in out] == [[html.main_text(long), "", ""], []]


def test_archives_are_packed_in_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(("Planned", "Closed")[i % 2], f"n{i:02}", f"<Placemark><name>n{i:02}</name></Placemark>") for i in range(40)], "status string, name string, placemark string")
    writers.kmz_folder(rows, str(tmp_path / "a"), ("Closed", "Planned"), 7)
    names = []
    files = sorted((tmp_path / "a").glob("*.kmz"))
    for file in files:
        kml = zipfile.ZipFile(file).read("doc.kml").decode()
        assert kml.count("<Folder>") == kml.count("</Folder>") and kml.count("<Placemark>") <= 7
        names += re.findall("<Placemark><name>(.*?)</name>", kml)
    assert len(files) >= 6 and names == [f"n{i:02}" for i in (*range(1, 40, 2), *range(0, 40, 2))]


@pytest.mark.parametrize("held", [0, 10_000])
def test_only_pieces_that_begin_a_name_leave_a_task(spark, monkeypatch, held):
    monkeypatch.setattr(links, "BROADCAST_BYTES", held)
    names = spark.createDataFrame([("A", "f", "the acme"), ("B", "f", "the boreal hall"), ("C", "f", "éa"), ("D", "f", "")], "dc_id string, field string, name string")
    rows = spark.createDataFrame([(1, "at the acme and the acme"), (2, "the boreal hal"), (3, "xéa the boreal hall"), (4, ""), (5, "a")], "id long, hay string")
    found = links.contained(rows, names)
    assert sorted((r["id"], r["dc_id"]) for r in found.collect()) == [(1, "A"), (3, "B"), (3, "C")]
    assert ("Generate explode" in found._jdf.queryExecution().toString()) == (held == 0)


@pytest.mark.parametrize(("held", "few"), [(0, 300), (10_000, 300), (10_000, 0)])
def test_names_are_found_anywhere_in_a_text(spark, monkeypatch, held, few):
    monkeypatch.setattr(links, "BROADCAST_BYTES", held)
    monkeypatch.setattr(links, "FEW_HEADS", few)
    monkeypatch.setattr(links, "PIECE", 16)
    names = ["acme north hall", "acme north", "é1", "boreal", "a hall of twenty-five cha"]
    texts = ["." * n + name + "x" * k for name in names for n in (0, 15, 16, 17, 1499, 5000) for k in (0, 3, 40)] + ["acme nort", None, ""]
    table = spark.createDataFrame([(f"D{i}", "f", n) for i, n in enumerate(names)], "dc_id string, field string, name string")
    found = links.contained(spark.createDataFrame(list(enumerate(texts)), "id long, hay string"), table)
    want = [(i, f"D{k}", "f", n) for i, t in enumerate(texts) for k, n in enumerate(names) if n in (t or "")]
    assert sorted((r["id"], r["dc_id"], r["field"], r["name"]) for r in found.collect()) == sorted(want)


def test_candidates_contained_reads_whole_texts(spark, tmp_path):
    spark.createDataFrame([(1, "north hall two and more")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = ["x " * 900 + "north hall two", "north hall two", "x " * 900]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"] for r in REGISTRY["candidates_contained"][0](spark, str(tmp_path)).where("dc_id = 'DC-1001'").collect()}
    assert got == {1000, 1001} and "substr" not in REGISTRY["candidates_contained"][1]


def test_equal_vectors_are_one_key(spark, monkeypatch):
    """300 equal vectors would be 44,850 pairs."""
    met = []
    monkeypatch.setattr(dedup, "cosine_pairs", lambda v, t, f=dedup.cosine_pairs: met.append(v.count()) or f(v, t))
    rows = [(i, f"own{i} title{i * i}", [1.0, 2.0], False) for i in range(300)] + [(300, "far off", [-2.0, 1.0], False)]
    out = dedup.stacked(spark.createDataFrame(rows, "arrival long, title string, v array<double>, cached boolean"))
    assert {r["arrival"]: r["duplicate_of"] for r in out.collect()} == {i: 0 if 0 < i < 300 else None for i in range(301)} and met == [2]


def test_titles_of_the_stack_are_sifted(spark):
    """The join of titles below ``greedy_dedup`` looks at rare characters before whole titles."""
    rnd = random.Random(9)
    keys = [" ".join(sorted("".join(rnd.choices(["the", "an", "er", "ing"], k=3)) for _ in range(30))) for _ in range(60)]
    codes, letters = dedup._encoded(keys)
    counts = dedup._letter_counts(keys)
    a, b = (x.astype(np.int64) for x in np.triu_indices(len(keys), 1))
    least = np.ceil(0.44 * (np.array([len(keys[i]) + len(keys[j]) for i, j in zip(a, b)]))).astype(np.int64)
    live = set(dedup._sifted(dedup._sieve(codes, letters, counts), counts, a, b, least).tolist())
    near = {x for x, (i, j) in enumerate(zip(a, b)) if lcs(keys[i], keys[j]) >= least[x]}
    assert near <= live and len(live) < len(a) / 2


# greedy

def fold(n, edges):
    before = {}
    for a, b in edges:
        before.setdefault(b, []).append(a)
    kept, out = set(), {}
    for i in range(n):
        first = min((a for a in before.get(i, ()) if a in kept), default=None)
        if first is None:
            kept.add(i)
        out[i] = first
    return out


def marks(spark, n, edges):
    nodes = spark.range(n).select(F.col("id").alias("arrival"), F.lit(False).alias("cached"))
    return {r["arrival"]: r["duplicate_of"] for r in dedup.greedy(nodes, spark.createDataFrame(edges, "a long, b long")).collect()}


def test_chain_star_and_block_need_few_rounds(spark, monkeypatch):
    """None of them is left to a task of its own."""
    monkeypatch.setattr(dedup, "_followed", lambda *a: pytest.fail("a component was followed"))
    chain = [(i, i + 1) for i in range(10_000)]
    star = [(10_100, i) for i in range(10_101, 10_400)]
    block = [(i, j) for i in range(10_500, 10_560) for j in range(i + 1, 10_560)]
    tree = [(10_600 + (i - 1) // 2, 10_600 + i) for i in range(1, 300)]
    edges = chain + star + block + tree
    assert marks(spark, 11_000, edges) == fold(11_000, edges)


@pytest.mark.parametrize("followed", [0, 60])
def test_large_components_go_on_in_rounds(spark, monkeypatch, followed):
    monkeypatch.setattr(dedup, "FOLLOWED", followed)
    monkeypatch.setattr(dedup, "GREEDY_ROUNDS", 1)
    rnd = random.Random(followed)
    band = [(i, j) for i in range(24) for j in (i + 1, i + 2)]
    loose = [(min(e), max(e)) for e in (rnd.sample(range(40, 120), 2) for _ in range(130))]
    assert marks(spark, 120, band + loose) == fold(120, band + loose)


# medians

def test_medians_by_ranks(spark):
    rnd = random.Random(7)
    groups = {"distinct": [rnd.gauss(0, 1e6) for _ in range(3001)], "even": [rnd.random() for _ in range(1000)], "ties": [rnd.choice([1.0, 2.0, 2.0, 3.0]) for _ in range(500)], "one": [4.5], "two": [1.0, 4.0], "equal": [7.0] * 100, "near": [1 + k * 1e-15 for k in range(51)], "small": [-1e-9, 0.0, 1e-12, 5e-300]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    median = cells.medians(df, ["g"], "v", "m")
    assert {r["g"]: r["m"] for r in median.collect()} == {g: statistics.median(vs) for g, vs in groups.items()}
    plan = median._jdf.queryExecution().optimizedPlan().toString()
    assert "median(" not in plan and "percentile" not in plan


def test_medians_of_infinite_values(spark):
    inf = float("inf")
    rows = [("a", -inf), ("a", 2.0), ("a", inf), ("b", inf), ("b", inf), ("b", 1.0), ("c", -inf), ("c", -inf), ("c", 1e301), ("c", 2e301), ("c", 3e301), ("d", float("nan")), ("d", 1.0), ("d", 0.0)]
    got = {r["g"]: r["m"] for r in cells.medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m").collect()}
    assert got == {"a": 2.0, "b": inf, "c": 1e301, "d": 1.0}


# files

def test_each_file_is_read_in_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("ID,Name\n1,Zürich\n".encode())
    (tmp_path / "b.csv").write_bytes("ID,Name\n2,caf\xe9 €\n".encode("cp1252"))
    (tmp_path / "c.csv").write_bytes(b"ID,Name\n3,\x81\xe9\n")
    assert sorted(readers.encodings_of(spark, str(tmp_path))) == ["ISO-8859-1", "UTF-8", "windows-1252"]
    got = sorted((r["ID"], r["Name"]) for r in readers.read_delimited(spark, str(tmp_path)).collect())
    assert got == [("1", "Zürich"), ("2", "café €"), ("3", "\x81é")]


def test_a_snapshot_is_taken_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("x")
    archive = str(tmp_path / "archive")
    for stamp in ("20240101_000000", "20240102_000000", "20240102_000000"):
        writers.snapshot(spark, str(tmp_path / "in"), archive, stamp)
    got = spark.read.parquet(archive).groupBy("snapshot_ts").count().collect()
    assert sorted((str(r["snapshot_ts"]), r["count"]) for r in got) == [("20240101_000000", 1), ("20240102_000000", 1)]


# rolling

def stacked_fold(rows, days=14):
    """duplicate_of by arrival of batches of (arrival, title, v, day), each against kept rows of the last days."""
    kept, out = [], {}
    for batch in rows:
        now = max(r[3] for r in batch)
        old = [k for k in kept if k[3] >= now - days]
        mine = []
        for arrival, title, v, day in sorted(batch):
            first = None
            for other, name, w, _ in sorted(old + mine):
                titles = title and name and 200 * lcs(title, name) / (len(title) + len(name)) >= 88
                vectors = v and w and np.dot(v, w) >= 0.999999 * np.linalg.norm(v) * np.linalg.norm(w)
                if titles or vectors:
                    first = other
                    break
            if first is None:
                mine.append((arrival, title, v, day))
            out[arrival] = first
        kept += mine
    return out


def test_rolling_batches_are_the_sequential_fold(spark, tmp_path):
    rnd = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "opens", "site"]
    batches, arrival = [], 0
    for day in (1, 2, 20):
        batch = []
        for _ in range(25):
            arrival += 1
            title = " ".join(sorted(rnd.sample(words, 4))) + rnd.choice(["", "s"])
            batch.append((arrival, title, rnd.choice([None, [1.0, 0.0], [0.0, 1.0], [float(arrival), -1.0]]), day))
        batches.append(batch)
    want = stacked_fold(batches)
    path, got = str(tmp_path / "cache"), {}
    for k, batch in enumerate(batches):
        rows = spark.createDataFrame([(a, t, v, f"2024-03-{d:02d}") for a, t, v, d in batch], "arrival long, title string, v array<double>, published string")
        rows = rows.withColumn("published", F.col("published").cast("timestamp"))
        now = F.lit(f"2024-03-{max(r[3] for r in batch):02d}").cast("timestamp")
        for _ in range(2):  # run again, as after a crash
            marked = {r["arrival"]: r["duplicate_of"] for r in runs.roll(rows, path, k, now, cosine_threshold=0.999999).collect()}
        got |= marked
    assert got == want
    assert writers.listed(spark, path) == ["batch=2"]  # days 1 and 2 are out of the window


def broadcast_rows(spark, after=-1):
    """Rows of the largest broadcast of the executions after one, and the last execution's number."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, most, last = spark._jsparkSession.sharedState().statusStore(), 0, after
    runs_ = store.executionsList()
    for i in range(runs_.size()):
        number = runs_.apply(i).executionId()
        if number > after:
            last, values = max(last, number), store.executionMetrics(number)
            nodes = store.planGraph(number).allNodes()
            for node in (nodes.apply(k) for k in range(nodes.size())):
                if node.name() == "BroadcastExchange":
                    for metric in (node.metrics().apply(k) for k in range(node.metrics().size())):
                        if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                            most = max(most, int(values.apply(metric.accumulatorId()).replace(",", "")))
    return most, last


def test_batches_of_few_bytes_in_files_are_not_broadcast(spark, tmp_path):
    # a row takes 16 bytes and more, but few in a file: 100,000 are over the bound by the former only
    bound, before = "1m", spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    rows = spark.range(100_000).select(F.col("id").alias("arrival"), F.concat(F.lit("title "), F.md5((F.col("id") % 5).cast("string"))).alias("title"), F.lit(None).cast("array<double>").alias("v"), F.lit("2024-01-02").cast("timestamp").alias("published"))
    rows.write.parquet(str(tmp_path / "rows"))
    start = broadcast_rows(spark)[1]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        marked = runs.roll(spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "cache"), 0, F.lit("2024-01-02").cast("timestamp"))
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == bound
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert broadcast_rows(spark, start)[0] <= (1 << 20) // 16
    assert marked.where("duplicate_of <=> CASE WHEN arrival >= 5 THEN arrival % 5 END").count() == 100_000


def test_old_keys_are_not_compared_with_each_other(spark, monkeypatch):
    left, right = [f"title number {i}" for i in range(40)], [f"title numbers {i}" for i in range(40)]
    calls = []
    monkeypatch.setattr(dedup, "_lcs", lambda a, b, *rest, f=dedup._lcs: calls.append((a, b)) or f(a, b, *rest))
    fresh = {left[3], right[5]}
    pairs = dedup._near_titles(left, right, False, 88.0, fresh)
    assert all({a, b} & fresh for a, b in calls) and {(a, b) for a, b, _ in pairs} == {(a, b) for a, b, _ in near_titles(left + right) if {a, b} & fresh and (a in left) != (b in left)}
    inside = dedup._near_titles(left, left, True, 88.0, {left[3]})
    assert {(a, b) for a, b, _ in inside} == {(a, b) for a, b, _ in near_titles(left) if left[3] in (a, b)} and len(inside) == len(set(inside))
