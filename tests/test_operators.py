"""Order-dependent and edge cases against plain Python."""

import random
import time
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from signalmill import dims, session
from signalmill.functions import html, parse, rules, text
from signalmill.operators import cells, dedup, feed, links, models, plants
from signalmill.sources import readers, writers
from signalmill.streaming import runs


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_lcs_and_ratio():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc d") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        assert dedup._lcs(a, b) == lcs(a, b)
    assert round(dedup.ratio("new york mets", "new york meats"), 6) == 96.296296
    assert dedup.ratio("", "") == 100


def test_title_pairs_against_all_pairs(spark):
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(3, 30))).strip() or "x" for _ in range(25)]
    keys = set(base)
    for b in base * 3:
        s = list(b)
        for _ in range(rnd.randint(0, 3)):
            s[rnd.randrange(len(s))] = rnd.choice("abcde ")
        keys.add("".join(s))
    keys = sorted(keys)
    want = sorted((a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if 200 * lcs(a, b) / (len(a) + len(b)) >= 88)
    got = values(dedup.title_pairs(spark.createDataFrame([(k,) for k in keys], "key string")), "a", "b")
    assert got == sorted(want, key=repr) and want


def test_cosine_pairs(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [0.0, 5.0])]
    assert values(dedup.cosine_pairs(spark.createDataFrame(rows, "id long, v array<double>")), "a", "b") == [(1, 2), (3, 5)]


def test_greedy_is_the_sequential_fold(spark):
    rnd = random.Random(3)
    nodes, edges, want = [], [], []
    for graph in range(12):
        n, kept = 9, []
        mine = {(i, j) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.3}
        for j in range(n):
            nodes.append((graph * 100 + j, j == 0))
            first = next((i for i in kept if (i, j) in mine), None)
            if first is None or j == 0:
                kept.append(j)
            want.append((graph * 100 + j, first is not None, None if first is None else graph * 100 + first))
        edges += [(graph * 100 + i, graph * 100 + j) for i, j in mine]
    got = dedup.greedy(spark.createDataFrame(nodes, "arrival long, cached boolean"), spark.createDataFrame(edges, "a long, b long"))
    assert values(got, "arrival", "is_duplicate", "duplicate_of") == sorted(want, key=repr)


def stacked_fold(rows):
    """(arrival, is_duplicate, duplicate_of) of rows (arrival, sorted title, v, cached), one after another."""
    kept, out = [], []
    for arrival, title, v, cached in sorted(rows):
        first = None
        for other, name, w, _ in kept:
            titles = title and name and 200 * lcs(title, name) / (len(title) + len(name)) >= 88
            vectors = v and w and sum(x * y for x, y in zip(v, w, strict=True)) >= 0.85 * (sum(x * x for x in v) * sum(x * x for x in w)) ** 0.5
            if titles or vectors:
                first = other
                break
        if cached or first is None:
            kept.append((arrival, title, v, cached))
            first = None
        out.append((arrival, first is not None, first))
    return sorted(out, key=repr)


def stacked_rows(spark, rows):
    return values(dedup.stacked(spark.createDataFrame(rows, "arrival long, title string, v array<double>, cached boolean")), "arrival", "is_duplicate", "duplicate_of")


def test_stacked_keeps_one_of_a_title_whose_first_row_is_a_vector_duplicate(spark):
    rows = [(0, "alpha", [1.0, 0.0, 0.0], False), (1, "same title", [1.0, 0.1, 0.0], False), (2, "same title", [0.0, 1.0, 0.0], False), (3, "same title", [0.0, 0.0, 1.0], False)]
    want = [(0, False, None), (1, True, 0), (2, False, None), (3, True, 2)]
    assert stacked_fold(rows) == want
    assert stacked_rows(spark, rows) == want


def test_stacked_is_the_sequential_fold(spark):
    rnd = random.Random(7)
    base = [" ".join(sorted("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(4))) for _ in range(12)]
    titles = base + [t[:-1] + "z" for t in base] + ["y" + t[1:-1] + "z" for t in base] + [""]
    titles = [" ".join(sorted(t.split())) for t in titles]
    rows = []
    for i in range(240):
        v = [rnd.gauss(0, 1) for _ in range(4)] if rnd.random() < 0.8 else None
        rows.append((i, rnd.choice(titles), v, i < 12))
    want = stacked_fold(rows)
    assert sum(d for _, d, _ in want) > 20 and sum(not d for _, d, _ in want) > 20
    assert stacked_rows(spark, rows) == want


def test_percentile_ties_nulls_and_single(spark):
    rows = [("a", i, float(v)) for i, v in enumerate((0, 0, 0, 5, 7, 7))] + [("a", 9, None), ("b", 0, 3.0)]
    got = cells.percentile(spark.createDataFrame(rows, "g string, k int, v double"), ["g"], ["k"], {"v": "p"})
    assert [round(p, 9) if p is not None else None for _, _, p in values(got, "g", "k", "p")] == [0.2, 0.2, 0.2, 0.6, 0.9, 0.9, None, 0.5]


def test_combined_cells_keep_nulls_on_one_side(spark):
    dc = spark.createDataFrame([(3, "a", 1.0, 0.0, 1.0)], "resolution int, cell string, dc_operational_mw double, dc_pipeline_mw double, dc_total_mw double")
    pp = spark.createDataFrame([(3, "b", 0.0, 2.0, 2.0)], "resolution int, cell string, pp_operational_mw double, pp_planned_mw double, pp_total_mw double")
    assert values(cells.combined_cells(dc, pp), "cell", "dc_total_mw", "pp_total_mw") == [("a", 1.0, 0.0), ("b", None, 2.0)]


def test_plants(spark):
    rows = [(1, "P", "N1", "VA", "c", 2.0, 0.0, 5.0, "OP", "Wind"), (2, "P", "N2", "TX", "d", 2.0, 7.0, 0.0, "SB", "Solar"), (3, None, "x", "x", "x", 1.0, 1.0, 1.0, "x", "x")]
    g = spark.createDataFrame(rows, "row_idx int, plant_id string, plant_name string, state string, county string, mw double, lat double, lon double, status string, tech_group string")
    assert values(plants.plant_rollup(g), "plant_name", "nameplate_mw", "lat", "lon", "eia_statuses") == [("N1", 4.0, 7.0, 5.0, "OP, SB")]
    assert values(plants.dominant_tech(g), "tech_group") == [("Solar",)]


def test_words_are_matched_whole(spark):
    row = spark.createDataFrame([("the laws on output", "aws region opens; TPU")], "a string, b string")
    scores = row.select(F.aggregate(rules.category_scores(F.lower("a")), F.lit(0), lambda x, y: x + y["score"]).alias("a"), F.aggregate(rules.category_scores(F.lower("b")), F.lit(0), lambda x, y: x + y["score"]).alias("b")).first()
    assert scores["a"] == 0 and scores["b"] == 4
    assert row.select(rules.categories(rules.category_scores(F.lower("a"))).alias("c")).first()["c"]["confidence"] == pytest.approx(0.1)


def test_states(spark):
    row = spark.createDataFrame([("West Virginia and IN",), (None,)], "s string").select(text.states(F.col("s")).alias("x")).collect()
    assert [r["x"] for r in row] == [["IN", "VA", "WV"], []]
    assert spark.sql("SELECT 'Phoenix' AS s").select(text.states(F.col("s"), cities=True)).first()[0] == ["AZ"]


def plain_greedy(nodes, edges, meets):
    """Arrival order, article by article; ``nodes``: arrival, cached, key."""
    near = {k: {k} for _, _, k in nodes if k}
    for x, y in meets:
        near.setdefault(x, {x}).add(y)
        near.setdefault(y, {y}).add(x)
    pairs, kept, out = {(min(e), max(e)) for e in edges}, [], {}
    key = {a: k for a, _, k in nodes}
    for a, cached, k in sorted(nodes):
        of = None if cached else next((b for b in kept if (b, a) in pairs or (k and key[b] and key[b] in near[k])), None)
        out[a] = of
        if of is None:
            kept = sorted([*kept, a])
    return out


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_greedy_follows_what_rounds_leave(spark, monkeypatch, rounds):
    monkeypatch.setattr(dedup, "GREEDY_ROUNDS", rounds)
    rnd = random.Random(rounds)
    nodes = [(i, rnd.random() < 0.1, rnd.choice([None, "", *(f"k{j}" for j in range(25))])) for i in range(120)]
    edges = [(min(e), max(e)) for e in (rnd.sample(range(120), 2) for _ in range(90))]
    meets = [(f"k{i}", f"k{i + 1}") for i in range(0, 25, 2)]
    marked = dedup.greedy(spark.createDataFrame(nodes, "arrival long, cached boolean, key string"), spark.createDataFrame(edges, "a long, b long"), near=spark.createDataFrame(meets, "a string, b string"))
    assert {r["arrival"]: r["duplicate_of"] for r in marked.collect()} == plain_greedy(nodes, edges, meets)


def test_greedy_of_a_long_chain_and_a_star(spark):
    nodes = spark.range(2000).select(F.col("id").alias("arrival"), F.lit(False).alias("cached"))
    chain, star = [(i, i + 1) for i in range(1000)], [(1500, i) for i in range(1501, 2000)]
    got = {r["arrival"]: r["duplicate_of"] for r in dedup.greedy(nodes, spark.createDataFrame([*chain, *star], "a long, b long")).collect()}
    assert all(got[i] == (i - 1 if i % 2 else None) for i in range(1001))
    assert all(got[i] == 1500 for i in range(1501, 2000)) and got[1500] is None and got[1200] is None


def test_partial_ratio():
    rnd = random.Random(4)
    for _ in range(150):
        needle, hay = ("".join(rnd.choice("abcd ") for _ in range(n)) for n in (rnd.randint(1, 9), rnd.randint(10, 40)))
        full = links.partial_ratio(needle, hay)
        assert links.partial_ratio(needle, hay, 70.0) == (full if full >= 70 else 0)
    assert links.partial_ratio("acme", "the acme site") == 100 and links.partial_ratio("", "x") == 0


@pytest.mark.parametrize("broadcast", [0, 10_000])
def test_candidates_keep_three(spark, monkeypatch, broadcast):
    monkeypatch.setattr(links, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(links, "NAME_BLOCK", 2)
    names = spark.createDataFrame([(f"DC-{i}", "canonical_name", f"Site {i} North") for i in range(6)], "dc_id string, field string, name string")
    rows = spark.createDataFrame([(1, "Site 1 North and Site 2 North"), (2, "nothing")], "id long, hay string")
    got = values(links.candidates(rows, names, 80.0), "id", "dc_id", "confidence", "rank")
    assert [g[:2] for g in got] == [(1, "DC-0"), (1, "DC-1"), (1, "DC-2")] and got[1][2] == 1.0


def test_main_text():
    page = "<body><nav>" + "menu " * 60 + "</nav><div class='ad x'>" + "buy " * 80 + "</div><article><p>" + "real words " * 30 + "</p></article></body>"
    assert html.main_text(page).startswith("real words") and "menu" not in html.main_text(page) and "buy" not in html.main_text(page)
    assert html.main_text("<p>short</p>") == "" and html.main_text(None) == ""
    assert html.main_text("<body>" + "plain text " * 40) != ""


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿ID ,Name\n1,\"x\ny\"\n2,\n".encode())
    (tmp_path / "b.csv").write_bytes("ID,Name\n1,caf\xe9 \u20ac\n".encode("cp1252"))
    assert values(readers.read_delimited(spark, str(tmp_path / "a.csv")), "ID", "Name") == [("1", "x\ny"), ("2", "")]
    assert values(readers.read_delimited(spark, str(tmp_path / "b.csv")), "Name") == [("café €",)]
    assert readers.read_or_empty(spark, str(tmp_path / "none.csv"), readers.strings(["a"])).count() == 0
    (tmp_path / "feeds.txt").write_text("# no\n\nhttp://x\n")
    assert values(readers.read_lines(spark, str(tmp_path / "feeds.txt")), "line") == [("http://x",)]
    (tmp_path / "m.json").write_text('{"u": {"date": "2024"}}')
    assert values(readers.read_map(spark, str(tmp_path / "m.json"), "struct<date: string>"), "key") == [("u",)]
    (tmp_path / "bad.json").write_text("{")
    assert readers.read_map(spark, str(tmp_path / "bad.json"), "string").count() == 0
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>http://l</link><pubDate>Mon, 26 Jan 2026 19:08:00 +0000</pubDate></item></channel></rss>")
    assert values(readers.read_feed(spark, str(tmp_path / "f.xml")), "title", "link") == [("T", "http://l")]


def _workbook(path):
    cells = "".join(f"<row>{''.join(f'<c r=\"{chr(65 + i)}{n}\" t=\"inlineStr\"><is><t>{v}</t></is></c>' for i, v in enumerate(r) if v)}</row>" for n, r in enumerate([["junk"], ["", ""], [" Plant ID ", "State"], ["7", "VA"], ["", ""], ["8", ""]], 1))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Operating" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>')


def test_workbook(spark, tmp_path):
    _workbook(tmp_path / "w.xlsx")
    assert values(readers.read_workbook(spark, str(tmp_path / "w.xlsx"), "Operating", ["Plant ID", "State"]), "Plant ID", "State") == [("7", "VA"), ("8", None)]
    ordered = readers.read_workbook(spark, str(tmp_path / "w.xlsx"), "Operating", ["Plant ID"], order=True).orderBy(readers.ORDER)
    assert [(r["Plant ID"], r["row_idx"]["row"]) for r in ordered.collect()] == [("7", 0), ("8", 1)]
    with pytest.raises(ValueError):
        readers.table_of([["a"]], "Plant ID")


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "id long, v string, extra int")
    for _ in range(2):
        writers.append_new(rows, str(tmp_path / "t"), "id", ["id", "v"])
    there = spark.read.parquet(str(tmp_path / "t"))
    assert values(there, "id", "v") == [(1, "a"), (2, "b")]
    assert values(writers.updated(there, spark.createDataFrame([(2, "z")], "id long, v string"), "id", ["v"]), "id", "v") == [(1, "a"), (2, "z")]
    assert "</script><script>" not in writers.page("t", {"X": spark.sql("SELECT '</script><script>' AS a")})
    marks = writers.placemarks(spark.createDataFrame([("Planned", "P & Q", "Miner", 2.0, 0.0, 1.0, 2.0), ("Operational", "O", "Miner", 0.0, 5.0, 1.0, 2.0)], "status string, name string, company_type string, mw double, sqft double, lat double, lon double"), {"Planned": "#FEB24C"})
    (tmp_path / "x.kmz").write_bytes(writers.kmz(marks, dims.STATUSES))
    kml = zipfile.ZipFile(tmp_path / "x.kmz").read("doc.kml").decode()
    assert kml.index("Operational") < kml.index("P &amp; Q") and "ff4cb2fe" in kml.lower()


def deliver(spark, where, *rows):
    schema = spark.createDataFrame([], "raw_url string, title string").schema
    if rows:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(where[0])
    return lambda **options: runs.ingest(spark, where[0], schema, *where[1:], **options)


@pytest.mark.parametrize("lost", ["nothing", "commit", "commit and sink"])
def test_ingest_appends_once_whatever_is_run_again(spark, tmp_path, lost):
    where = [str(tmp_path / x) for x in ("in", "out", "check")]
    deliver(spark, where, ("u1", "a"), ("u1", "b"), ("u2", "c"), ("http://youtu.be/x", "d"), ("", "e"), (None, "f"))()
    deliver(spark, where, ("u2", "again"), ("u3", "new"), ("u3", "newer"))()
    if lost != "nothing":
        newest = max(int(p.name) for p in (tmp_path / "check/commits").iterdir() if p.name.isdigit())
        runs.forget_commit(spark, where[2])
        assert not (tmp_path / f"check/commits/{newest}").exists()
        if lost == "commit and sink":
            (tmp_path / f"out/_spark_metadata/{newest}").unlink()
            (tmp_path / f"out/_spark_metadata/.{newest}.crc").unlink(missing_ok=True)
    deliver(spark, where)()
    deliver(spark, where, ("u1", "late"), ("u4", "last"))()
    assert values(spark.read.parquet(where[1]), "raw_url", "title") == [("u1", "a"), ("u2", "c"), ("u3", "new"), ("u4", "last")]
    assert values(runs.seen(spark, where[2]), "raw_url") == [("u1",), ("u2",), ("u3",), ("u4",)]


def test_seen_urls_expire(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("in", "out", "check")]
    day = 1 / 86_400  # a second
    deliver(spark, where, *[(f"u{k}", "x") for k in range(20)])(days=day, against_sink=False)
    time.sleep(1.5)
    deliver(spark, where, ("u1", "in the batch that drops it"), ("v", "y"))(days=day, against_sink=False)
    assert values(runs.seen(spark, where[2]), "raw_url") == [("v",)]
    deliver(spark, where, ("u1", "again"), ("u2", "again"))(days=day, against_sink=False)
    titles = values(spark.read.parquet(where[1]).where("title <> 'x'"), "raw_url", "title")
    assert titles == [("u1", "again"), ("u2", "again"), ("v", "y")]


def test_slices():
    def fail():
        raise RuntimeError("x")

    stages = {"a": lambda: None, "b": fail, "c": lambda: None}
    assert runs.slices(stages) == {"a": "done", "b": "failed: x", "c": "not run"}
    assert runs.slices(stages, ["b", "c"], stop_at_failure=False) == {"a": "skipped", "b": "failed: x", "c": "done"}


def test_backfill_and_vectors(spark):
    cache = spark.createDataFrame([("a", None, "t", "f")], "article_id string, published date, title string, title_fp string")
    staged = spark.sql("SELECT * FROM VALUES ('a', DATE '2024-01-02', 'x'), ('b', DATE '2024-01-02', 'y'), ('c', DATE '2023-01-02', 'z'), ('', DATE '2024-01-02', 'w') AS t(article_id, published, title)")
    assert values(dedup.backfill(cache, staged, F.lit("2024-01-01").cast("date")), "article_id") == [("a",), ("b",)]
    v = dedup.hashed_vectors(spark, spark.sql("SELECT 1 AS id, 'one two two' AS s UNION ALL SELECT 2, ''"), "s", 16).collect()
    assert abs(sum(x * x for x in v[0]["v"]) - 1) < 1e-9 and sum(v[1]["v"]) == 0


def test_empty_links(spark):
    none = spark.createDataFrame([], "id long, title string, published timestamp, row_idx long, dc_ids array<string>, states array<string>")
    assert links.linked(none).count() == 0 and links.nested(links.linked(none), "dc_id", 5, F.col("title")).count() == 0
    assert feed.run_metrics(spark.createDataFrame([], "extraction_status string, summarize_status string, classify_status string")).first()["staged"] == 0


def test_dates_and_numbers(spark):
    row = spark.sql("SELECT '1/6/2026 7:08 pm' AS d, '1,234.5' AS n, ' TRUE ' AS t").select(parse.any_date(F.col("d")).alias("d"), parse.facility_number(F.col("n")).alias("n"), parse.is_true(F.col("t")).alias("t"), parse.day_label(parse.any_date(F.col("d"))).alias("l")).first()
    assert str(row["d"]) == "2026-01-06 19:08:00" and row["n"] == 1234.5 and row["t"] and row["l"] == "Jan 6, 2026"


def test_models_retry_and_stop(spark):
    def factory():
        calls = {"n": 0}

        def client(q):
            calls["n"] += 1
            if q == "bad" or (q == "flaky" and calls["n"] % 2):
                raise RuntimeError("no")
            return "```json\n{\"primary_category\": \"x\", \"relevance_score\": 4}\n```"

        return client

    rows = spark.createDataFrame([(1, "flaky"), (2, "ok"), *[(3 + i, "bad") for i in range(6)], (20, "ok")], "article_id long, prompt string").coalesce(1)
    got = {int(r["article_id"]): r for r in models.ask(rows, factory, wait=0.0).withColumn("d", models.decoded(F.col("answer"))).collect()}
    assert [got[i]["status"] for i in (1, 2, 3, 7, 8, 20)] == ["success", "success", "failed", "failed", "pending", "pending"]
    assert got[2]["d"]["relevance_score"] == 4 and got[3]["d"] is None


def counted(spark, answer):
    """A client's factory, and how often factory and client were called in all tasks."""
    made, calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)

        def client(question):
            calls.add(1)
            return answer(question)

        return client

    return factory, made, calls


def test_one_fallback_a_run(spark):
    def spent(question):
        raise models.QuotaExceeded("no more")

    rows = spark.range(400).repartition(4).select(F.col("id").alias("article_id"), F.concat(F.lit("q"), "id").alias("prompt"))
    first, _, calls = counted(spark, spent)
    second, _, other_calls = counted(spark, lambda q: "answer to " + q)
    got = models.ask_once(rows, first, fallback=second, wait=0.0)
    assert values(got, "article_id", "answer", "status") == sorted(((str(i), f"answer to q{i}", "success") for i in range(400)), key=repr)
    assert calls.value == 1 and other_calls.value == 400
    first, _, calls = counted(spark, spent)
    status = [r["status"] for r in models.ask_once(rows, first, wait=0.0).collect()]
    assert calls.value == 1 and sorted(set(status)) == ["failed", "pending"] and status.count("failed") == 1 and len(status) == 400


def test_one_breaker_a_run(spark):
    def broken(question):
        raise RuntimeError("down")

    rows = spark.range(400).repartition(4).select(F.col("id").alias("article_id"), F.concat(F.lit("q"), "id").alias("prompt"))
    first, _, calls = counted(spark, broken)
    status = [r["status"] for r in models.ask_once(rows, first, wait=0.0).collect()]
    assert calls.value <= 2 * models.BREAKER * models.TRIES and len(status) == 400
    assert status.count("failed") <= 2 * models.BREAKER and status.count("pending") >= 390

    def at_times(question):
        if int(question[1:]) % 3 == 0:
            raise RuntimeError("try another")
        return "fine"

    first, _, calls = counted(spark, at_times)
    got = values(models.ask_once(rows, first, wait=0.0), "article_id", "status")
    assert got == sorted(((str(i), "failed" if i % 3 == 0 else "success") for i in range(400)), key=repr)
    assert models.ask_once(rows.limit(0), first, wait=0.0).count() == 0


def test_models_fall_back_once(spark):
    def spent():
        def client(q):
            raise models.QuotaExceeded("no more")

        return client

    def other():
        return lambda q: "{}" if q != "spent" else spent()(q)

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "spent"), (4, "c")], "article_id long, prompt string").coalesce(1)
    got = models.ask(rows, spent, fallback=other, wait=0.0)
    assert values(got.withColumn("full", models.complete(F.col("answer"))), "article_id", "status", "full") == [("1", "success", False), ("2", "success", False), ("3", "failed", False), ("4", "success", False)]
    assert values(models.ask(rows, spent, wait=0.0), "status") == [("failed",)] * 4


def test_a_folder_is_needed_on_a_cluster():
    def fake(master, folder=None):
        context = SimpleNamespace(master=master, applicationId="app-of-a-test", getConf=lambda: {})
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert session.shared_dir(fake("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    assert session.shared_dir(fake("local[2]")).startswith("file://")
    with pytest.raises(ValueError):
        session.shared_dir(fake("spark://host:7077"))


def test_scratch_tables_go_and_kept_ones_stay(spark):
    with session.scratch(spark) as keep:
        inner = session.materialise(spark.range(3), "inner")
        with session.scratch(spark) as keep_inside:
            middle = keep_inside(session.materialise(inner, "innermost"), "middle")
        assert middle.count() == 3
        kept = keep(inner, "kept")
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        middle.count()


def test_running_sums_over_ranges(spark):
    rnd = random.Random(6)
    data = {(g, v): rnd.randint(1, 5) for g in "ab" for v in [rnd.choice([rnd.uniform(-3, 3), rnd.uniform(-1e6, 1e6), 0.0, 1e-9, -1e-9, 1e308, -1e308, float("inf"), float("nan")]) for _ in range(200)] if v == v}
    data |= {(g, float("nan")): 2 for g in "ab"}
    rows = spark.createDataFrame([(g, v, n) for (g, v), n in data.items()], "g string, v double, n long")
    order = lambda v: (v != v, v if v == v else 0)
    for r in cells.with_running(rows, ["g"], "v", "n").collect():
        same = [(order(v), n) for (g, v), n in data.items() if g == r["g"]]
        assert r["below_"] == sum(n for v, n in same if v < order(r["v"])) and r["total_"] == sum(n for _, n in same)


def test_rolling_dedup(spark):
    day = "CAST('2024-01-{0:02d}' AS TIMESTAMP)"
    batch = lambda rows: spark.sql(" UNION ALL ".join(f"SELECT CAST({a} AS BIGINT) AS arrival, '{t}' AS title, CAST(NULL AS ARRAY<DOUBLE>) AS v, {day.format(d)} AS published" for a, t, d in rows))
    now = lambda d: F.lit(f"2024-01-{d:02d}").cast("timestamp")
    marked, cache = runs.mark_batch(batch([(1, "Acme opens a site", 1), (2, "Acme opens a site!", 1), (3, "Other news of today", 1)]), spark.createDataFrame([], runs.CACHE), now(1))
    assert values(marked, "arrival", "duplicate_of") == [(1, None), (2, 1), (3, None)]
    marked, later = runs.mark_batch(batch([(4, "Acme opens a site", 2)]), cache, now(2))
    assert values(marked, "arrival", "duplicate_of") == [(4, 1)] and later.count() == 2
    marked, last = runs.mark_batch(batch([(5, "Acme opens a site", 20)]), later, now(20))
    assert values(marked, "arrival", "duplicate_of") == [(5, None)] and values(last, "arrival") == [(5,)]


def test_tables_are_dropped(spark):
    kept = session.materialise(spark.range(3), "x")
    assert kept.count() == 3
    session.drop_tables(spark)
    with pytest.raises(Exception, match="(?i)exist"):
        kept.count()
