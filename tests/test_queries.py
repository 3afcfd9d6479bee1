"""Every query with SQL gives the same rows as DuckDB, none of them empty."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from signalmill.queries import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(names, table):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order)) for r in table)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_same_as_sql(spark, duck, name):
    query, sql = REGISTRY[name]
    df = query(spark, SF)
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    want = found.fetchall()
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want)
    assert want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if not sql and n != "facility_candidates"])
def test_runs(spark, name):
    assert REGISTRY[name][0](spark, SF).count() > 0


def plain_partial_ratio(a, b):
    """Best ratio of the shorter text with any window of its length in the longer one, windows over the ends included."""
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            last = 0
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], last + 1 if c == d else max(row[j], row[j - 1])
        return row[-1]

    a, b = sorted((a, b), key=len)
    windows = {b[max(0, i) : i + len(a)] for i in range(1 - len(a), len(b))} if a else set()
    return max((200 * lcs(a, w) / (len(a) + len(w)) for w in windows), default=0.0)


def plain_page_text(page):
    """Main text by a tree of elements that is built from tags found by a pattern."""
    from html import unescape

    from signalmill.functions import html

    root = {"tag": "", "attrs": {}, "items": []}
    stack, at = [root], 0
    for m in re.finditer(r"<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>", page, re.S):
        if m.start() < at:
            continue
        stack[-1]["items"].append(unescape(page[at : m.start()]))
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if tag in html._BREAKS:
            stack[-1]["items"].append("\n")
        if m[1]:
            if any(e["tag"] == tag for e in stack):
                while stack.pop()["tag"] != tag:
                    pass
        elif tag not in html._VOID:
            attrs = {k.lower(): unescape(v or w or x) for k, v, w, x in re.findall(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", m[3])}
            element = {"tag": tag, "attrs": attrs, "items": []}
            stack[-1]["items"].append(element)
            stack.append(element)
            if tag in ("script", "style") and (end := re.compile(f"</{tag}\\s*>", re.I).search(page, at)):
                at = end.start()
    stack[-1]["items"].append(unescape(page[at:]))

    def noise(e):
        return e["tag"] in html.NOISE_TAGS or set(e["attrs"].get("class", "").split()) & set(html.NOISE_CLASSES)

    def places(e):
        return {e["tag"], "#" + e["attrs"].get("id", ""), f"[role={e['attrs'].get('role', '')}]", *("." + c for c in e["attrs"].get("class", "").split())}

    def words(e):
        return "".join(x if isinstance(x, str) else "" if noise(x) else words(x) for x in e["items"])

    def first(e, place):
        for x in e["items"]:
            if not isinstance(x, str) and not noise(x):
                if place in places(x):
                    return x
                if found := first(x, place):
                    return found
        return None

    for place in (*html.PLACES, "body"):
        if e := first(root, place):
            text = "\n".join(x for x in (" ".join(line.split()) for line in words(e).split("\n")) if x)
            if len(text) >= html.LEAST:
                return text
    return ""


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_page_main_text_of_all_pages(spark):
    from signalmill.functions import text

    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    plain = spark.createDataFrame([(p["page_id"], plain_page_text(p["html"] or "")) for p in pages], "page_id long, t string")
    want = {r["page_id"]: r["body"] for r in plain.select("page_id", text.body_lines(F.col("t")).alias("body")).collect()}
    got = {r["page_id"]: r["body"] for r in REGISTRY["page_main_text"][0](spark, SF).collect()}
    assert got == want and len(got) == len(pages) and sum(bool(x) for x in got.values()) > len(pages) / 3


def test_facility_candidates_are_the_best_three(spark, tmp_path):
    names = ["acme north hall and more", "boreal yard two", "cedar one two three", "acme south hall", "acme north mall", "delta"]
    texts = ["the acme north hall opens", "near boreal yrad two", "no name at all", "cedr one two, acme north hall", "", "acme north ball"]
    spark.createDataFrame(list(enumerate(names)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, t in enumerate(texts):
        scored = sorted((-plain_partial_ratio(" ".join(n.split()[:3]), "  " + t), f"DC-{k}") for k, n in enumerate(names))
        want |= {(i, dc, round(-s / 100, 3), r) for r, (s, dc) in enumerate([x for x in scored if x[0] <= -85][:3], 1)}
    got = REGISTRY["facility_candidates"][0](spark, str(tmp_path)).collect()
    assert want and {(r["id"], r["dc_id"], r["confidence"], r["rank"]) for r in got} == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_articles_by_priority_come_in_order(spark):
    got = [(-r["priority"], r["id"]) for r in REGISTRY["all_by_priority"][0](spark, SF).collect()]
    assert got == sorted(got) and len(got) > 100


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_reports(spark):
    from signalmill.operators import feed
    from signalmill.plans import files
    from signalmill.sources import reports

    articles = files._story_articles(spark, SF)
    facilities = spark.createDataFrame([("1", "A & B", "Op", "City", "VA", 1234.5, 1), ("1", "A <2>", "Op", "City", "VA", None, 2)], "asset_id string, name string, operator string, city string, state string, mw double, row_idx long")
    page = reports.issue(articles, facilities, files.END)
    assert page.count('class="card"') == feed.tagged_stories(articles, files.END).count() + feed.other_stories(articles, files.END).count() and "Jan 24, 2024 – Jan 30, 2024" in page
    nothing = reports.issue(articles.limit(0), facilities, files.END)
    assert nothing.count(reports.NO_STORIES) == 2
    html, plain = reports.summary_mail(reports.summary_lines(files._staged(spark, SF), articles), "Run <1>".replace("<", "of ").replace(">", ""))
    assert "HIGH SIGNAL" in plain and "more" in plain and "<h3>categories</h3>" in html and "&lt;" in html


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_greedy_dedup_compares_with_all_of_the_cache(spark, tmp_path):
    docs = [(20, "acme opens a site in the north\nx"), (50, "acme opens a site in the north\ny"), (51, "harbour vote moves to tuesday\nz"), (60, "quarterly figures\nx"), (70, "unlike all of these words\ny")]
    vectors = [(60, [0.0, 1.0]), (100, [1.0, 0.0]), (70, [1.0, 0.0])]
    spark.createDataFrame([*docs, (100, "nothing much")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["arrival"]: (r["is_duplicate"], r["duplicate_of"]) for r in REGISTRY["greedy_dedup"][0](spark, str(tmp_path)).collect()}
    assert got == {20: (True, 50), 50: (False, None), 51: (False, None), 60: (False, None), 70: (True, 100), 100: (False, None)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_every_document_has_a_relevance(spark):
    ids = {r["id"] for r in REGISTRY["rule_relevance_documents"][0](spark, SF).collect()}
    docs = {r["doc_id"] + 1000 for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert docs and ids == docs | set(range(1, 8))
