"""Queries that write files into the shared folder and read them again: sources, sinks, runs and reports."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dims, schemas
from ..functions import parse, text
from ..operators import dedup, feed, links, models
from ..session import tables_dir
from ..sources import keyed, readers, reports, writers
from ..streaming import runs
from . import bindings as b
from . import transforms
from .news import _STAGED_SQL, _STATES_SQL, _staged

REGISTRY: dict = {}
END = "2024-01-30"


def query(sql: str | None = None):
    def add(f):
        REGISTRY[f.__name__] = (f, sql)
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{tables_dir(spark)}/files-{name}-{uuid.uuid4().hex}"


# sources

_MARK = "﻿"
_MESSY_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS "ID", c_name || ' "x", ' || chr(10) || 'é' AS "Name", CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS "Segment" FROM customer"""


def _messy(spark: SparkSession, sf: str, name: str, encoding: str) -> str:
    """Customers as delimited text with quotes, line breaks, blanks, and a mark and blanks in the header."""
    path = _folder(spark, name)
    first = f"{_MARK}ID " if encoding == "UTF-8" else "ID "
    rows = b.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias(first), F.concat("c_name", F.lit(' "x", \né')).alias(' "Name"'), F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("Segment"))
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("encoding", encoding).csv(path)
    return path


@query(_MESSY_SQL)
def delimited_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_delimited(spark, _messy(spark, sf, "delimited", "UTF-8"))


@query(_MESSY_SQL)
def encoded_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The same in an encoding of one byte a character, which must be found out."""
    return readers.read_delimited(spark, _messy(spark, sf, "encoded", "ISO-8859-1"))


_FILE_ROWS = 500


@query(f"""SELECT c_custkey AS id, c_acctbal AS balance, row_number() OVER (PARTITION BY c_custkey // {_FILE_ROWS} ORDER BY c_custkey) AS place FROM customer""")
def typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """By a schema, with each row's place in its file."""
    path, k = _folder(spark, "typed"), F.col("c_custkey")
    rows = b.table(spark, sf, "customer").select(k.alias("id"), F.col("c_acctbal").alias("balance"), F.floor(k / _FILE_ROWS).alias("part"))
    rows.repartition("part").sortWithinPartitions("part", "id").write.option("header", True).partitionBy("part").csv(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("balance", T.DoubleType())])
    rows = readers.read_delimited(spark, path, schema=schema, order=True)
    place = f"row_number() OVER (PARTITION BY {readers.ORDER}.block.file ORDER BY {readers.ORDER})"
    return rows.selectExpr("id", "balance", f"{place} AS place").withColumn("place", F.col("place").cast("long"))


def _workbook(rows: list[tuple], columns: list[str]) -> bytes:
    """A workbook of one sheet with a line and a blank row above its header."""
    def cell(value: object, row: int, column: int) -> str:
        return "" if value is None else f'<c r="{chr(65 + column)}{row}" t="inlineStr"><is><t>{value}</t></is></c>'

    lines = [["made for this query"], [], [f" {c} " for c in columns], *rows]
    cells = "".join(f"<row>{''.join(cell(v, n, i) for i, v in enumerate(r))}</row>" for n, r in enumerate(lines, 1))
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Operating" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", f'<worksheet xmlns="{main}"><sheetData>{cells}</sheetData></worksheet>')
    return out.getvalue()


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS "Plant ID", n_name AS "Plant Name", CASE WHEN n_regionkey > 0 THEN CAST(n_regionkey AS VARCHAR) END AS "State" FROM nation""")
def workbook_scan(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["Plant ID", "Plant Name", "State"]
    nations = b.table(spark, sf, "nation").select("n_nationkey", "n_name", F.when(F.col("n_regionkey") > 0, F.col("n_regionkey"))).collect()  # a table of 25 rows at any scale
    path = _folder(spark, "workbook") + "/plants.xlsx"
    writers.put(spark, path, _workbook([tuple(r) for r in nations], columns))
    return readers.read_workbook(spark, path, "Operating", columns)


@query("SELECT 'Page <' || page_id || '>' AS title, url AS link, 'Mon, 08 Jan 2024 10:00:00 +0000' AS published FROM pages WHERE trim(url) <> ''")
def feed_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "feed")
    pages = b.table(spark, sf, "pages").where("trim(url) <> ''")
    item = F.format_string("<item><title>Page &lt;%d&gt;</title><link>%s</link><pubDate>Mon, 08 Jan 2024 10:00:00 +0000</pubDate></item>", "page_id", text.xml_escaped(F.col("url")))
    entry = F.format_string("<entry><title>Page &lt;%d&gt;</title><id>%s</id><published>Mon, 08 Jan 2024 10:00:00 +0000</published></entry>", "page_id", text.xml_escaped(F.col("url")))
    parts = pages.select(F.floor(F.col("page_id") / 500).alias("file"), F.when(F.col("page_id") % 2 == 0, item).otherwise(entry).alias("part"))
    feeds = parts.groupBy("file").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("part"), ""), F.lit("</channel></rss>")).alias("value"))  # of 500 entries each
    feeds.write.partitionBy("file").text(path)
    return readers.read_feed(spark, f"{path}/file=*").select("title", "link", "published")


@query("SELECT c_name AS line FROM customer WHERE c_custkey % 3 = 2")
def line_scan(spark: SparkSession, sf: str) -> DataFrame:
    path, k = _folder(spark, "lines"), F.col("c_custkey") % 3
    b.table(spark, sf, "customer").select(F.when(k == 0, " ").when(k == 1, F.concat(F.lit(" # "), "c_name")).otherwise(F.concat(F.lit("  "), "c_name"))).write.text(path)
    return readers.read_lines(spark, path)


@query("SELECT n_name AS key, CAST(n_regionkey AS BIGINT) AS region FROM nation")
def map_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed map beside a missing one and a broken one, which are empty."""
    path = _folder(spark, "map")
    whole = F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", F.struct(F.col("n_regionkey").alias("region"))))))
    b.table(spark, sf, "nation").agg(whole).coalesce(1).write.text(f"{path}/good")
    writers.put(spark, f"{path}/broken.json", b"{")
    parts = [readers.read_map(spark, f"{path}/{name}", "struct<region: bigint>") for name in ("good", "missing.json", "broken.json")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("key", "value.region")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def scan_or_empty(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = _folder(spark, "there"), T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    b.table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_name").alias("name")).write.option("header", True).csv(path)
    return readers.read_or_empty(spark, path, schema).unionByName(readers.read_or_empty(spark, path + "-missing", schema)).unionByName(readers.read_or_empty(spark, path + "-missing", schema, "parquet"))


@query("SELECT DATE '2024-01-01' + CAST(7 * r_regionkey AS INT) AS day, DATE '2024-01-01' + CAST(7 * r_regionkey AS INT) - 6 AS from_day FROM region")
def issue_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "issues")
    for r in b.table(spark, sf, "region").select(F.date_add(F.lit("2024-01-01").cast("date"), (7 * F.col("r_regionkey")).cast("int")).cast("string").alias("day")).collect():  # five rows at any scale
        writers.put(spark, f"{path}/issue_{r['day']}.html", b"<html></html>")
    writers.put(spark, f"{path}/undated.html", b"")
    return readers.newsletters(spark, path).select("day", "from_day")


@query("""SELECT c_custkey AS asset_id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN 'Planned' WHEN c_custkey % 4 = 1 THEN 'Closed' ELSE 'Unknown' END AS status, CASE WHEN c_custkey % 5 = 0 THEN 'Unclassified' ELSE c_mktsegment END AS company_type,
  CASE WHEN c_custkey % 6 = 0 THEN 0e0 ELSE 1000e0 + c_custkey END AS estimated_mw, 10e0 + c_custkey % 50 AS lat, CASE WHEN c_custkey % 9 = 0 THEN 0e0 ELSE -100.5e0 END AS lon FROM customer""")
def facility_transform(spark: SparkSession, sf: str) -> DataFrame:
    """A facility file as it comes, with lists in cells, separators in numbers and blanks, to the table of points."""
    k, path = F.col("c_custkey"), _folder(spark, "facilities")
    cells = {
        "Asset_ID": k.cast("string"), "Canonical_Name": F.col("c_name"), "Operator": F.lit("x"), "Company Type": F.when(k % 5 == 0, "[]").otherwise(F.concat(F.lit('["'), "c_mktsegment", F.lit('","Other"]'))),
        "Status": F.when(k % 4 == 0, "Planned, Operational").when(k % 4 == 1, '["odd","Closed"]').when(k % 4 == 2, "").otherwise("odd"), "estimated_mw": F.when(k % 6 == 0, "n/a").otherwise(F.format_number(1000.0 + k, 1)),
        "latitude": (10 + k % 50).cast("string"), "longitude": F.when(k % 9 == 0, "").otherwise("-100.5"),
    }
    raw = b.table(spark, sf, "customer").select(*(cells.get(c, F.lit("")).alias(c) for c in schemas.FACILITY))
    raw.write.option("header", True).option("escape", '"').csv(path)
    out = transforms.facility_points(readers.read_delimited(spark, path))
    return out.select(F.col("asset_id").cast("long").alias("asset_id"), "name", "status", "company_type", "estimated_mw", "lat", "lon")


# sinks

@query("SELECT event_id, event_type FROM events")
def append_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Half of a table, then all of it twice: each key is there once, and columns that the table lacks are left out."""
    path, events = _folder(spark, "append"), b.table(spark, sf, "events")
    for part in (events.where("event_id % 2 = 0"), events, events):
        writers.append_new(part, path, "event_id", ["event_id", "event_type"])
    return spark.read.parquet(path)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 1 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def updated_table(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed update as a new version beside the one before; an update without a value changes nothing."""
    path, table = _folder(spark, "updated"), b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    old = spark.read.parquet(writers.swap(table, path, "1"))
    updates = old.where("c_custkey % 3 = 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 1, "NEW").alias("c_mktsegment"))
    new = writers.swap(writers.updated(old, updates, "c_custkey", ["c_mktsegment"]), path, "2")
    exported = _folder(spark, "exported")
    writers.overwrite(spark.read.parquet(new), exported)
    return spark.read.parquet(exported)


@query("""SELECT c_custkey, CASE WHEN c_custkey = 77 THEN 'ONE' WHEN c_custkey % 5 = 0 THEN 'FIVE' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer
UNION ALL SELECT 10000000 + c_custkey, 'ADDED', NULL FROM customer WHERE c_custkey % 50 = 0""")
def keyed_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Three updates of a bucketed table: of a fifth of the keys, of one, and of some that aren't there yet; then older versions are dropped."""
    path, rows = _folder(spark, "keyed"), b.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    keyed.create(rows, path, "c_custkey", buckets=16)
    keyed.update(rows.where(key % 5 == 0).select(key, F.when(key % 2 < 2, "FIVE").alias("c_mktsegment")), path, ["c_mktsegment"])
    keyed.update(rows.where(key == 77).select(key, F.lit("ONE").alias("c_mktsegment")), path, ["c_mktsegment"])
    keyed.update(rows.where(key % 50 == 0).select((key + 10_000_000).alias("c_custkey"), F.lit("ADDED").alias("c_mktsegment")), path, ["c_mktsegment"], insert=True)
    keyed.vacuum(spark, path, 1)
    return keyed.read(spark, path)


_STAMPS = ("20240101_000000", "20240102_120000", "20240103_115959", "20240109_000000", "notes")


@query(f"""SELECT stamp AS snapshot_ts, count(*) AS files, CAST(sum(length(r_name)) AS BIGINT) AS bytes FROM region, (VALUES {', '.join(f"('{s}')" for s in _STAMPS)}) AS s(stamp)
WHERE coalesce(try_strptime(stamp, '%Y%m%d_%H%M%S') >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 7 DAY, true) GROUP BY 1""")
def pruned_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    inputs, archive = _folder(spark, "inputs"), _folder(spark, "archive")
    for r in b.table(spark, sf, "region").select("r_regionkey", "r_name").collect():  # five rows at any scale
        writers.put(spark, f"{inputs}/{r['r_regionkey']}.txt", r["r_name"].encode())
    for stamp in _STAMPS:
        writers.snapshot(spark, inputs, archive, stamp)
    writers.prune_snapshots(spark, archive, F.lit("2024-01-10 00:00:00").cast("timestamp"))
    left = spark.read.parquet(archive)
    return left.groupBy("snapshot_ts").agg(F.count("*").alias("files"), F.sum(F.length("content")).cast("long").alias("bytes"))


@query("SELECT n_nationkey, n_name FROM nation")
def page_constants(spark: SparkSession, sf: str) -> DataFrame:
    path = _folder(spark, "page") + "/page.html"
    writers.put(spark, path, writers.page("Nations", {"NATIONS": b.table(spark, sf, "nation").select("n_nationkey", "n_name")}).encode())
    text_ = spark.read.option("wholetext", True).text(path).select(F.regexp_extract("value", r"(?s)const NATIONS = (\[.*?\]);", 1).alias("json"))
    return text_.select(F.inline(F.from_json("json", "array<struct<n_nationkey: bigint, n_name: string>>")))


@query(f"WITH {b.FACILITIES_SQL} SELECT status, name FROM facilities")
def archived_placemarks(spark: SparkSession, sf: str) -> DataFrame:
    """Facilities from the folders of the written archives."""
    path = _folder(spark, "kmz") + "/facilities"
    rows = b.facilities(spark, sf).withColumn("sqft", F.lit(0.0))
    writers.kmz_folder(writers.placemarks(rows, {"Planned": "#FEB24C"}), path, dims.STATUSES)

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                kml = zipfile.ZipFile(io.BytesIO(content)).read("doc.kml").decode()
                folders = re.findall(r"<Folder><name>(.*?)</name>(.*?)</Folder>", kml, re.S)
                yield pd.DataFrame([(status, name) for status, body in folders for name in re.findall(r"<Placemark><name>(.*?)</name>", body)], columns=["status", "name"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(unzip, "status string, name string")


# reports

def _story_articles(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id")
    return b.articles(spark, sf).withColumns({
        "title": F.concat(F.lit("Story <"), i, F.lit("> & more")), "url": F.concat(F.lit("http://x/?a=1&b="), i), "summary": F.concat(F.lit("About "), i), "states": F.array("state"),
        "dc_ids": F.when(F.col("tagged"), F.array((F.col("user_id") % 60).cast("string"), F.lit("none"))).otherwise(F.array().cast("array<string>")),
    })


_CARD_SQL = """'<div class="card"><i>#' || place || '</i> <em>' || category || '</em> <time>' || strftime(published, '%b %-d, %Y') || '</time> <strong>' || score || '/10</strong><h3><a href="http://x/?a=1&amp;b=' || id || '">Story &lt;' || id || '&gt; &amp; more</a></h3><p>About '
  || id || '</p><small>Strategy ' || strategy || '/5, relevance ' || relevance || '/5</small>' || facilities || '</div>'"""
_ISSUE_WEEK_SQL = f"""{b.ARTICLES_SQL}, week AS (SELECT *, strategy + relevance AS score FROM articles WHERE NOT is_duplicate AND CAST(published AS DATE) BETWEEN DATE '{END}' - 6 AND DATE '{END}' AND strategy + relevance >= {feed.DIGEST_SCORE}),
tagged_ AS (SELECT *, row_number() OVER (ORDER BY score DESC, published DESC, id) AS place FROM week WHERE tagged QUALIFY place <= {feed.DIGEST_ROWS}),
others AS (SELECT *, row_number() OVER (ORDER BY score DESC, published DESC, id) AS place, '' AS facilities FROM week WHERE id NOT IN (SELECT id FROM tagged_) QUALIFY place <= {feed.DIGEST_ROWS})"""


@query(f"""WITH {b.FACILITIES_SQL}, {_ISSUE_WEEK_SQL}, listed AS (SELECT t.*, '<ul><li><b>' || CASE WHEN f.asset_id IS NULL THEN CAST(t.user_id % 60 AS VARCHAR) || '</b> Details unavailable' ELSE f.name || '</b> ' || f.company_type || ', , ' || f.state || ', ' || format('{{:,.0f}}', f.mw) || ' MW' END
  || '</li><li><b>none</b> Details unavailable</li></ul>' AS facilities FROM tagged_ t LEFT JOIN facilities f ON f.asset_id = t.user_id % 60)
SELECT 'tagged' AS section, CAST(place AS INT) AS place, {_CARD_SQL} AS card FROM listed UNION ALL SELECT 'others', CAST(place AS INT), {_CARD_SQL} FROM others""")
def issue_cards(spark: SparkSession, sf: str) -> DataFrame:
    facilities = b.facilities(spark, sf).select(F.col("asset_id").cast("string").alias("asset_id"), "name", F.col("company_type").alias("operator"), F.lit("").alias("city"), "state", "mw", F.col("asset_id").alias("row_idx"))
    return reports.issue_cards(_story_articles(spark, sf), facilities, END)


def _listed_sql(section: str, where: str, cap: int, order: str) -> str:
    entry = f"'[' || strategy || '/' || relevance || '] ' || substr('Story <' || id || '> & more', 1, {reports.TITLE_CHARACTERS})"
    return f"""SELECT '{section}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS place, {entry} AS text FROM articles WHERE NOT is_duplicate AND {where} QUALIFY place <= {cap}
UNION ALL SELECT '{section}', {cap + 1}, '+ ' || (count(*) - {cap}) || ' more' FROM articles WHERE NOT is_duplicate AND {where} HAVING count(*) > {cap}"""


_COUNTS = [("staged", "true")] + [(f"{c.split('_')[0]}_{v}", f"{c}_status = '{v}'") for c, v in (("extraction", "success"), ("extraction", "fallback"), ("extraction", "failed"), ("extraction", "duplicate"), ("summarize", "success"), ("classify", "success"), ("classify", "failed"))]
_LATEST = "published DESC NULLS LAST, id"


@query(f"""WITH {b.ARTICLES_SQL}, {_STAGED_SQL}, shares AS (SELECT category, count(*) AS n, CAST(round_even(100 * count(*) / sum(count(*)) OVER (), 0) AS INT) AS percent FROM articles WHERE NOT is_duplicate GROUP BY 1)
{" UNION ALL ".join(f"SELECT 'counts' AS section, {i} AS place, '{name.replace('_', ' ')}: ' || count(*) FILTER (WHERE {where}) AS text FROM staged" for i, (name, where) in enumerate(_COUNTS, 1))}
UNION ALL SELECT 'categories', CAST(row_number() OVER (ORDER BY n DESC, category) AS INT), category || ': ' || n || ' (' || percent || '%)' FROM shares
UNION ALL {_listed_sql("high signal", f"strategy >= {feed.HIGH_SIGNAL}", reports.HIGH_SIGNAL_ROWS, "strategy DESC, " + _LATEST)}
UNION ALL {_listed_sql("core", f"state IN {dims.CORE}", reports.CORE_ROWS, _LATEST)}
UNION ALL {_listed_sql("expansion", f"state NOT IN {dims.CORE} AND state IN {dims.EXPANSION}", reports.EXPANSION_ROWS, _LATEST)}""")
def summary_lines(spark: SparkSession, sf: str) -> DataFrame:
    return reports.summary_lines(_staged(spark, sf), _story_articles(spark, sf))


@query(f"WITH {b.ARTICLES_SQL} SELECT id, CAST(strategy + relevance AS BIGINT) AS priority FROM articles")
def all_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return feed.by_priority(b.articles(spark, sf), "id").select("id", F.col("priority").cast("long").alias("priority"))


@query("SELECT event_id FROM events ORDER BY event_id LIMIT 25")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return feed.first_rows(b.table(spark, sf, "events").select("event_id"), 25, "event_id")


# runs

@query("SELECT DISTINCT 'http://x/' || event_id % 700 AS raw_url, 'k' || event_id % 700 AS title FROM events")
def ingest_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of files with repeated urls, of which two are run again as after a crash before their commit: each url is taken up once."""
    source, sink, checkpoint = (_folder(spark, f"ingest-{x}") for x in ("in", "out", "checkpoint"))
    k = F.col("event_id") % 700
    rows = b.table(spark, sf, "events").select("event_id", F.concat(F.lit("http://x/"), k).alias("raw_url"), F.concat(F.lit("k"), k).alias("title"))
    schema = rows.drop("event_id").schema
    for part in (0, 1, None, 2, None):
        if part is not None:
            rows.where(F.col("event_id") % 3 == part).drop("event_id").write.mode("append").parquet(source)
        else:
            runs.forget_commit(spark, checkpoint)
        runs.ingest(spark, source, schema, sink, checkpoint)
    return spark.read.schema(schema).parquet(sink).select("raw_url", "title")


@query("""WITH r AS (SELECT event_id AS arrival, md5(CAST(event_id % 499 AS VARCHAR)) AS title FROM events), firsts AS (SELECT title, min(arrival) AS first FROM r GROUP BY 1)
SELECT arrival, CASE WHEN first < arrival THEN first END AS duplicate_of FROM r JOIN firsts USING (title)""")
def rolling_marks(spark: SparkSession, sf: str) -> DataFrame:
    """All events in three batches on three days, each against the cache that those before it left; the second batch is run twice."""
    path, i = _folder(spark, "rolling"), F.col("event_id")
    events = b.table(spark, sf, "events")
    last = events.agg(F.max(i)).first()[0] or 0
    rows = events.select(i.alias("arrival"), F.md5((i % 499).cast("string").cast("binary")).alias("title"), F.lit(None).cast("array<double>").alias("v"), F.least(F.lit(2), F.floor(i * 3 / (last + 1))).alias("part"))
    out = None
    for k in (0, 1, 1, 2):
        day = F.lit(f"2024-01-0{k + 2} 00:00:00").cast("timestamp")
        marks = runs.roll(rows.where(F.col("part") == k).withColumn("published", day), path, k, day).select("arrival", "duplicate_of", F.lit(k).alias("batch"))
        out = marks if out is None else out.where(F.col("batch") != k).unionByName(marks)
    return out.drop("batch")


def _answering() -> models.Client:
    """A stand-in for a hosted model: fails once for every fifth question and answers without all fields for every seventh."""
    failed: set[str] = set()

    def client(question: str) -> str:
        k = int(question.split()[-1])
        if k % 5 == 0 and question not in failed:
            failed.add(question)
            raise RuntimeError("try again")
        rest = "" if k % 7 == 0 else ', "states": ["VA"], "secondary_categories": [], "strategy_alignment_score": 3, "mentions_specific_dc": false, "confidence": 0.5'
        return f'```json\n{{"primary_category": "c{k % 3}", "relevance_score": {k % 5}{rest}}}\n```'

    return client


@query("SELECT CAST(event_id AS VARCHAR) AS article_id, 'success' AS status, 'c' || event_id % 3 AS primary_category, CAST(event_id % 5 AS INT) AS relevance_score, event_id % 7 <> 0 AS complete FROM events")
def model_answers(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "events").select(F.col("event_id").alias("article_id"), F.concat(F.lit("question "), "event_id").alias("prompt"))
    asked = models.ask_once(rows, _answering, wait=0.0)
    return asked.select("article_id", "status", models.decoded(F.col("answer"))["primary_category"].alias("primary_category"), models.decoded(F.col("answer"))["relevance_score"].alias("relevance_score"), models.complete(F.col("answer")).alias("complete"))


@query(f"SELECT doc_id, 'T' || doc_id || chr(10) || chr(10) || substr(CASE WHEN trim(coalesce(text, '')) <> '' AND doc_id % 4 <> 0 THEN text ELSE 'short ' || doc_id END, 1, {models.PROMPT_CHARACTERS}) AS prompt, substr(text, 1, {models.BODY_CHARACTERS}) AS body FROM documents")
def prompts(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    question = models.prompt(F.concat(F.lit("T"), i), F.when(i % 4 != 0, F.col("text")), F.concat(F.lit("short "), i))
    return b.table(spark, sf, "documents").select("doc_id", question.alias("prompt"), F.substring("text", 1, models.BODY_CHARACTERS).alias("body"))


# single columns

@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value END AS number, 'ART-' || substr(sha256('u' || event_id), 1, 16) AS article_id, CASE event_id % 3 WHEN 0 THEN 'Wire' WHEN 1 THEN 'tag ' || event_type ELSE '' END AS source,
  strftime(ts, '%b %-d, %Y') AS day FROM events""")
def feed_columns(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    value = F.when(i % 6 == 0, F.lit(None).cast("double")).when(i % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    tags = F.when(i % 3 == 1, F.array(F.concat(F.lit("tag "), "event_type"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    title = F.when(i % 3 == 0, "Wire").when(i % 2 == 0, "")
    return b.table(spark, sf, "events").select("event_id", parse.number_or_zero(value).alias("number"), text.article_id(F.concat(F.lit("u"), i)).alias("article_id"), text.feed_source(title, tags).alias("source"), parse.day_label(F.col("ts")).alias("day"))


_ISSUE_LISTS = [(1, '["DC-1", " DC-2 ", ""]'), (2, "DC-1, DC-2"), (3, "[DC-1, DC-2"), (4, "nan"), (5, "None"), (6, "[]"), (7, None), (8, " "), (9, '["a", null]'), (10, '"xy"'), (11, "12"), (12, '{"k": 1}')]


@query(f"""SELECT id, array_to_string(list_filter(list_transform(CASE WHEN s IS NULL OR trim(s) IN ('', '[]', 'nan', 'None') THEN [] WHEN json_valid(s) AND json_type(s) = 'ARRAY' THEN list_transform(from_json(s, '["VARCHAR"]'), lambda x: coalesce(x, 'None'))
  WHEN json_valid(s) AND json_type(s) = 'VARCHAR' THEN string_split(s ->> '$', '') WHEN json_valid(s) AND json_type(s) = 'OBJECT' THEN json_keys(s) ELSE string_split(s, ',') END, lambda x: trim(x)), lambda x: x <> ''), ';') AS items
FROM (SELECT * FROM {b.values_sql(_ISSUE_LISTS, 'id long, s string')} UNION ALL SELECT 1000 + c_custkey, CASE c_custkey % 3 WHEN 0 THEN '["' || c_name || '", "x"]' WHEN 1 THEN c_name || ', x ,' ELSE 'nan' END FROM customer)""")
def issue_lists(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    more = F.when(k % 3 == 0, F.concat(F.lit('["'), "c_name", F.lit('", "x"]'))).when(k % 3 == 1, F.concat("c_name", F.lit(", x ,"))).otherwise("nan")
    rows = b.inline(spark, _ISSUE_LISTS, "id long, s string").unionByName(b.table(spark, sf, "customer").select((k + 1000).alias("id"), more.alias("s")))
    return rows.select("id", F.array_join(parse.issue_list(F.col("s")), ";").alias("items"))


_CITY_NAMES_SQL = "[" + ", ".join(f"{{'n': '{k.lower()}', 'c': '{v}'}}" for k, v in (dims.STATE_NAMES | dims.CITY_STATES).items()) + "]"
_CITY_TEXTS = [(1, "Phoenix and Northern Virginia"), (2, "phoenix"), (3, "no place"), (4, "West Virginia, PHOENIX, OK")]


@query(f"""SELECT id, array_to_string({_STATES_SQL.replace(_STATES_SQL[_STATES_SQL.index('list_filter(') + 12 : _STATES_SQL.index(', lambda x: contains')], _CITY_NAMES_SQL)}, ',') AS states
FROM (SELECT * FROM {b.values_sql(_CITY_TEXTS, 'id long, s string')} UNION ALL SELECT 1000 + c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'from Phoenix to ' ELSE 'in Texas near ' END || c_name FROM customer)""")
def states_of_cities(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    more = b.table(spark, sf, "customer").select((k + 1000).alias("id"), F.concat(F.when(k % 2 == 0, "from Phoenix to ").otherwise("in Texas near "), "c_name").alias("s"))
    rows = b.inline(spark, _CITY_TEXTS, "id long, s string").unionByName(more)
    return rows.select("id", F.array_join(text.states(F.col("s"), cities=True), ",").alias("states"))


@query("""SELECT 'e' || event_id AS article_id FROM events WHERE event_id % 10 = 0
UNION ALL SELECT 'e' || event_id FROM events WHERE event_id % 10 <> 0 AND event_id % 4 <> 0 AND event_id % 7 <> 0 AND ts >= TIMESTAMP '2024-01-10 00:00:00'""")
def cache_backfill(spark: SparkSession, sf: str) -> DataFrame:
    i, at = F.col("event_id"), F.col("ts").cast("timestamp")
    rows = b.table(spark, sf, "events").select(i, F.concat(F.lit("e"), i).alias("key"), at.alias("published"))
    cache = rows.where("event_id % 10 = 0").select(F.col("key").alias("article_id"), "published", F.lit("t").alias("title"), F.lit("f").alias("title_fp"))
    staged = rows.select(F.when(i % 4 != 0, F.col("key")).when(i % 10 == 0, F.col("key")).otherwise(" ").alias("article_id"), "published", F.when((i % 7 != 0) | (i % 10 == 0), F.col("key")).alias("title"))
    return dedup.backfill(cache, staged, F.lit("2024-01-10 00:00:00").cast("timestamp")).select("article_id")


@query("SELECT DISTINCT 'a' || user_id AS article_id FROM events WHERE user_id % 4 <> 1")
def queued_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of two queues that overlap and hold blanks."""
    k = F.col("user_id")
    ids = b.table(spark, sf, "events").select(k, F.when(k % 4 != 1, F.concat(F.lit("a"), k)).otherwise(" ").alias("article_id"))
    return links.queued_ids(ids.where(k % 3 != 0), ids.where(k % 2 == 0).unionByName(ids.where(k % 3 == 0)))


@query("""WITH ok AS (SELECT * FROM lineitem WHERE l_quantity > 10), flags AS (SELECT l_returnflag, l_linestatus FROM ok GROUP BY ALL)
SELECT run, stage, outcome, CASE WHEN outcome = 'done' THEN n END AS n FROM (VALUES ('gated', 'clean', 'done'), ('gated', 'flags', 'done'), ('gated', 'broken', 'failed'), ('gated', 'parts', 'not run'),
  ('collected', 'clean', 'skipped'), ('collected', 'flags', 'done'), ('collected', 'broken', 'failed'), ('collected', 'parts', 'done')) AS t(run, stage, outcome)
LEFT JOIN (SELECT 'clean' AS stage, (SELECT count(*) FROM ok) AS n UNION ALL SELECT 'flags', (SELECT count(*) FROM flags) UNION ALL SELECT 'parts', (SELECT count(DISTINCT l_partkey) FROM ok)) USING (stage)""")
def stage_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Stages that write tables, of which the third fails: with a stop at the first failure, then as a slice that goes on from the tables that are there. What each came to, and the rows of its table."""
    path = _folder(spark, "stages")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    stages = {
        "clean": lambda: writers.overwrite(b.table(spark, sf, "lineitem").where("l_quantity > 10"), f"{path}/clean"),
        "flags": lambda: writers.overwrite(table("clean").groupBy("l_returnflag", "l_linestatus").count(), f"{path}/flags"),
        "broken": lambda: writers.overwrite(table("missing"), f"{path}/broken"),
        "parts": lambda: writers.overwrite(table("clean").select("l_partkey").where("l_partkey is not null").distinct(), f"{path}/parts"),
    }
    columns = ["run", "stage", "outcome", "n"]
    for run, chosen, stop in (("gated", None, True), ("collected", ["flags", "broken", "parts"], False)):
        for stage, said in runs.slices(stages, chosen, stop_at_failure=stop).items():
            row = table(stage).agg(F.count("*").alias("n")) if said == "done" else spark.range(1).select(F.lit(None).cast("long").alias("n"))
            row = row.select(F.lit(run).alias("run"), F.lit(stage).alias("stage"), F.lit(said.split(":")[0]).alias("outcome"), "n")
            writers.append(row, f"{path}/log", columns)
    return table("log")


@query("SELECT event_id AS id FROM events WHERE event_id % 3 <> 0 AND event_id % 2 = 0 AND event_id % 5 <> 0")
def candidate_articles(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    rows = b.table(spark, sf, "events").select(i.alias("id"), F.when(i % 3 == 0, F.array(F.lit("DC-1"))).otherwise(F.array().cast("array<string>")).alias("dc_ids"), (i % 2 == 0).alias("mentions"), F.when(i % 5 == 0, True).when(i % 7 != 0, False).alias("is_duplicate"))
    return links.eligible(rows).select("id")
