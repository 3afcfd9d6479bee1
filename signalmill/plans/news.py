"""Queries on articles, texts, links and duplicates, with the same in DuckDB SQL where it can say it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import html, parse, rules, text
from ..operators import dedup, feed, links
from ..session import short_batches
from . import bindings as b

REGISTRY: dict = {}
END = "2024-01-30"


def query(sql: str | None = None):
    def add(f):
        REGISTRY[f.__name__] = (f, sql)
        return f

    return add


# digest

_WEEK_SQL = f"""{b.ARTICLES_SQL}, week AS (SELECT *, CAST(published AS DATE) AS day, strategy + relevance AS score FROM articles WHERE NOT is_duplicate AND CAST(published AS DATE) BETWEEN DATE '{END}' - 6 AND DATE '{END}'),
tagged_ AS (SELECT * FROM week WHERE tagged AND score >= {feed.DIGEST_SCORE} ORDER BY score DESC, published DESC, id LIMIT {feed.DIGEST_ROWS})"""


@query(f"WITH {_WEEK_SQL} SELECT id, day, category, CAST(score AS BIGINT) AS score FROM tagged_")
def weekly_digest_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return feed.tagged_stories(b.articles(spark, sf), END).select("id", "day", "category", F.col("score").cast("long").alias("score"))


@query(f"WITH {_WEEK_SQL} SELECT id, day, category, CAST(score AS BIGINT) AS score FROM week WHERE score >= {feed.DIGEST_SCORE} AND id NOT IN (SELECT id FROM tagged_) ORDER BY score DESC, published DESC, id LIMIT {feed.DIGEST_ROWS}")
def weekly_digest_rest(spark: SparkSession, sf: str) -> DataFrame:
    return feed.other_stories(b.articles(spark, sf), END).select("id", "day", "category", F.col("score").cast("long").alias("score"))


@query(f"WITH {b.ARTICLES_SQL} SELECT category, count(*) AS n, CAST(round_even(100 * count(*) / greatest(sum(count(*)) OVER (), 1), 0) AS INT) AS percent FROM articles WHERE NOT is_duplicate GROUP BY 1")
def category_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return feed.histogram(b.articles(spark, sf), "category")


def _in(codes: tuple[str, ...]) -> str:
    return f"state IN {codes}"


@query(f"WITH {b.ARTICLES_SQL} SELECT footprint, count(*) AS n FROM (SELECT CASE WHEN {_in(dims.CORE)} THEN 'core' WHEN {_in(dims.EXPANSION)} THEN 'expansion' END AS footprint FROM articles WHERE NOT is_duplicate) WHERE footprint IS NOT NULL GROUP BY 1")
def footprint_split(spark: SparkSession, sf: str) -> DataFrame:
    return feed.footprint_split(b.articles(spark, sf).withColumn("states", F.array("state"))).groupBy("footprint").agg(F.count("*").alias("n"))


@query(f"WITH {b.ARTICLES_SQL} SELECT id, CAST(strategy AS BIGINT) AS strategy FROM articles WHERE strategy >= {feed.HIGH_SIGNAL} ORDER BY strategy DESC, published DESC, id LIMIT 20")
def high_signal(spark: SparkSession, sf: str) -> DataFrame:
    return feed.high_signal(b.articles(spark, sf)).select("id", F.col("strategy").cast("long").alias("strategy"))


@query(f"WITH {b.ARTICLES_SQL} SELECT id, state FROM articles WHERE category = 'purchase' AND state IN ('VA', 'AZ') AND CAST(published AS DATE) >= DATE '{END}' - 14")
def article_drawer(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.articles(spark, sf).withColumn("states", F.array("state"))
    return feed.drawer(rows, F.lit(END).cast("date"), 14, "purchase", ["VA", "AZ"]).select("id", "state")


_STATUS = {"extraction_status": ("pending", "success", "fallback", "failed", "duplicate"), "summarize_status": ("pending", "success", "failed", "skipped"), "classify_status": ("pending", "success", "failed")}


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the work queue, with statuses from their keys."""
    k = F.col("event_id")
    status = {c: F.get(F.array(*(F.lit(v) for v in values)), ((k / (7 ** i)).cast("long") % len(values)).cast("int")).alias(c) for i, (c, values) in enumerate(_STATUS.items())}
    return b.table(spark, sf, "events").select(
        k.alias("article_id"), *status.values(), F.when(k % 5 != 0, F.col("props")).alias("article_text"), F.when(k % 3 != 0, F.col("event_type")).alias("rss_description"), F.when(k % 4 != 0, F.col("event_type")).alias("summary_ai"),
        F.when(k % 2 == 0, "Yes").otherwise("No").alias("Processed"), F.col("ts").alias("staged_at"),
    )


_STAGED_SQL = "staged AS (SELECT event_id AS article_id, " + ", ".join(f"{list(v)}[CAST(CAST(trunc(event_id / {7 ** i}) AS BIGINT) % {len(v)} AS INT) + 1] AS {c}" for i, (c, v) in enumerate(_STATUS.items())) + """,
  CASE WHEN event_id % 5 <> 0 THEN props END AS article_text, CASE WHEN event_id % 3 <> 0 THEN event_type END AS rss_description, CASE WHEN event_id % 4 <> 0 THEN event_type END AS summary_ai,
  CASE WHEN event_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Processed", ts AS staged_at FROM events)"""


@query(f"""WITH {_STAGED_SQL} SELECT 'extract' AS stage, article_id FROM staged WHERE extraction_status = 'pending'
UNION ALL SELECT 'summarise', article_id FROM staged WHERE summarize_status = 'pending' AND extraction_status IN ('success', 'fallback') AND (coalesce(article_text, '') <> '' OR coalesce(rss_description, '') <> '')
UNION ALL SELECT 'classify', article_id FROM staged WHERE classify_status = 'pending' AND summarize_status = 'success' AND coalesce(summary_ai, '') <> ''""")
def stage_selectors(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    parts = [feed.pending(staged, s).select(F.lit(s).alias("stage"), "article_id") for s in ("extract", "summarise", "classify")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"""WITH {_STAGED_SQL} SELECT article_id, CASE WHEN article_id % 3 = 1 AND (classify_status = 'success' OR extraction_status = 'duplicate') THEN 'Yes' ELSE "Processed" END AS processed FROM staged""")
def promote_processed(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    return feed.promote(staged, staged.where("article_id % 3 = 1")).select("article_id", F.col("Processed").alias("processed"))


@query(f"""WITH {_STAGED_SQL} SELECT article_id, CASE WHEN article_id % 6 = 0 THEN 'success' WHEN article_id % 6 = 3 THEN 'failed' ELSE extraction_status END AS extraction_status FROM staged""")
def status_transition(spark: SparkSession, sf: str) -> DataFrame:
    staged = _staged(spark, sf)
    results = staged.where("article_id % 3 = 0").select("article_id", F.when(F.col("article_id") % 6 == 0, "success").otherwise("failed").alias("result"))
    return feed.transition(staged, results, "extraction_status").select("article_id", "extraction_status")


@query(f"""WITH {_STAGED_SQL} SELECT count(*) AS staged, {', '.join(f"count(*) FILTER (WHERE {c}_status = '{v}') AS {c.split('_')[0]}_{v}" for c, v in (("extraction", "success"), ("extraction", "fallback"), ("extraction", "failed"), ("extraction", "duplicate"), ("summarize", "success"), ("classify", "success"), ("classify", "failed")))} FROM staged""")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return feed.run_metrics(_staged(spark, sf))


@query(f"""WITH {_STAGED_SQL} SELECT article_id, staged_at >= TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 14 DAY AS cached, NOT coalesce(staged_at < TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 10 DAY AND classify_status = 'success', false) AS kept FROM staged""")
def seen_ttl_prune(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    staged = _staged(spark, sf)
    cached = feed.unexpired(staged, "staged_at", now, 14).select("article_id", F.lit(True).alias("cached"))
    kept = feed.prune_staged(staged, now, 10).select("article_id", F.lit(True).alias("kept"))
    out = staged.select("article_id").join(cached, "article_id", "left").join(kept, "article_id", "left")
    return out.select("article_id", F.coalesce("cached", F.lit(False)).alias("cached"), F.coalesce("kept", F.lit(False)).alias("kept"))


@query(f"WITH {_STAGED_SQL} SELECT extraction_status, count(*) AS n FROM staged WHERE CAST(staged_at AS DATE) = DATE '2024-01-10' GROUP BY 1")
def staged_on_day(spark: SparkSession, sf: str) -> DataFrame:
    return feed.value_counts(feed.staged_on(_staged(spark, sf), "2024-01-10"), "extraction_status")


@query(f"WITH {b.ARTICLES_SQL} SELECT count(DISTINCT user_id) AS users, count(DISTINCT state) AS states, count(DISTINCT category) AS categories FROM articles")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    return b.articles(spark, sf).agg(F.countDistinct("user_id").alias("users"), F.countDistinct("state").alias("states"), F.countDistinct("category").alias("categories"))


# parsers

_NUMBERS = [(1, "240,549"), (2, ""), (3, None), (4, "n/a"), (5, "5d"), (6, " 7.25 "), (7, "-3"), (8, "1e3"), (9, "4.0"), (10, "1,2,3"), (11, "."), (12, "-2.7")]
#: Customers' keys as numbers with separators, blanks, letters, exponents and without digits before the point, as blanks and as nulls.
_MADE_NUMBERS_SQL = """SELECT 1000 + c_custkey, CASE c_custkey % 7 WHEN 0 THEN c_custkey || ',000' WHEN 1 THEN ' ' || c_custkey || '.5 ' WHEN 2 THEN c_custkey || 'd' WHEN 3 THEN '-' || c_custkey % 1000 || 'e2' WHEN 4 THEN '.' || c_custkey WHEN 5 THEN ' ' END FROM customer"""
_NUM_SQL = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


@query(f"""SELECT id, CASE WHEN regexp_matches(replace(s, ',', ''), {_NUM_SQL}) THEN CAST(trim(replace(s, ',', '')) AS DOUBLE) ELSE 0 END AS facility,
  CASE WHEN s IS NULL OR trim(s) = '' THEN NULL WHEN regexp_matches(s, {_NUM_SQL}) THEN CAST(trim(s) AS DOUBLE) ELSE 0 END AS generator, CASE WHEN regexp_matches(s, {_NUM_SQL}) THEN CAST(trunc(CAST(trim(s) AS DOUBLE)) AS INT) ELSE 0 END AS whole
FROM (SELECT * FROM {b.values_sql(_NUMBERS, 'id long, s string')} UNION ALL {_MADE_NUMBERS_SQL})""")
def lenient_number(spark: SparkSession, sf: str) -> DataFrame:
    s, k = F.col("s"), F.col("c_custkey")
    made = F.when(k % 7 == 0, F.concat(k, F.lit(",000"))).when(k % 7 == 1, F.concat(F.lit(" "), k, F.lit(".5 "))).when(k % 7 == 2, F.concat(k, F.lit("d"))).when(k % 7 == 3, F.concat(F.lit("-"), k % 1000, F.lit("e2")))
    made = made.when(k % 7 == 4, F.concat(F.lit("."), k)).when(k % 7 == 5, " ")
    rows = b.inline(spark, _NUMBERS, "id long, s string").unionByName(b.table(spark, sf, "customer").select((k + 1000).alias("id"), made.alias("s")))
    return rows.select("id", parse.facility_number(s).alias("facility"), parse.generator_number(s).alias("generator"), parse.integer_or_zero(s).alias("whole"))


_LISTS = [
    (1, '["DC-1","DC-2"]'), (2, "DC-1, DC-2"), (3, "DC-1"), (4, "12"), (5, ""), (6, None), (7, "[]"), (8, '["VA", null]'), (9, '[" TX ", ""]'), (10, "[VA, PA"), (11, "None"), (12, '"x"'), (13, "nan"),
]
#: The lists of customers: JSON, cut at commas, broken JSON, or a JSON text.
_MADE_LISTS_SQL = """SELECT 1000 + c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN '["' || c_name || '", " x", "", null]' WHEN 1 THEN c_name || ', x ,' WHEN 2 THEN '[' || c_name || ', "x' WHEN 3 THEN '"' || c_name || '"' ELSE ' ' END AS s FROM customer"""


def _made_lists(spark: SparkSession, sf: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    text_ = F.when(k % 5 == 0, F.concat(F.lit('["'), name, F.lit('", " x", "", null]'))).when(k % 5 == 1, F.concat(name, F.lit(", x ,"))).when(k % 5 == 2, F.concat(F.lit("["), name, F.lit(', "x')))
    return b.table(spark, sf, "customer").select((k + 1000).alias("id"), text_.when(k % 5 == 3, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(" ").alias("s"))


def _list_sql(column: str, empty: str, null: str, dropped: str) -> str:
    """A list from a cell: a JSON list or scalar, else cut at commas without brackets and quotes."""
    items = f"""CASE WHEN {column} IS NULL OR trim({column}) IN ({empty}) THEN [] WHEN json_valid({column}) AND json_type({column}) = 'ARRAY' THEN list_transform(from_json({column}, '["VARCHAR"]'), lambda x: {null})
      WHEN json_valid({column}) AND json_type({column}) = 'VARCHAR' THEN [{column} ->> '$'] WHEN regexp_matches({column}, {_NUM_SQL}) THEN [{column}] ELSE string_split(regexp_replace({column}, '[\\[\\]"]', '', 'g'), ',') END"""
    return f"list_filter(list_transform({items}, lambda x: trim(x)), lambda x: x IS NOT NULL AND x NOT IN ({dropped}))"


_FACILITY_LIST_SQL = _list_sql("s", "''", "x", "'', '0', 'false'")


@query(f"""SELECT id, array_to_string({_FACILITY_LIST_SQL}, ';') AS facility, array_to_string({_list_sql("s", "'', '[]', 'None', 'nan'", "coalesce(x, 'None')", "''")}, ';') AS article
FROM (SELECT * FROM {b.values_sql(_LISTS, "id long, s string")} UNION ALL {_MADE_LISTS_SQL})""")
def json_list_parse(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s")
    rows = b.inline(spark, _LISTS, "id long, s string").unionByName(_made_lists(spark, sf))
    return rows.select("id", F.array_join(parse.facility_list(s), ";").alias("facility"), F.array_join(parse.article_list(s), ";").alias("article"))


@query("SELECT event_id, CAST(props ->> '$.k' AS INT) AS k FROM events")
def event_property(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


_STATUS_LISTS = [(1, '["Planned","Under Construction"]', '["Hyperscale"]'), (2, "Planned", ""), (3, "[]", "[]"), (4, "", '[""]'), (5, '["Odd","Closed"]', "Miner"), (6, '["Odd"]', None)]
_MADE_STATUS_SQL = f"""SELECT 1000 + c_custkey AS id, '["Odd", "' || {list(dims.STATUSES)}[CAST(c_custkey % {len(dims.STATUSES)} AS INT) + 1] || '", "Planned"]' AS s, CASE WHEN c_custkey % 3 = 0 THEN '[" ", "x"]' ELSE c_mktsegment || ', Other' END AS t FROM customer"""


@query(f"""SELECT id, coalesce(list_filter(list_, lambda x: x IN {dims.STATUSES})[1], '{dims.UNKNOWN_STATUS}') AS status, coalesce(nullif(trim(kinds[1]), ''), '{dims.UNCLASSIFIED}') AS kind
FROM (SELECT id, {_FACILITY_LIST_SQL} AS list_, {_FACILITY_LIST_SQL.replace("(s", "(t").replace(" s ", " t ").replace("[s", "[t")} AS kinds FROM (SELECT * FROM {b.values_sql(_STATUS_LISTS, "id long, s string, t string")} UNION ALL {_MADE_STATUS_SQL}))""")
def status_resolve(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    status = F.get(F.array(*(F.lit(s) for s in dims.STATUSES)), (k % len(dims.STATUSES)).cast("int"))
    made = b.table(spark, sf, "customer").select((k + 1000).alias("id"), F.concat(F.lit('["Odd", "'), status, F.lit('", "Planned"]')).alias("s"), F.when(k % 3 == 0, '[" ", "x"]').otherwise(F.concat("c_mktsegment", F.lit(", Other"))).alias("t"))
    rows = b.inline(spark, _STATUS_LISTS, "id long, s string, t string").unionByName(made)
    return rows.select("id", parse.first_status(parse.facility_list(F.col("s")), dims.STATUSES, dims.UNKNOWN_STATUS).alias("status"), parse.first_type(parse.facility_list(F.col("t")), dims.UNCLASSIFIED).alias("kind"))


#: Events' times in all forms, and every sixth in none.
_WRITTEN_DATES = [("M/d/yyyy h:mm a", "%-m/%-d/%Y %-I:%M %p"), ("MM/dd/yyyy HH:mm", "%m/%d/%Y %H:%M"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("' 'yyyy-MM-dd' '", " %Y-%m-%d "), ("M/d/yyyy", "%-m/%-d/%Y")]
_MADE_DATES_SQL = "SELECT 1000 + event_id, CASE event_id % 6 " + " ".join(f"WHEN {n} THEN strftime(ts, '{f}')" for n, (_, f) in enumerate(_WRITTEN_DATES)) + " ELSE 'no date' END FROM events"
_DATES = [(1, "01/26/2026 07:08 PM"), (2, "1/6/2026 7:08 PM"), (3, "1/26/2026 19:08"), (4, "2/3/2026"), (5, "2026-01-26 19:08:01"), (6, " 2026-01-26 "), (7, ""), (8, None), (9, "garbage"), (10, "13/45/2026")]


@query(f"SELECT id, coalesce({', '.join(f'''try_strptime(trim(s), '{f}')''' for f in ('%m/%d/%Y %I:%M %p', '%m/%d/%Y %H:%M', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%m/%d/%Y'))}) AS at FROM (SELECT * FROM {b.values_sql(_DATES, 'id long, s string')} UNION ALL {_MADE_DATES_SQL})")
def multi_format_date(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    made = F.lit("no date")
    for n, (pattern, _) in enumerate(_WRITTEN_DATES):
        made = F.when(i % 6 == n, F.date_format("ts", pattern)).otherwise(made)
    rows = b.inline(spark, _DATES, "id long, s string").unionByName(b.table(spark, sf, "events").select((i + 1000).alias("id"), made.alias("s")))
    return rows.select("id", parse.any_date(F.col("s")).alias("at"))


_FEED_DATES = [(1, "Mon, 26 Jan 2026 19:08:00 +0000", None), (2, None, "Tue, 27 Jan 2026 01:00:00 -0500"), (3, "2026-01-26T19:08:00Z", None), (4, None, None)]
_MAIL_SQL = "try_strptime(regexp_replace(trim({0}), '^[A-Za-z]{{3}},\\s*', ''), '%d %b %Y %H:%M:%S %z')"


@query(f"""SELECT id, strftime(coalesce(make_timestamp(epoch_us({_MAIL_SQL.format("a")})), make_timestamp(epoch_us({_MAIL_SQL.format("b")})), TIMESTAMP '2026-02-01 00:00:00'), '%m/%d/%Y %I:%M %p') AS label
FROM (SELECT * FROM {b.values_sql(_FEED_DATES, "id long, a string, b string")} UNION ALL SELECT 1000 + event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' +0200' END, CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%d %b %Y %H:%M:%S') || ' +0000' END FROM events)""")
def feed_dates(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    made = b.table(spark, sf, "events").select((i + 1000).alias("id"), F.when(i % 2 == 0, F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200"))).alias("a"), F.when(i % 3 == 0, F.concat(F.date_format("ts", "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))).alias("b"))
    rows = b.inline(spark, _FEED_DATES, "id long, a string, b string").unionByName(made)
    return rows.select("id", parse.feed_date(F.lit("2026-02-01 00:00:00").cast("timestamp"), F.col("a"), F.col("b")).alias("label"))


# text

_DOC_TITLES_SQL = "titles AS (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)"
_NORMAL_SQL = r"trim(regexp_replace(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.monotonically_increasing_id().alias("row_"))


@query(f"WITH {_DOC_TITLES_SQL} SELECT doc_id, {_NORMAL_SQL.format('title')} AS title FROM titles")
def normalize_title(spark: SparkSession, sf: str) -> DataFrame:
    return _titles(spark, sf).select("doc_id", text.normalised_title(F.col("title")).alias("title"))


_TITLES = [(1, "Acme opens 40 MW site - Daily Wire"), (2, "A - B | The Post"), (3, "One - two - three"), (4, "No suffix"), (5, None), (6, "Kept | " + "x" * 61), (7, "Zoë’s  Über—title!")]
_CUT_SQL = "CASE WHEN length(trim(regexp_extract(t, '(?s).*{1}(.*)$', 1))) <= 60 THEN regexp_extract(t, '(?s)(.*){1}.*$', 1) ELSE t END"


@query(f"""SELECT id, {_NORMAL_SQL.format("bare")} AS title FROM (SELECT id, CASE WHEN contains(t, ' | ') THEN {_CUT_SQL.format("", " [|] ")} WHEN contains(t, ' - ') THEN {_CUT_SQL.format("", " - ")} ELSE t END AS bare
FROM (SELECT id, coalesce(s, '') AS t FROM {b.values_sql(_TITLES, "id long, s string")} UNION ALL SELECT 1000 + doc_id, split_part(text, chr(10), 1) || CASE doc_id % 3 WHEN 0 THEN ' | Wire' WHEN 1 THEN ' - The Post' ELSE '' END FROM documents))""")
def dedup_titles(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("doc_id")
    made = _titles(spark, sf).select((i + 1000).alias("id"), F.concat("title", F.when(i % 3 == 0, " | Wire").when(i % 3 == 1, " - The Post").otherwise("")).alias("s"))
    return b.inline(spark, _TITLES, "id long, s string").unionByName(made).select("id", text.dedup_title(F.col("s")).alias("title"))


@query(f"WITH {_DOC_TITLES_SQL} SELECT doc_id, sha256({_NORMAL_SQL.format('title')}) AS fingerprint FROM titles")
def title_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return _titles(spark, sf).select("doc_id", text.title_fingerprint(F.col("title")).alias("fingerprint"))


@query(f"WITH {_DOC_TITLES_SQL} SELECT sha256({_NORMAL_SQL.format('title')}) AS fingerprint, min(doc_id) AS first_id, count(*) AS n FROM titles GROUP BY 1")
def fingerprint_groups(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.fingerprint_groups(_titles(spark, sf), "title", "doc_id")


_SENTENCES_SQL = r"""list_filter(list_transform(string_split(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: length(s) > 25)"""


@query(f"SELECT doc_id, CASE WHEN len(s) > 0 THEN array_to_string(s[1:3], ' ') ELSE substr(t, 1, 500) END AS sentences FROM (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t, {_SENTENCES_SQL} AS s FROM documents)")
def first_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", text.first_sentences(F.col("text"), 3).alias("sentences"))


@query("SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: length(x) >= 20 AND " + " AND ".join(f"NOT contains(lower(x), '{p}')" for p in dims.JUNK_PHRASES) + "), chr(10)) AS body FROM documents")
def clean_body(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", text.body_lines(F.col("text")).alias("body"))


_PLACES = [
    (1, "New campus in Northern Virginia and Ohio"), (2, "West Virginia plant, IN or OUT, OK?"), (3, "Arkansas"), (4, "Washington D.C. hearing"), (5, None), (6, "nothing here"), (7, "AZ, NY; TX."), (8, "Silicon Valley meets the Bay Area, new york"), (9, "Phoenix build"),
]
_NAMES_SQL = "[" + ", ".join(f"{{'n': '{k.lower()}', 'c': '{v}'}}" for k, v in dims.STATE_NAMES.items()) + "]"
# word borders in the Unicode sense: every other character is doubled, so that codes don't share one
_STATES_SQL = rf"""list_sort(list_distinct(list_concat(list_transform(list_filter({_NAMES_SQL}, lambda x: contains(lower(coalesce(s, '')), x.n)), lambda x: x.c),
  regexp_extract_all(regexp_replace(' ' || coalesce(s, '') || ' ', '([^\p{{L}}\p{{N}}\p{{M}}_])', '\1\1', 'g'), '[^\p{{L}}\p{{N}}\p{{M}}_]({'|'.join(sorted(set(dims.STATE_NAMES.values())))})[^\p{{L}}\p{{N}}\p{{M}}_]', 1))))"""


@query(f"SELECT id, array_to_string({_STATES_SQL}, ',') AS states FROM {b.values_sql(_PLACES, 'id long, s string')} UNION ALL SELECT 1000 + doc_id, array_to_string({_STATES_SQL.replace('(s,', '(text,')}, ',') FROM documents")
def extract_states(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.inline(spark, _PLACES, "id long, s string").unionByName(b.table(spark, sf, "documents").select((F.col("doc_id") + 1000).alias("id"), F.col("text").alias("s")))
    return rows.select("id", F.array_join(text.states(F.col("s")), ",").alias("states"))


_URL_SQL = r"""SELECT page_id, regexp_replace(lower(CASE WHEN q = '' THEN base ELSE base || '?' || q END), '/+$', '') AS url FROM (
  SELECT page_id, base, array_to_string(list_filter(string_split(query, '&'), lambda p: regexp_matches(p, '^[^=]+=.+$') AND NOT list_contains({0}, lower(string_split(p, '=')[1]))), '&') AS q FROM (
    SELECT page_id, regexp_extract(trim(url), '^([^?#]*)', 1) AS base, regexp_extract(trim(url), '^[^?#]*\?([^#]*)', 1) AS query FROM pages))"""


@query(_URL_SQL.format(list(dims.TRACKING)))
def canonical_url(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "pages").select("page_id", text.canonical_url(F.col("url")).alias("url"))


_URLS = [(1, "HTTP://X.com/A/?utm_source=a&b=2&c=&b=3&d=4#top"), (2, "https://x.com/a/"), (3, "https://x.com/?ref=1"), (4, "https://x.com/?a=1&b=2&a=3")]
# pairs go by the first place of their key, then by their own
_GROUPED_SQL = """list_transform(list_sort(list_transform(range(1, len(pairs) + 1), lambda i: {'first': list_position(keys, keys[i]), 'own': i})), lambda x: pairs[x.own])"""


@query(f"""SELECT id, regexp_replace(lower(CASE WHEN len(pairs) = 0 THEN base ELSE base || '?' || array_to_string({_GROUPED_SQL}, '&') END), '/+$', '') AS url
FROM (SELECT *, list_transform(pairs, lambda p: string_split(p, '=')[1]) AS keys FROM (SELECT id, regexp_extract(trim(s), '^([^?#]*)', 1) AS base,
  list_filter(string_split(regexp_extract(trim(s), '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: regexp_matches(p, '^[^=]+=.+$') AND NOT list_contains({list(dims.TRACKING)}, lower(string_split(p, '=')[1]))) AS pairs
FROM (SELECT * FROM {b.values_sql(_URLS, "id long, s string")} UNION ALL SELECT 1000 + page_id, url || '?z=1&a=' || page_id || '&z=2&UTM_Medium=x&b=#f' FROM pages)))""")
def canonical_url_cases(spark: SparkSession, sf: str) -> DataFrame:
    made = b.table(spark, sf, "pages").select((F.col("page_id") + 1000).alias("id"), F.concat("url", F.lit("?z=1&a="), "page_id", F.lit("&z=2&UTM_Medium=x&b=#f")).alias("s"))
    return b.inline(spark, _URLS, "id long, s string").unionByName(made).select("id", text.canonical_url(F.col("s")).alias("url"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&amp;', '&'), '&quot;', '"'), '&#\d+;', '', 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS snippet FROM pages""")
def strip_snippet(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "pages").select("page_id", text.snippet(F.col("html")).alias("snippet"))


@query()
def page_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return short_batches(b.table(spark, sf, "pages")).select("page_id", text.body_lines(html.page_text(F.col("html"))).alias("body"))


_LABELS = [(1, 1234.56), (2, 0.0), (3, None), (4, 999.4), (5, 2.5e6), (6, 3.1e9)]


def _part_sql(limit: str, unit: str) -> str:
    return f"printf('%.1f', round(v / {limit}, 1)) || '{unit}'"


@query(f"""SELECT id, CASE WHEN v > 0 THEN format('{{:,.1f}}', v) || ' MW' ELSE '' END AS mw, CASE WHEN v > 0 THEN format('{{:,.0f}}', round_even(v, 0)) || ' sqft' ELSE '' END AS sqft,
  CASE WHEN v >= 1e9 THEN {_part_sql("1e9", "B")} WHEN v >= 1e6 THEN {_part_sql("1e6", "M")} WHEN v >= 1e3 THEN {_part_sql("1e3", "K")} ELSE CAST(CAST(floor(v + 0.5) AS BIGINT) AS VARCHAR) END AS scaled,
  CASE WHEN v IS NULL OR v = 0 THEN '' WHEN v >= 1000 THEN {_part_sql("1000", "GW")} ELSE CAST(CAST(floor(v + 0.5) AS BIGINT) AS VARCHAR) || 'MW' END AS power
FROM (SELECT * FROM {b.values_sql(_LABELS, "id long, v double")} UNION ALL SELECT 1000 + c_custkey, abs(CAST(c_acctbal AS DOUBLE)) * 7.3 FROM customer)""")
def number_labels(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("v")
    made = b.table(spark, sf, "customer").select((F.col("c_custkey") + 1000).alias("id"), (F.abs(F.col("c_acctbal").cast("double")) * 7.3).alias("v"))
    rows = b.inline(spark, _LABELS, "id long, v double").unionByName(made)
    return rows.select("id", text.mw_label(v).alias("mw"), text.sqft_label(v).alias("sqft"), text.scaled_number(v).alias("scaled"), text.power_label(v).alias("power"))


@query("""SELECT c_custkey, replace(replace(replace(replace(c_name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS name, translate(lower(c_mktsegment || ' / x'), ' /', '__') AS slug,
  '80' || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2) AS kml, CAST(CAST('0x' || substr(h, 1, 2) AS INT) AS VARCHAR) || ',' || CAST('0x' || substr(h, 3, 2) AS INT) || ',' || CAST('0x' || substr(h, 5, 2) AS INT) AS rgb
FROM (SELECT *, upper(substr(md5(c_name), 1, 6)) AS h FROM customer)""")
def markup_labels(spark: SparkSession, sf: str) -> DataFrame:
    colour = F.concat(F.lit("#"), F.substring(F.md5(F.col("c_name").cast("binary")), 1, 6))
    return b.table(spark, sf, "customer").select(
        "c_custkey", text.xml_escaped(F.col("c_name")).alias("name"), text.slug(F.concat("c_mktsegment", F.lit(" / x"))).alias("slug"), text.kml_colour(colour).alias("kml"), F.array_join(text.rgb(colour).cast("array<string>"), ",").alias("rgb"),
    )


# rules

_ARTICLES = [
    (1, "Equinix announces new data center campus in Phoenix", "Equinix announces a $1.2 billion, 200 MW data center campus in Arizona. The site opens in 2027 with 500,000 square feet.", "Equinix builds."),
    (2, "Town council votes on data center ban", "Residents oppose data center plans. A moratorium is discussed by the planning commission in Virginia.", ""),
    (3, "Stock analysis: price target raised", "Analyst raises price target after earnings per share beat.", "Market cap grows."),
    (4, "Fiber build", "A long-haul network and fiber route across Texas. The submarine cable reaches a cable landing station.", None),
    (5, "Nothing of note", "The weather was fine today and people were out.", ""),
    (6, "Laws and output", "Colorado laws on output of basic steps.", ""),
    (7, "Google data center", "Google cloud region grows in Oregon with a PPA from the utility.", "Power purchase signed."),
]
#: Customers as articles about sites in these places.
_SITE_STATES = (*dims.STATE_NAMES, "no state", "Reston, VA", "an odd place")
_MADE_SITES_SQL = f"SELECT 1000 + c_custkey, c_name || ' plans a site', 'It lies in ' || {list(_SITE_STATES)}[c_custkey % {len(_SITE_STATES)} + 1] || '.', CASE WHEN c_custkey % 2 = 0 THEN 'Near ' || {list(_SITE_STATES)}[c_custkey % 5 + 1] END FROM customer"
_ARTICLE_SCHEMA = "id long, title string, body string, short string"
_INLINE_SQL = b.values_sql(_ARTICLES, _ARTICLE_SCHEMA)


def _doc_articles(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select((F.col("doc_id") + 1000).alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("body"), F.lit("").alias("short"))
    return b.inline(spark, _ARTICLES, _ARTICLE_SCHEMA).unionByName(docs)


_ALL_SQL = f"(SELECT * FROM {_INLINE_SQL} UNION ALL SELECT doc_id + 1000, split_part(text, chr(10), 1), text, '' FROM documents)"


def _match(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, '" + pattern.replace("'", "''") + "')"


def _any_sql(terms: tuple[str, ...]) -> str:
    return r"(^|[^a-z0-9])(" + "|".join(re.sub(r"([^a-z0-9 ])", r"\\\1", t.lower()) for t in terms) + r")($|[^a-z0-9])"


def _hits_sql(terms: tuple[str, ...]) -> str:
    return " + ".join(f"CAST({_match('low', rules.word_pattern(t))} AS INT)" for t in terms)


_SCORES_SQL = " UNION ALL ".join(f"SELECT id, {i} AS place, '{name}' AS name, {_hits_sql(k)} + 2 * ({_hits_sql(s)}) AS score FROM low" for i, (name, (k, s)) in enumerate(dims.CATEGORIES.items()))
_SUMMARY_SQL = f"""SELECT id, title, CASE WHEN len(s) >= 2 THEN array_to_string(s[1:3], ' ') ELSE coalesce(short, '') END AS summary FROM (SELECT id, title, short, {_SENTENCES_SQL.replace('trim(text,', 'trim(body,')} AS s FROM {_ALL_SQL})"""
_CATEGORY_SQL = f"""WITH low AS (SELECT id, lower(concat_ws(' ', title, summary)) AS low FROM ({_SUMMARY_SQL})), scores AS ({_SCORES_SQL}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, place) AS k FROM scores),
tops AS (SELECT id, max(CASE WHEN k = 1 THEN name END) AS primary_category, max(CASE WHEN k = 1 THEN score END) AS top, max(CASE WHEN k = 2 THEN score END) AS second FROM ranked GROUP BY id)
SELECT t.id, primary_category, coalesce((SELECT string_agg(name, '; ' ORDER BY k) FROM (SELECT r.name, r.k FROM ranked r WHERE r.id = t.id AND r.k > 1 AND r.score >= 2 AND 100 * r.score >= 40 * t.top ORDER BY r.k LIMIT 2)), '') AS secondary,
  round(CASE WHEN top = 0 THEN 0.1 ELSE least(1.0, (top - second + 1) / (top + 1)) END, 9) AS confidence FROM tops t"""


@query(_CATEGORY_SQL)
def rule_category(spark: SparkSession, sf: str) -> DataFrame:
    # exploding a one-item array keeps the optimizer from writing the expression out at each use
    c = _doc_articles(spark, sf).select("id", F.explode(F.array(rules.categorised(F.col("title"), F.col("body"), F.col("short")))).alias("c"))
    return c.select("id", F.col("c.primary").alias("primary_category"), parse.joined_list(F.col("c.secondary")).alias("secondary"), F.round("c.confidence", 9).alias("confidence"))


_SIGNALS_SQL = " + ".join(f"CAST({_match('low', p)} AS INT)" for p in rules.SIGNALS)


@query(f"""WITH s AS (SELECT id, low, {_SIGNALS_SQL} AS n FROM (SELECT a.id, lower(concat_ws(' ', a.title, substr(body, 1, {rules.OPENING}), summary)) AS low FROM {_ALL_SQL} a JOIN ({_SUMMARY_SQL}) USING (id)))
SELECT id, CASE WHEN {_match('low', _any_sql(dims.INVESTMENT_TERMS))} THEN 1 WHEN n >= 4 THEN 5 WHEN n >= 2 OR (n = 1 AND {_match('low', _any_sql(dims.OPERATORS))}) THEN 4 WHEN n = 1 THEN 3 WHEN {_match('low', _any_sql(dims.INFRASTRUCTURE_TERMS))} THEN 2 ELSE 1 END AS strategy FROM s""")
def rule_strategy(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_articles(spark, sf).select("id", rules.strategy(F.col("title"), F.col("body"), rules.summary(F.col("body"), F.col("short"))).alias("strategy"))


def _has(codes: tuple[str, ...]) -> str:
    return f"list_has_any(states, {list(codes)})"


@query(f"""SELECT id, CASE WHEN len(states) = 0 THEN 3 WHEN {_has(dims.CORE)} THEN 5 WHEN {_has(dims.EXPANSION + dims.ADJACENT)} THEN 4 ELSE 2 END AS relevance
FROM (SELECT id, {_STATES_SQL.replace("coalesce(s, '')", "concat_ws(' ', title, short, body)")} AS states FROM (SELECT * FROM {_INLINE_SQL} UNION ALL {_MADE_SITES_SQL}))""")
def rule_relevance(spark: SparkSession, sf: str) -> DataFrame:
    k, names_ = F.col("c_custkey"), F.array(*(F.lit(n) for n in _SITE_STATES))
    place = F.get(names_, (k % len(_SITE_STATES)).cast("int"))
    made = b.table(spark, sf, "customer").select((k + 1000).alias("id"), F.concat("c_name", F.lit(" plans a site")).alias("title"), F.concat(F.lit("It lies in "), place, F.lit(".")).alias("body"), F.when(k % 2 == 0, F.concat(F.lit("Near "), F.get(names_, (k % 5).cast("int")))).alias("short"))
    return b.inline(spark, _ARTICLES, _ARTICLE_SCHEMA).unionByName(made).select("id", rules.relevance(text.states(F.concat_ws(" ", "title", "short", "body"))).alias("relevance"))


@query(f"""SELECT id, CASE WHEN len(states) = 0 THEN 3 WHEN {_has(dims.CORE)} THEN 5 WHEN {_has(dims.EXPANSION + dims.ADJACENT)} THEN 4 ELSE 2 END AS relevance
FROM (SELECT id, {_STATES_SQL.replace("coalesce(s, '')", "concat_ws(' ', title, short, body)")} AS states FROM {_ALL_SQL})""")
def rule_relevance_documents(spark: SparkSession, sf: str) -> DataFrame:
    """As ``rule_relevance``, over the inline articles and all documents."""
    return _doc_articles(spark, sf).select("id", rules.relevance(text.states(F.concat_ws(" ", "title", "short", "body"))).alias("relevance"))


@query(f"""SELECT id, CASE WHEN {_match('lower(title)', _any_sql(dims.OPERATORS))} THEN 0.9 WHEN {_match('lower(head)', _any_sql(dims.OPERATORS))} THEN 0.7 WHEN {_match('lower(body)', _any_sql(dims.OPERATORS))} THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence
FROM (SELECT id, title, body, CASE WHEN len(s) > 0 THEN array_to_string(s[1:3], ' ') ELSE substr(trim(body), 1, 500) END AS head FROM (SELECT id, title, body, {_SENTENCES_SQL.replace('trim(text,', 'trim(body,')} AS s FROM {_ALL_SQL}))""")
def rule_mention(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_articles(spark, sf).select("id", rules.mention(F.col("title"), F.col("body")).alias("confidence"))


@query(f"SELECT id, summary FROM ({_SUMMARY_SQL})")
def rule_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_articles(spark, sf).select("id", rules.summary(F.col("body"), F.col("short")).alias("summary"))


# links

def _linkable(spark: SparkSession, sf: str) -> DataFrame:
    """Events with facility ids and states made from their keys; some lists repeat an id or hold a blank."""
    k = F.get_json_object("props", "$.k").cast("long")
    return b.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("ts").alias("published"), F.col("event_id").alias("row_idx"),
        F.when(k % 3 == 0, F.array(F.concat(F.lit("DC-"), (k % 40).cast("string")), F.lit(" "), F.concat(F.lit("DC-"), (k % 20).cast("string")))).otherwise(F.array().cast("array<string>")).alias("dc_ids"),
        F.when(k % 5 == 0, F.array(F.lit(" va "), F.lit("XX"))).when(k % 5 == 1, F.array(F.get(F.array(*(F.lit(s) for s in b.STATES)), (k % len(b.STATES)).cast("int")))).otherwise(F.array().cast("array<string>")).alias("states"),
    )


_LINKABLE_SQL = f"""linkable AS (SELECT event_id AS id, event_type AS title, ts AS published, event_id AS row_idx, CASE WHEN k % 3 = 0 THEN ['DC-' || (k % 40), ' ', 'DC-' || (k % 20)] ELSE [] END AS dc_ids,
  CASE WHEN k % 5 = 0 THEN [' va ', 'XX'] WHEN k % 5 = 1 THEN [{list(b.STATES)}[CAST(k % {len(b.STATES)} AS INT) + 1]] ELSE [] END AS states FROM (SELECT *, CAST(props ->> '$.k' AS BIGINT) AS k FROM events)),
linked AS (SELECT * FROM (SELECT id, title, published, row_idx, unnest(dc_ids) AS dc_id FROM linkable) WHERE trim(dc_id) <> '')"""


@query(f"WITH {_LINKABLE_SQL} SELECT id, dc_id FROM linked")
def links_explode(spark: SparkSession, sf: str) -> DataFrame:
    return links.linked(_linkable(spark, sf)).select("id", "dc_id")


@query(f"WITH {_LINKABLE_SQL} SELECT CASE WHEN len(dc_ids) > 0 THEN 'linked' WHEN len(states) > 0 THEN 'state' ELSE 'neither' END AS kind, count(*) AS n FROM linkable GROUP BY 1")
def links_partition(spark: SparkSession, sf: str) -> DataFrame:
    return links.kind(_linkable(spark, sf)).groupBy("kind").agg(F.count("*").alias("n"))


_CENTROIDS_SQL = "(VALUES " + ", ".join(f"('{s}', {lat}e0, {lon}e0)" for s, (lat, lon) in dims.CENTROIDS.items()) + ") AS c(state, lat, lon)"
_STATE_LINKED_SQL = f"state_linked AS (SELECT id, title, published, row_idx, state, lat, lon FROM (SELECT *, unnest(list_transform(states, lambda s: upper(trim(s)))) AS state FROM linkable WHERE len(dc_ids) = 0) JOIN {_CENTROIDS_SQL} USING (state))"


@query(f"WITH {_LINKABLE_SQL}, {_STATE_LINKED_SQL} SELECT id, state, lat, lon FROM state_linked")
def state_links_centroid(spark: SparkSession, sf: str) -> DataFrame:
    return links.state_linked(_linkable(spark, sf), dims.centroids(spark)).select("id", "state", "lat", "lon")


def _nest_sql(group: str, rows: str) -> str:
    return f"SELECT {group}, n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY k) AS items FROM (SELECT {group}, id, count(*) OVER (PARTITION BY {group}) AS n, row_number() OVER (PARTITION BY {group} ORDER BY published DESC NULLS LAST, row_idx) AS k FROM {rows}) WHERE k <= 5 GROUP BY ALL"


@query(f"WITH {_LINKABLE_SQL} {_nest_sql('title', 'linkable')}")
def nest_top5(spark: SparkSession, sf: str) -> DataFrame:
    return links.nested(_linkable(spark, sf), "title", 5, F.col("id").cast("string")).withColumn("items", F.array_join("items", ","))


@query(f"WITH {_LINKABLE_SQL}, {_STATE_LINKED_SQL} {_nest_sql('state', 'state_linked')}")
def state_rollup_top5(spark: SparkSession, sf: str) -> DataFrame:
    rows = links.state_linked(_linkable(spark, sf), dims.centroids(spark))
    return links.nested(rows, "state", 5, F.col("id").cast("string")).withColumn("items", F.array_join("items", ","))


@query(f"WITH {_LINKABLE_SQL}, f AS (SELECT 'DC-' || unnest(range(50)) AS asset_id) SELECT asset_id, count(l.id) AS n FROM f LEFT JOIN linked l ON l.dc_id = f.asset_id GROUP BY 1")
def facility_article_counts(spark: SparkSession, sf: str) -> DataFrame:
    facilities = spark.range(50).select(F.concat(F.lit("DC-"), F.col("id").cast("string")).alias("asset_id"))
    return links.facility_articles(facilities, links.linked(_linkable(spark, sf))).select("asset_id", "n")


@query(f"""WITH {_LINKABLE_SQL}, f AS (SELECT 'DC-' || i AS asset_id, 'Site ' || i AS label FROM (SELECT unnest(range(0, 50, 2)) AS i))
SELECT id, string_agg(coalesce(label, 'Details unavailable'), '; ' ORDER BY pos) AS facility_labels FROM (SELECT id, unnest(dc_ids) AS asset_id, unnest(range(len(dc_ids))) AS pos FROM linkable) LEFT JOIN f USING (asset_id) GROUP BY id""")
def story_facilities(spark: SparkSession, sf: str) -> DataFrame:
    facilities = spark.range(0, 50, 2).select(F.concat(F.lit("DC-"), F.col("id").cast("string")).alias("asset_id"), F.concat(F.lit("Site "), F.col("id").cast("string")).alias("label"), F.col("id").alias("row_idx"))
    stories = _linkable(spark, sf).where("size(dc_ids) > 0")
    return links.story_facilities(stories, facilities).select("id", F.array_join("facility_labels", "; ").alias("facility_labels"))


@query("""SELECT title, arg_min(src, rank) AS src, count(*) AS n FROM (SELECT split_part(text, chr(10), 1) AS title, 'a' AS src, doc_id AS rank FROM documents UNION ALL SELECT split_part(text, chr(10), 1), 'b', 1000000000 + item_id FROM benchmark) GROUP BY 1""".replace(", count(*) AS n", ""))
def title_dedup_union(spark: SparkSession, sf: str) -> DataFrame:
    def rows(name: str, key: str, src: str) -> DataFrame:
        return b.table(spark, sf, name).select(F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.lit(src).alias("src"), F.col(key).alias("row_idx"))

    return links.first_of_title(rows("documents", "doc_id", "a"), rows("benchmark", "item_id", "b")).select("title", "src")


def _found(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("dc_id"), (F.get_json_object("props", "$.k").cast("int") / 100).alias("confidence"))


@query("""SELECT id, CASE WHEN row_number() OVER (ORDER BY confidence DESC, id, dc_id) <= 500 THEN 'queue' ELSE 'overflow' END AS destination
FROM (SELECT event_id AS id, CAST(user_id AS VARCHAR) AS dc_id, CAST(props ->> '$.k' AS INT) / 100 AS confidence FROM events)""")
def review_queue_split(spark: SparkSession, sf: str) -> DataFrame:
    return links.review_queue(_found(spark, sf), 500).select("id", "destination")


@query("""WITH f AS (SELECT event_id AS article_id, CASE WHEN event_id % 4 = 0 THEN 'DC-old' END AS dc_id FROM events),
a AS (SELECT event_id % 700 AS article_id, arg_max('DC-' || user_id, event_id) AS new FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT article_id, CASE WHEN coalesce(trim(dc_id), '') = '' AND new IS NOT NULL THEN new ELSE dc_id END AS dc_id, coalesce(trim(dc_id), '') = '' AND new IS NOT NULL AS applied FROM f LEFT JOIN a USING (article_id)""")
def apply_approvals(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    rows = events.select(F.col("event_id").alias("article_id"), F.when(F.col("event_id") % 4 == 0, "DC-old").alias("dc_id"))
    status = F.when(F.col("event_type") == "purchase", " Approved ").otherwise("rejected")
    approvals = events.select((F.col("event_id") % 700).alias("article_id"), F.concat(F.lit("DC-"), F.col("user_id").cast("string")).alias("dc_id"), status.alias("review_status"), F.col("event_id").alias("row_idx"))
    return links.apply_approvals(rows, approvals)


_FACILITIES = [(1, "DC-1", "Acme North", "Acme One", "Acme"), (2, "DC-2", "Boreal Campus", None, "Boreal Power Group"), (3, "DC-3", "Cedar", "Cedar", "QTS"), (4, "DC-4", "Acme North", "Delta Yard", "")]
_HAYS = [(1, "Acme North opens a hall"), (2, "the Boreal Campus grows, says Boreal Power Group"), (3, "Delta Yrad and Cedr"), (4, "nothing at all"), (5, "")]


_THREE_WORDS_SQL = "array_to_string(regexp_split_to_array(text, '\\s+')[1:3], ' ')"


@query(f"""WITH f AS (SELECT * FROM {b.values_sql(_FACILITIES, "row_idx long, asset_id string, canonical_name string, alias string, operator string")} UNION ALL SELECT 1000 + item_id, 'DC-' || (1000 + item_id), {_THREE_WORDS_SQL}, NULL, '' FROM benchmark),
named AS (SELECT row_idx, asset_id AS dc_id, 'canonical_name' AS field, trim(canonical_name) AS name FROM f UNION ALL SELECT row_idx, asset_id, 'alias', trim(alias) FROM f WHERE alias IS DISTINCT FROM canonical_name UNION ALL SELECT row_idx, asset_id, 'operator', trim(operator) FROM f WHERE length(trim(operator)) > 3),
last_ AS (SELECT * FROM named WHERE coalesce(name, '') <> '' QUALIFY row_number() OVER (PARTITION BY name ORDER BY row_idx DESC, field) = 1),
hays AS (SELECT * FROM {b.values_sql(_HAYS, "id long, hay string")} UNION ALL SELECT 1000 + doc_id, text FROM documents)
SELECT id, dc_id, name FROM hays JOIN last_ ON contains(hay, name)""")
def candidates_contained(spark: SparkSession, sf: str) -> DataFrame:
    schema = "row_idx long, asset_id string, canonical_name string, alias string, operator string"
    i, words = F.col("item_id") + 1000, F.split("text", r"\s+")
    made = b.table(spark, sf, "benchmark").select(i.alias("row_idx"), F.concat(F.lit("DC-"), i).alias("asset_id"), F.array_join(F.slice(words, 1, 3), " ").alias("canonical_name"), F.lit(None).cast("string").alias("alias"), F.lit("").alias("operator"))
    hays = b.inline(spark, _HAYS, "id long, hay string").unionByName(b.table(spark, sf, "documents").select((F.col("doc_id") + 1000).alias("id"), F.col("text").alias("hay")))
    return links.contained(hays, links.names(b.inline(spark, _FACILITIES, schema).unionByName(made))).select("id", "dc_id", "name")


@query()
def facility_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against names of three words from the benchmark."""
    words = F.split("text", r"\s+")
    facilities = b.table(spark, sf, "benchmark").select(F.col("item_id").alias("row_idx"), F.concat(F.lit("DC-"), F.col("item_id").cast("string")).alias("asset_id"), F.array_join(F.slice(words, 1, 3), " ").alias("canonical_name"), F.lit(None).cast("string").alias("alias"), F.lit("").alias("operator"))
    docs = b.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), links.haystack(F.lit(""), F.lit(""), F.col("text")).alias("hay"))
    return links.candidates(docs, links.names(facilities), 85.0)


# duplicates

@query(f"""WITH u AS (SELECT page_id AS arrival, url FROM pages UNION ALL SELECT page_id + 1000000, url FROM pages WHERE page_id % 2 = 0)
SELECT min(arrival) AS arrival, url AS raw_url FROM u WHERE trim(url) <> '' AND {' AND '.join(f"NOT contains(url, '{p}')" for p in dims.BLOCKED_URLS)} AND url NOT IN (SELECT url FROM pages WHERE page_id % 10 = 3) AND url NOT IN (SELECT url FROM pages WHERE page_id % 10 = 7) GROUP BY url""")
def exact_url_dedup(spark: SparkSession, sf: str) -> DataFrame:
    pages = b.table(spark, sf, "pages").select(F.col("page_id").alias("arrival"), F.col("url").alias("raw_url"))
    batch = pages.unionByName(pages.where("arrival % 2 = 0").withColumn("arrival", F.col("arrival") + 1_000_000))
    seen = pages.where("arrival % 10 = 3").select(F.col("raw_url").alias("url"))
    return dedup.new_urls(batch, seen, pages.where("arrival % 10 = 7")).select("arrival", "raw_url")


@query()
def fuzzy_title_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.title_pairs(_titles(spark, sf).select(dedup.sorted_tokens(text.dedup_title(F.col("title"))).alias("key")))


_VECTOR_SQL = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
#: The table's vectors are far apart, so the registered threshold is low.
LOW_COSINE = 0.35


@query(f"WITH {_VECTOR_SQL} SELECT x.vec_id AS a, y.vec_id AS b, round(list_cosine_similarity(x.v, y.v), 6) AS cosine FROM v x JOIN v y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= {LOW_COSINE}")
def semantic_pairs(spark: SparkSession, sf: str) -> DataFrame:
    vectors = b.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return dedup.cosine_pairs(vectors, LOW_COSINE).withColumn("cosine", F.round("cosine", 6))


@query(f"WITH {_VECTOR_SQL} SELECT vec_id AS arrival, EXISTS (SELECT 1 FROM v y WHERE y.vec_id < x.vec_id AND list_cosine_similarity(x.v, y.v) >= {LOW_COSINE}) OR EXISTS (SELECT 1 FROM v z WHERE z.vec_id % 10 = 0 AND x.vec_id % 10 <> 0 AND list_cosine_similarity(x.v, z.v) >= {LOW_COSINE}) AS is_duplicate FROM v x WHERE vec_id % 10 <> 0".replace("y.vec_id < x.vec_id", "y.vec_id % 10 <> 0 AND y.vec_id < x.vec_id"))
def semantic_backstop(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "embeddings").select(F.col("vec_id").alias("arrival"), F.col("embedding").alias("v"))
    return dedup.backstop(rows.where("arrival % 10 <> 0"), rows.where("arrival % 10 = 0"), LOW_COSINE).select("arrival", "is_duplicate")


#: Added to the arrivals of cached documents, so that they come before all others and keep their order.
CACHED_ARRIVALS = -(1 << 62)


@query()
def greedy_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their vectors, by doc_id; those divisible by 50 are in the cache, which comes before all others. The rows have doc_ids again."""
    vectors = b.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("v"))
    cached = F.col("doc_id") % 50 == 0
    arrival = F.col("doc_id") + F.when(cached, CACHED_ARRIVALS).otherwise(0)
    rows = _titles(spark, sf).join(vectors, "doc_id", "left").select(arrival.alias("arrival"), "title", "v", cached.alias("cached"))
    marks = dedup.stacked(rows, cosine_threshold=LOW_COSINE)
    return marks.withColumns({c: F.when(F.col(c) < 0, F.col(c) - CACHED_ARRIVALS).otherwise(F.col(c)) for c in ("arrival", "duplicate_of")})
