"""Rendered reports: the weekly issue, and the summary of a run as HTML and as plain text.

What goes into a report is worked out as rows, one rendered piece a row with its place; only those rows, of a bounded
number, come to the driver and are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import day_label
from ..functions.text import xml_escaped
from ..operators import feed

#: Rows of the lists in a run's summary; what a list leaves out is counted below it.
HIGH_SIGNAL_ROWS, CORE_ROWS, EXPANSION_ROWS = 20, 15, 10
TITLE_CHARACTERS = 80
NO_DETAILS, NO_STORIES = "Details unavailable", "No stories found for this period."


def facility_lines(stories: DataFrame, facilities: DataFrame) -> DataFrame:
    """Stories with ``facilities_html``: a line for each of their facilities (asset_id, name, operator, city, state, mw) in list order, empty without any."""
    last = facilities.groupBy(F.col("asset_id").alias("dc_id")).agg(F.max_by(F.struct("name", "operator", "city", "state", "mw"), "row_idx").alias("f"))
    power = F.coalesce(F.concat(F.format_number("f.mw", 0), F.lit(" MW")), F.lit("—"))
    known = F.format_string("<li><b>%s</b> %s, %s, %s, %s</li>", *(xml_escaped(F.col(f"f.{c}")) for c in ("name", "operator", "city", "state")), power)
    unknown = F.format_string(f"<li><b>%s</b> {NO_DETAILS}</li>", xml_escaped(F.col("dc_id")))
    lines = stories.select("id", F.posexplode("dc_ids").alias("pos", "dc_id")).join(last, "dc_id", "left")
    lines = lines.select("id", "pos", F.when(F.col("f").isNull(), unknown).otherwise(known).alias("line"))
    lists = lines.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "").alias("lines"))
    return stories.join(lists, "id", "left").withColumn("facilities_html", F.coalesce(F.concat(F.lit("<ul>"), F.col("lines"), F.lit("</ul>")), F.lit(""))).drop("lines")


def cards(stories: DataFrame) -> DataFrame:
    """place (from 1, best first) and HTML card of each of a section's stories, of which there are ten at most."""
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("published").desc(), "id"))
    card = F.format_string(
        '<div class="card"><i>#%d</i> <em>%s</em> <time>%s</time> <strong>%d/10</strong><h3><a href="%s">%s</a></h3><p>%s</p><small>Strategy %d/5, relevance %d/5</small>%s</div>',
        F.col("place"), xml_escaped(F.col("category")), F.coalesce(day_label(F.col("published")), F.lit("—")), F.col("score"), xml_escaped(F.col("url")), xml_escaped(F.col("title")), xml_escaped(F.col("summary")),
        F.col("strategy"), F.col("relevance"), F.coalesce(F.col("facilities_html") if "facilities_html" in stories.columns else F.lit(""), F.lit("")),
    )
    return stories.withColumn("place", place).select("place", card.alias("card"))


def issue_cards(articles: DataFrame, facilities: DataFrame, end: str) -> DataFrame:
    """section, place and card of the issue of the week up to ``end``: stories with facilities, then the others."""
    tagged = cards(facility_lines(feed.tagged_stories(articles, end), facilities))
    others = cards(feed.other_stories(articles, end))
    return tagged.withColumn("section", F.lit("tagged")).unionByName(others.withColumn("section", F.lit("others"))).select("section", "place", "card")


def issue(articles: DataFrame, facilities: DataFrame, end: str, title: str = "Market signals") -> str:
    """The HTML page of an issue; a section without stories says so."""
    got = issue_cards(articles, facilities, end).orderBy("section", "place").collect()
    week = articles.sparkSession.range(1).select(F.concat(day_label(F.date_sub(F.lit(end).cast("date"), feed.DIGEST_DAYS - 1)), F.lit(" – "), day_label(F.lit(end).cast("date")))).first()[0]
    parts = []
    for name, head in (("tagged", f"Stories with facilities, {feed.DIGEST_SCORE} of 10 or more"), ("others", f"Other stories, {feed.DIGEST_SCORE} of 10 or more")):
        own = [r["card"] for r in got if r["section"] == name]
        parts.append(f"<section><h2>{head}</h2>\n" + "\n".join(own or [f"<p>{NO_STORIES}</p>"]) + "\n</section>")
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}, {week}</title></head><body><h1>{title}</h1><p>{week}</p>\n" + "\n".join(parts) + "\n</body></html>"


def _listed(rows: DataFrame, section: str, cap: int, order: list[Column | str]) -> DataFrame:
    """section, place and text (score, title) of the first ``cap`` rows, and a last line that counts the others."""
    entry = F.format_string("[%d/%d] %s", "strategy", "relevance", F.substring("title", 1, TITLE_CHARACTERS))
    best = rows.orderBy(*order).limit(cap)
    shown = best.select(F.row_number().over(Window.orderBy(*order)).alias("place"), entry.alias("text"))
    more = rows.agg((F.count("*") - cap).alias("n")).where("n > 0").select(F.lit(cap + 1).alias("place"), F.format_string("+ %d more", "n").alias("text"))
    return shown.unionByName(more).select(F.lit(section).alias("section"), "place", "text")


def summary_lines(staged: DataFrame, articles: DataFrame) -> DataFrame:
    """section, place and text of a run's summary: counts by status, categories with percents, articles of high signal, and those of core and expansion states."""
    metrics = feed.run_metrics(staged)
    counts = metrics.select(F.posexplode(F.array(*(F.concat(F.lit(f"{c.replace('_', ' ')}: "), F.col(c).cast("string")) for c in metrics.columns))).alias("place", "text"))
    shares = feed.histogram(articles, "category").select(F.row_number().over(Window.orderBy(F.col("n").desc(), "category")).alias("place"), F.format_string("%s: %d (%d%%)", "category", "n", "percent").alias("text"))
    current = articles.where(~F.coalesce(F.col("is_duplicate"), F.lit(False)))
    split = feed.footprint_split(articles)
    in_time = [F.col("published").desc_nulls_last(), "id"]
    out = counts.select(F.lit("counts").alias("section"), F.col("place") + 1, "text").toDF("section", "place", "text")
    for part in (
        shares.select(F.lit("categories").alias("section"), "place", "text"),
        _listed(current.where(F.col("strategy") >= feed.HIGH_SIGNAL), "high signal", HIGH_SIGNAL_ROWS, [F.col("strategy").desc(), *in_time]),
        _listed(split.where("footprint = 'core'"), "core", CORE_ROWS, in_time),
        _listed(split.where("footprint = 'expansion'"), "expansion", EXPANSION_ROWS, in_time),
    ):
        out = out.unionByName(part)
    return out


SECTIONS = ("counts", "categories", "high signal", "core", "expansion")


def summary_mail(lines: DataFrame, title: str) -> tuple[str, str]:
    """HTML and plain text of a run's summary. The lists are capped and categories few; sending is the caller's."""
    got = lines.select("section", "place", "text", xml_escaped(F.col("text")).alias("html")).orderBy("place").collect()
    pages, plain = [], [title, ""]
    for section in SECTIONS:
        own = [r for r in got if r["section"] == section]
        if own:
            pages.append(f"<h3>{section}</h3><ul>" + "".join(f"<li>{r['html']}</li>" for r in own) + "</ul>")
            plain += [section.upper(), *(f"  {r['text']}" for r in own), ""]
    return f"<html><body><h2>{title}</h2>{''.join(pages)}</body></html>", "\n".join(plain)
