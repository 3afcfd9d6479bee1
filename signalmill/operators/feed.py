"""The article feed: digest, work queues, metrics, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import footprint

DIGEST_SCORE, DIGEST_ROWS, DIGEST_DAYS = 7, 10, 7
HIGH_SIGNAL = 4


def week(articles: DataFrame, end: str) -> DataFrame:
    """Articles of the seven days up to ``end`` that are no duplicates, with day and combined score."""
    day = F.to_date("published")
    inside = day.between(F.date_sub(F.lit(end).cast("date"), DIGEST_DAYS - 1), F.lit(end).cast("date"))
    return articles.where(~F.coalesce(F.col("is_duplicate"), F.lit(False)) & inside).withColumn("day", day).withColumn("score", F.col("strategy") + F.col("relevance"))


def _top(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.col("score").desc(), F.col("published").desc(), "id").limit(n)


def tagged_stories(articles: DataFrame, end: str) -> DataFrame:
    """The ten best articles of the week with a facility and a score of 7 or more."""
    return _top(week(articles, end).where(F.col("tagged") & (F.col("score") >= DIGEST_SCORE)), DIGEST_ROWS)


def other_stories(articles: DataFrame, end: str) -> DataFrame:
    """The ten best with a score of 7 or more of what ``tagged_stories`` leaves, its eleventh and later included."""
    shown = tagged_stories(articles, end).select("id")
    return _top(week(articles, end).where(F.col("score") >= DIGEST_SCORE).join(shown, "id", "left_anti"), DIGEST_ROWS)


def by_priority(articles: DataFrame, order: str = "row_idx") -> DataFrame:
    """All articles with a category, by falling priority (both scores, cut to hundredths), ties in source order."""
    rows = articles.where(F.trim(F.coalesce("category", F.lit(""))) != "").withColumn("priority", F.round(F.col("strategy") + F.col("relevance"), 2))
    return rows.orderBy(F.col("priority").desc(), order)


def pending(staged: DataFrame, stage: str) -> DataFrame:
    """Rows of the work queue that a stage takes up: extract, summarise or classify."""
    filled = (F.coalesce("article_text", F.lit("")) != "") | (F.coalesce("rss_description", F.lit("")) != "")
    condition = {
        "extract": F.col("extraction_status") == "pending",
        "summarise": (F.col("summarize_status") == "pending") & F.col("extraction_status").isin("success", "fallback") & filled,
        "classify": (F.col("classify_status") == "pending") & (F.col("summarize_status") == "success") & (F.coalesce("summary_ai", F.lit("")) != ""),
    }
    return staged.where(condition[stage])


def transition(staged: DataFrame, results: DataFrame, column: str, result: str = "result") -> DataFrame:
    """Statuses of one stage after its results (article_id, result) came in; rows without one stay as they are. (Update by id: left join, then coalesce.)"""
    got = results.select("article_id", F.col(result).alias("got_"))
    return staged.join(got, "article_id", "left").withColumn(column, F.coalesce("got_", column)).drop("got_")


def promote(staged: DataFrame, unprocessed_at_start: DataFrame) -> DataFrame:
    """Processed is Yes for classified or duplicate rows whose id was unprocessed when the run began."""
    ids = unprocessed_at_start.select("article_id", F.lit(True).alias("known_"))
    done = F.col("known_") & ((F.col("classify_status") == "success") | (F.col("extraction_status") == "duplicate"))
    return staged.join(ids, "article_id", "left").withColumn("Processed", F.when(done, "Yes").otherwise(F.col("Processed"))).drop("known_")


def unexpired(rows: DataFrame, at: str, now: Column, days: int, strict: bool = False) -> DataFrame:
    """Rows of the last ``days`` days before ``now``; the limit itself counts unless ``strict``."""
    limit = now - F.make_dt_interval(days=F.lit(days))
    return rows.where(F.col(at) > limit if strict else F.col(at) >= limit)


def prune_staged(staged: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Only classified rows that were staged more than ``days`` ago go; without a date they stay."""
    old = F.col("staged_at") < now - F.make_dt_interval(days=F.lit(days))
    return staged.where(~F.coalesce(old & (F.col("classify_status") == "success"), F.lit(False)))


def run_metrics(staged: DataFrame) -> DataFrame:
    """Counts by status in one pass."""
    def n(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value).alias(f"{column.split('_')[0]}_{value}")

    return staged.agg(F.count("*").alias("staged"), n("extraction_status", "success"), n("extraction_status", "fallback"), n("extraction_status", "failed"), n("extraction_status", "duplicate"), n("summarize_status", "success"), n("classify_status", "success"), n("classify_status", "failed"))


def histogram(feed: DataFrame, column: str) -> DataFrame:
    """Counts by value, most first, and whole percents (half to even) of all counted; duplicates and blanks left out."""
    counts = feed.where(~F.coalesce(F.col("is_duplicate"), F.lit(False)) & (F.trim(F.coalesce(column, F.lit(""))) != "")).groupBy(column).agg(F.count("*").alias("n"))
    total = F.greatest(F.sum("n").over(Window.partitionBy()), F.lit(1))
    return counts.withColumn("percent", F.bround(100 * F.col("n") / total, 0).cast("int"))


def footprint_split(feed: DataFrame) -> DataFrame:
    """Articles that are no duplicates and name a core state, else an expansion state."""
    return feed.where(~F.coalesce(F.col("is_duplicate"), F.lit(False))).withColumn("footprint", footprint(F.col("states"))).where("footprint is not null")


def high_signal(feed: DataFrame, cap: int = 20) -> DataFrame:
    return feed.where(F.col("strategy") >= HIGH_SIGNAL).orderBy(F.col("strategy").desc(), F.col("published").desc(), "id").limit(cap)


def facet_filter(rows: DataFrame, chosen: dict[str, list[str]], states: list[str] | None = None) -> DataFrame:
    """Rows whose facets are all among the chosen values; no chosen state means any."""
    for column, values in chosen.items():
        rows = rows.where(F.col(column).isin(*values))
    return rows.where(F.col("state").isin(*states)) if states else rows


def kpis(rows: DataFrame, value: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).alias("total"))


def facet_counts(rows: DataFrame, *columns: str) -> DataFrame:
    """facet, value and count of each column's values; null and blank values are none."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("p")).select("p.*").where("trim(value) <> ''").groupBy("facet", "value").agg(F.count("*").alias("n"))


def drawer(feed: DataFrame, today: Column, days: int = 0, category: str | None = None, states: list[str] | None = None) -> DataFrame:
    """Articles of a category, of states and of the last ``days`` days (0: all, but undated ones only then)."""
    if category:
        feed = feed.where(F.col("category") == category)
    if states:
        feed = feed.where(F.arrays_overlap("states", F.array(*(F.lit(s) for s in states))))
    return feed.where(F.to_date("published") >= F.date_sub(today, days)) if days else feed


def status_order(rows: DataFrame, column: str, order: tuple[str, ...]) -> DataFrame:
    """``place``: the position of a status in a fixed order (0 if it has none)."""
    return rows.withColumn("place", F.array_position(F.array(*(F.lit(s) for s in order)), F.col(column)))


def staged_on(staged: DataFrame, day: str) -> DataFrame:
    """Rows that were staged on a day."""
    return staged.where(F.to_date("staged_at") == F.lit(day).cast("date"))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """Counts by value, most first, ties by value."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)


def first_rows(rows: DataFrame, n: int, order: str = "row_idx") -> DataFrame:
    """The first n rows in source order."""
    return rows.orderBy(order).limit(n)
