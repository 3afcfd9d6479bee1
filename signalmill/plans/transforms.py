"""Raw tables to the tables that reports read, and the chain from points to cell features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..dims import STATUSES, UNCLASSIFIED, UNKNOWN_STATUS, centroids
from ..functions import parse
from ..operators import cells, links, plants
from ..sources.readers import ORDER


def _place(raw: DataFrame) -> Column:
    """The place of a row in its source, which the reader gives."""
    if ORDER not in raw.columns:
        raise ValueError(f"the order of the rows is needed: read them with {ORDER}")
    return F.col(ORDER)


def facility_points(raw: DataFrame) -> DataFrame:
    """Facilities from text columns; those at 0, 0 are left out."""
    schemas.require(raw.columns, list(schemas.FACILITY), "the facility table")
    read = {
        "text": F.col, "number": lambda c: parse.facility_number(F.col(c)), "status": lambda c: parse.first_status(parse.facility_list(F.col(c)), STATUSES, UNKNOWN_STATUS), "type": lambda c: parse.first_type(parse.facility_list(F.col(c)), UNCLASSIFIED),
    }
    out = raw.select(*(read[how](f"`{c}`" if " " in c else c).alias(name) for c, (name, how) in schemas.FACILITY.items()))
    return cells.with_coordinates(out)


def generator_table(raw: DataFrame) -> DataFrame:
    """A sheet's generators with source order, numbers (blank: null) and technology groups; blank plant ids are null."""
    schemas.require(raw.columns, list(schemas.GENERATOR), "the generator sheet")
    out = raw.select(*(F.col(f"`{c}`").alias(name) for c, name in schemas.GENERATOR.items()), _place(raw).alias(ORDER))
    for c in ("mw", "lat", "lon"):
        out = out.withColumn(c, parse.generator_number(F.col(c)))
    return out.withColumn("plant_id", F.nullif(parse.strip(F.col("plant_id")), F.lit(""))).withColumn("tech_group", plants.tech_group(F.coalesce("technology", F.lit(""))))


def plant_points(operating: DataFrame, planned: DataFrame) -> DataFrame:
    """Plants of both sheets, operating ones first; plants at 0, 0 are left out, those without coordinates stay."""
    def rolled(raw: DataFrame) -> DataFrame:
        generators = generator_table(raw)
        return plants.plant_rollup(generators).join(plants.dominant_tech(generators).select("plant_id", "tech_group"), "plant_id")

    both = plants.all_plants(rolled(operating), rolled(planned))
    return both.where(~F.coalesce((F.col("lat") == 0) & (F.col("lon") == 0), F.lit(False)))


def typed_feed(raw: DataFrame) -> DataFrame:
    """The feed with dates, lists, scores and flags in their types, in source order."""
    schemas.require(raw.columns, list(schemas.NEWS_FEED), "the feed")
    return raw.select(
        F.col("ID").alias("id"), F.col("Title").alias("title"), F.col("CleanURL").alias("url"), F.col("Source").alias("source"), parse.any_date(F.col("PublishedDate")).alias("published"), F.col("Summary_AI").alias("summary"),
        F.col("Primary_Category").alias("category"), F.filter(F.transform(F.split("Secondary_Categories", ";"), parse.strip), lambda x: x != "").alias("secondary"), parse.article_list(F.col("States")).alias("states"), parse.article_list(F.col("DC_ID")).alias("dc_ids"),
        parse.is_true(F.col("Is_Duplicate")).alias("is_duplicate"), F.col("Duplicate_Of").alias("duplicate_of"), parse.integer_or_zero(F.col("Strategy_Alignment_Score")).alias("strategy"), parse.integer_or_zero(F.col("Relevance_Score")).alias("relevance"),
        parse.is_true(F.col("Mentions_Specific_DC")).alias("mentions"), F.col("Article_Text").alias("text"), _place(raw).alias(ORDER),
    ).withColumn("tagged", F.size("dc_ids") > 0)


_LINK = ("id", "title", "url", "source", "published", "category", "summary")


def facility_links(feed: DataFrame) -> DataFrame:
    """article x facility, of all rows, duplicates too."""
    return links.linked(feed).select(*_LINK, F.trim("dc_id").alias("dc_id"), "row_idx")


def state_links(feed: DataFrame) -> DataFrame:
    """article x state with its centroid, of articles without facility; unknown states are left out."""
    return links.state_linked(feed, centroids(feed.sparkSession)).select(*_LINK, "state", F.col("lat").alias("state_lat"), F.col("lon").alias("state_lon"), "row_idx")


def soil_costs(raw: DataFrame) -> DataFrame:
    """cell and unit_cost_ft of the finest cells."""
    schemas.require(raw.columns, list(schemas.SOIL), "the soil table")
    soil = raw.select(*(F.col(c).alias(n) for c, n in schemas.SOIL.items()))
    for c in ("fragments", "slope", "depth"):
        soil = soil.withColumn(c, parse.null_if_nan(F.col(c).try_cast("double")))
    return soil.select("cell", cells.bore_cost(F.col("rock"), F.col("fragments"), F.col("depth"), F.col("slope")).alias("unit_cost_ft"))


def cell_features(facilities: DataFrame, plant_table: DataFrame, parent_costs: DataFrame) -> DataFrame:
    """The wide table of all resolutions in one plan: sums, cost, percentiles and empty marks. ``parent_costs`` is ``cells.parent_cost`` of soil costs on grid cells."""
    dc = cells.facility_cells(facilities.select("status", "lat", "lon", F.col("estimated_mw").alias("mw")))
    pp = cells.plant_cells(plant_table.select("pp_status", "lat", "lon", F.col("nameplate_mw").alias("mw")))
    return cells.with_features(cells.with_cost(cells.combined_cells(dc, pp), parent_costs))
