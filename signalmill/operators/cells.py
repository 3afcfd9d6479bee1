"""Cells: bucket sums at several resolutions, tie-aware percentiles, bore cost and composite scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dims import BORE_BASE, BORE_DIAMETER, BORE_SLOPE, BORE_SOIL, COLOURS, EMPTY_COLOUR, PIPELINE_STATUSES
from ..functions.geo import grid_cell, grid_centre, grid_parent
from ..functions.parse import null_if_nan

RESOLUTIONS = (3, 4, 5)


def with_coordinates(points: DataFrame) -> DataFrame:
    """Without points that lie at 0, 0 or nowhere; a single 0 is a place."""
    return points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~((F.col("lat") == 0) & (F.col("lon") == 0)))


def bucket_sums(points: DataFrame, value: str, buckets: dict[str, Column]) -> DataFrame:
    """resolution, cell and a sum of ``value`` for each bucket's condition, in one pass over all resolutions."""
    at = with_coordinates(points).withColumn("resolution", F.explode(F.array(*(F.lit(r) for r in RESOLUTIONS))))
    at = at.withColumn("cell", grid_cell(F.col("lat"), F.col("lon"), F.col("resolution")))
    sums = [F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0.0)).alias(name) for name, condition in buckets.items()]
    return at.groupBy("resolution", "cell").agg(*sums)


def facility_cells(facilities: DataFrame) -> DataFrame:
    status = F.col("status")
    return bucket_sums(facilities, "mw", {"dc_operational_mw": status == "Operational", "dc_pipeline_mw": status.isin(*PIPELINE_STATUSES), "dc_total_mw": F.lit(True)})


def plant_cells(plants: DataFrame) -> DataFrame:
    status = F.col("pp_status")
    return bucket_sums(plants, "mw", {"pp_operational_mw": status == "Operational", "pp_planned_mw": status == "Planned", "pp_total_mw": F.lit(True)})


def combined_cells(dc: DataFrame, pp: DataFrame) -> DataFrame:
    """All cells of either side. Plant columns are 0 where there is no plant; facility columns stay null where there is no facility."""
    columns = [c for c in pp.columns if c.startswith("pp_")]
    return dc.join(pp, ["resolution", "cell"], "full").fillna(0.0, columns)


def bore_cost(rock: Column, fragments: Column, depth: Column, slope: Column) -> Column:
    """Cost a foot from rock class, fragments in percent, depth to bedrock in cm, and slope in percent."""
    base = F.coalesce(*(F.when(rock == name, F.lit(cost)) for name, cost in BORE_BASE.items()), F.lit(BORE_BASE["soft"]))
    soil = 1 + F.coalesce(null_if_nan(fragments), F.lit(0.0)) * BORE_SOIL
    bedrock = F.when(depth.isNull() | (depth == 0) | (depth < 100), 1.2).when(depth < 300, 1.0).otherwise(0.92)
    incline = F.when(slope > 5, 1 + (slope - 5) * BORE_SLOPE).otherwise(1.0)
    return base * BORE_DIAMETER * soil * bedrock * incline


def parent_cost(fine: DataFrame) -> DataFrame:
    """resolution, cell, bc_unit_cost_ft: mean cost of the fine cells in each parent."""
    at = fine.withColumn("resolution", F.explode(F.array(*(F.lit(r) for r in RESOLUTIONS))))
    return at.withColumn("cell", grid_parent(F.col("cell"), F.col("resolution"))).groupBy("resolution", "cell").agg(F.avg("unit_cost_ft").alias("bc_unit_cost_ft"))


def with_cost(cells: DataFrame, cost: DataFrame) -> DataFrame:
    """Cells with their cost; where there is none, the median over all cells of the cost table at that resolution."""
    median = medians(cost, ["resolution"], "bc_unit_cost_ft", "median_")
    out = cells.join(cost, ["resolution", "cell"], "left").join(median, "resolution", "left")
    return out.withColumn("bc_unit_cost_ft", F.coalesce("bc_unit_cost_ft", "median_")).drop("median_")


#: Ranges of values in each doubling of their size.
RANGES_A_DOUBLING = 256


def _range_of(value: Column) -> Column:
    """A whole number that doesn't fall where the value rises: ranges that are finer for small values. NaN is above all others."""
    step = F.floor(F.signum(value) * F.log2(F.abs(value) + 1) * RANGES_A_DOUBLING)
    return F.when(F.isnan(value), F.lit(1 << 40)).when(F.abs(value) > 1e300, F.signum(value).cast("long") * (1 << 39)).otherwise(step)


def with_running(rows: DataFrame, group: list[str], value: str, n: str) -> DataFrame:
    """``rows`` (distinct values of a group, with ``n``) with ``below_``, the sum of n of the group's smaller values, and ``total_``.

    Values are cut into ranges; the sums of ranges are cumulated and the values in one range sorted, so a group is spread over many tasks.
    """
    by = [*group, "range_"]
    cut = rows.withColumn("range_", _range_of(F.col(value)))
    sums = cut.groupBy(*by).agg(F.sum(n).alias("sum_"))
    ranges = Window.partitionBy(*group).orderBy("range_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.select(*by, (F.sum("sum_").over(ranges) - F.col("sum_")).alias("before_"), F.sum("sum_").over(Window.partitionBy(*group)).alias("total_"))
    inside = F.sum(n).over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(n)
    return cut.withColumn("below_", inside).join(sums, by).withColumn("below_", F.col("below_") + F.col("before_")).drop("range_", "before_")


#: Parts into which a range of values is cut when the middle is looked for in it.
PARTS_OF_A_RANGE = 1024


def _part_of(value: Column, low: Column, high: Column) -> Column:
    """A whole number that doesn't fall where the value rises, from 0 at ``low`` to PARTS_OF_A_RANGE - 1 at ``high``; infinite ends are parts of their own."""
    inner = F.nanvl((value - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.5)) * (PARTS_OF_A_RANGE - 3) + 1
    middle = F.least(F.lit(PARTS_OF_A_RANGE - 2.0), F.floor(F.coalesce(inner, F.lit(1.0))))
    return F.when((value == low) | F.isnan(value), 0).when(value == high, PARTS_OF_A_RANGE - 1).otherwise(middle.cast("int"))


def _around_middle(counts: DataFrame, by: list[str], step: str, before: Column) -> DataFrame:
    """Of ``counts`` (by, step, n_, total_) the steps that hold a middle row, with the number of rows below them (``before``, and those of smaller steps)."""
    order = Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = before + F.sum("n_").over(order) - F.col("n_")
    low, high = F.floor((F.col("total_") - 1) / 2), F.floor(F.col("total_") / 2)
    return counts.withColumn("below_", below).where((F.col("below_") <= high) & (F.col("below_") + F.col("n_") > low))


def medians(rows: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """The exact median of each group's values that aren't null (mean of the middle two of an even number; NaN is above all others).

    Rows are counted by range of values, the range that holds the middle is counted by part, and only the part that holds the middle is
    counted by value and sorted. All three are partial aggregates, so neither a group nor its distinct values meet in one buffer.
    """
    at = rows.select(*group, F.col(value).cast("double").alias("value_")).where("value_ is not null").withColumn("range_", _range_of(F.col("value_")))
    by = [*group, "range_"]
    ranges = at.groupBy(*by).agg(F.count("*").alias("n_"), F.min("value_").alias("low_"), F.max("value_").alias("high_"))
    ranges = ranges.withColumn("total_", F.sum("n_").over(Window.partitionBy(*group)))
    first = _around_middle(ranges, group, "range_", F.lit(0)).select(*by, "low_", "high_", "total_", F.col("below_").alias("before_"))
    inside = at.join(first, by).withColumn("part_", _part_of(F.col("value_"), F.col("low_"), F.col("high_")))
    parts = inside.groupBy(*by, "part_", "total_", "before_").agg(F.count("*").alias("n_"))
    second = _around_middle(parts, by, "part_", F.col("before_")).select(*by, "part_", F.col("below_").alias("within_"))
    values = inside.join(second, [*by, "part_"]).groupBy(*by, "part_", "value_", "total_", "within_").agg(F.count("*").alias("n_"))
    middle = _around_middle(values, [*by, "part_"], "value_", F.col("within_"))
    return middle.groupBy(*group).agg(((F.min("value_") + F.max("value_")) / 2).alias(name))


def percentile(rows: DataFrame, group: list[str], key: list[str], values: dict[str, str]) -> DataFrame:
    """``rows`` with a column for each of ``values`` (value column: name): (average rank - 1) / (n - 1) among those of the
    group that aren't null; 0.5 where there is one; null stays null. ``key`` tells the rows of a group apart.

    All columns are ranked in one go: ranks come from the counts of distinct values (pre-aggregated, then
    cumulated by ``with_running``), so no task sorts the rows of a group or all of its distinct values.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name_"), F.col(c).cast("double").alias("value_")) for c, n in values.items())))
    long = rows.select(*group, *key, pairs.alias("p_")).select(*group, *key, "p_.*").where("value_ is not null")
    counts = long.groupBy(*group, "name_", "value_").agg(F.count("*").alias("n_"))
    running = with_running(counts, [*group, "name_"], "value_", "n_")
    rank = F.when(F.col("total_") == 1, F.lit(0.5)).otherwise((F.col("below_") + (F.col("n_") - 1) / 2) / (F.col("total_") - 1))
    ranks = running.select(*group, "name_", "value_", rank.alias("rank_"))
    wide = long.join(ranks, [*group, "name_", "value_"]).groupBy(*group, *key).agg(*(F.max(F.when(F.col("name_") == n, F.col("rank_"))).alias(n) for n in values.values()))
    return rows.join(wide, [*group, *key], "left")


PERCENTILES = {
    "dc_operational_mw": "dc_operational_pct", "dc_pipeline_mw": "dc_pipeline_pct", "dc_total_mw": "dc_total_pct",
    "pp_operational_mw": "pp_operational_pct", "pp_planned_mw": "pp_planned_pct", "pp_total_mw": "pp_total_pct", "bc_unit_cost_ft": "bc_pct",
}


def with_features(cells: DataFrame) -> DataFrame:
    """All percentiles by resolution (that of the cost turned round: easy ground is high) and the mark of empty cells."""
    out = percentile(cells, ["resolution"], ["cell"], PERCENTILES).withColumn("bc_pct", 1 - F.col("bc_pct"))
    return out.withColumn("is_zero", (F.coalesce("dc_total_mw", F.lit(0.0)) == 0) & (F.coalesce("pp_total_mw", F.lit(0.0)) == 0))


def composite(weights: dict[str, float]) -> Column:
    """Weighted score from 0 to 1; weights are in hundredths, missing terms count nothing."""
    terms = [F.coalesce(null_if_nan(F.col(c)) * (w / 100), F.lit(0.0)) for c, w in weights.items()]
    total = terms[0] if terms else F.lit(0.0)
    for t in terms[1:]:
        total = total + t
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), total))


def band_colour(pct: Column, empty: Column) -> Column:
    """Bands of 0.11, their upper ends included; the last reaches to 1."""
    out = F.when(empty | pct.isNull() | (pct <= 0), EMPTY_COLOUR)
    for k, colour in enumerate(COLOURS[:-1], 1):
        out = out.when(pct <= round(0.11 * k, 2), colour)
    return out.otherwise(COLOURS[-1])


def ninth_colour(pct: Column, empty: Column) -> Column:
    """Ninths, their lower ends included."""
    index = F.least(F.lit(8), F.floor(pct * 9).cast("int"))
    return F.when(empty | pct.isNull() | (pct == 0), EMPTY_COLOUR).otherwise(F.get(F.array(*(F.lit(c) for c in COLOURS)), index))


def cells_in_states(cells: DataFrame, boxes: DataFrame) -> DataFrame:
    """cell and state of every cell whose centre lies in a state's box, borders included. The 51 boxes are broadcast."""
    lat, lon = grid_centre(F.col("cell"))
    at = cells.select("cell").distinct().withColumn("lat_", lat).withColumn("lon_", lon)
    inside = (F.col("lon_") >= F.col("west")) & (F.col("lon_") <= F.col("east")) & (F.col("lat_") >= F.col("south")) & (F.col("lat_") <= F.col("north"))
    return at.join(F.broadcast(boxes), inside).select("cell", "state")
