"""Queries on plants, facilities, cells and costs, with the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import geo
from ..operators import cells, feed, plants
from . import bindings as b

#: name: (query, SQL or None)
REGISTRY: dict = {}


def query(sql: str | None = None):
    def add(f):
        REGISTRY[f.__name__] = (f, sql)
        return f

    return add


_TECH_CASE = "CASE " + " ".join(f"WHEN technology IN ({', '.join(repr(m) for m in members)}) THEN '{g}'" for g, members in dims.TECH_GROUPS.items()) + f" ELSE '{dims.TECH_DEFAULT}' END"


@query(f"""WITH {b.GENERATORS_SQL}
SELECT plant_id, arg_min(plant_name, row_idx) AS plant_name, arg_min(state, row_idx) AS state, arg_min(county, row_idx) AS county, sum(mw) AS nameplate_mw, count(*) AS generator_count,
  round(coalesce(arg_min(lat, row_idx) FILTER (WHERE lat <> 0), 0), 6) AS lat, round(coalesce(arg_min(lon, row_idx) FILTER (WHERE lon <> 0), 0), 6) AS lon, array_to_string(list_sort(list(DISTINCT status)), ', ') AS eia_statuses
FROM generators GROUP BY plant_id""")
def plant_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return plants.plant_rollup(b.generators(spark, sf)).withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))


@query(f"""WITH {b.GENERATORS_SQL}, sums AS (SELECT plant_id, {_TECH_CASE} AS tech_group, sum(mw) AS mw FROM generators GROUP BY ALL)
SELECT plant_id, tech_group, mw FROM sums QUALIFY row_number() OVER (PARTITION BY plant_id ORDER BY mw DESC, tech_group) = 1""")
def plant_dominant_tech(spark: SparkSession, sf: str) -> DataFrame:
    return plants.dominant_tech(b.generators(spark, sf).withColumn("tech_group", plants.tech_group(F.col("technology"))))


def _sheets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = b.table(spark, sf, "orders").select(F.col("o_custkey").alias("plant_id"), "o_orderstatus", "o_totalprice")
    sheet = orders.groupBy("plant_id")
    return sheet.agg(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("mw")).where("mw is not null"), sheet.agg(F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("mw")).where("mw is not null")


_SHEETS_SQL = """operating AS (SELECT o_custkey AS plant_id, sum(o_totalprice) AS mw FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
planned AS (SELECT o_custkey AS plant_id, sum(o_totalprice) AS mw FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)"""


@query(f"WITH {_SHEETS_SQL} SELECT plant_id, round(mw, 2) AS mw FROM planned WHERE plant_id NOT IN (SELECT plant_id FROM operating)")
def planned_not_operating(spark: SparkSession, sf: str) -> DataFrame:
    operating, planned = _sheets(spark, sf)
    return plants.all_plants(operating, planned).where("pp_status = 'Planned'").select("plant_id", F.round("mw", 2).alias("mw"))


@query(f"""WITH {_SHEETS_SQL} SELECT plant_id, round(mw, 2) AS mw, 'Operational' AS pp_status FROM operating
UNION ALL SELECT plant_id, round(mw, 2), 'Planned' FROM planned WHERE plant_id NOT IN (SELECT plant_id FROM operating)""")
def plants_combined(spark: SparkSession, sf: str) -> DataFrame:
    return plants.all_plants(*_sheets(spark, sf)).withColumn("mw", F.round("mw", 2))


@query(f"WITH {_SHEETS_SQL} SELECT plant_id FROM operating INTERSECT SELECT plant_id FROM planned")
def plants_in_both(spark: SparkSession, sf: str) -> DataFrame:
    return plants.in_both(*_sheets(spark, sf))


def _cell_sql(r: str = "r") -> str:
    return f"concat_ws('-', {r}, CAST(floor((lat + 90) * pow(2.0, {r} - {geo.DEGREE})) AS BIGINT), CAST(floor((lon + 180) * pow(2.0, {r} - {geo.DEGREE})) AS BIGINT))"


_PLACED = "(SELECT *, unnest([3, 4, 5]) AS r FROM {0} WHERE NOT (lat = 0 AND lon = 0))"
_DC_SQL = f"""dc AS (SELECT r AS resolution, {_cell_sql()} AS cell, coalesce(sum(mw) FILTER (WHERE status = 'Operational'), 0) AS dc_operational_mw,
  coalesce(sum(mw) FILTER (WHERE status IN {dims.PIPELINE_STATUSES}), 0) AS dc_pipeline_mw, sum(mw) AS dc_total_mw FROM {_PLACED.format('facilities')} GROUP BY ALL)"""
_PP_SQL = f"""pp AS (SELECT r AS resolution, {_cell_sql()} AS cell, coalesce(sum(mw) FILTER (WHERE pp_status = 'Operational'), 0) AS pp_operational_mw,
  coalesce(sum(mw) FILTER (WHERE pp_status = 'Planned'), 0) AS pp_planned_mw, sum(mw) AS pp_total_mw FROM {_PLACED.format('plants')} GROUP BY ALL)"""
_CELLS_SQL = f"""{b.FACILITIES_SQL}, {b.PLANTS_SQL}, {_DC_SQL}, {_PP_SQL}, both_ AS (
  SELECT resolution, cell, round(dc_operational_mw, 6) AS dc_operational_mw, round(dc_pipeline_mw, 6) AS dc_pipeline_mw, round(dc_total_mw, 6) AS dc_total_mw,
    round(coalesce(pp_operational_mw, 0), 6) AS pp_operational_mw, round(coalesce(pp_planned_mw, 0), 6) AS pp_planned_mw, round(coalesce(pp_total_mw, 0), 6) AS pp_total_mw
  FROM dc FULL JOIN pp USING (resolution, cell))"""
_MW = ("dc_operational_mw", "dc_pipeline_mw", "dc_total_mw", "pp_operational_mw", "pp_planned_mw", "pp_total_mw")


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    both = cells.combined_cells(cells.facility_cells(b.facilities(spark, sf)), cells.plant_cells(b.plants(spark, sf)))
    # sums in any order must tie where they are equal
    return both.select("resolution", "cell", *(F.round(c, 6).alias(c) for c in _MW))


def _buckets(r: int):
    def f(spark: SparkSession, sf: str) -> DataFrame:
        return _cells(spark, sf).where(F.col("resolution") == r)

    f.__name__ = f"cell_mw_buckets_r{r}"
    return query(f"WITH {_CELLS_SQL} SELECT * FROM both_ WHERE resolution = {r}")(f)


for _r in cells.RESOLUTIONS:
    _buckets(_r)

#: Soil of the finest cells, from parts: class, fragments, depth and slope from key, size and price.
_SOIL_SQL = f"""soil AS (
  SELECT concat_ws('-', 6, p_partkey * 7 % 400 + 900, p_partkey * 13 % 900 + 450) AS cell, p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'soft' WHEN 1 THEN 'mixed' WHEN 2 THEN 'rock' END AS rock,
    CASE WHEN p_partkey % 9 <> 0 THEN p_size * 1.0 END AS fragments, CASE WHEN p_partkey % 11 <> 0 THEN (p_retailprice - 900) * 4 END AS depth, CASE WHEN p_partkey % 13 <> 0 THEN p_size / 4 END AS slope FROM part
), bore AS (
  SELECT *, CASE rock WHEN 'mixed' THEN {dims.BORE_BASE['mixed']}e0 WHEN 'rock' THEN {dims.BORE_BASE['rock']}e0 ELSE {dims.BORE_BASE['soft']}e0 END * {dims.BORE_DIAMETER}e0 * (1 + coalesce(fragments, 0) * {dims.BORE_SOIL}e0)
    * CASE WHEN depth IS NULL OR depth = 0 OR depth < 100 THEN 1.2 WHEN depth < 300 THEN 1.0 ELSE 0.92 END * CASE WHEN slope > 5 THEN 1 + (slope - 5) * {dims.BORE_SLOPE}e0 ELSE 1.0 END AS unit_cost_ft FROM soil)"""
_PARENT_SQL = """cost AS (
  SELECT r AS resolution, concat_ws('-', r, CAST(split_part(cell, '-', 2) AS BIGINT) >> (6 - r), CAST(split_part(cell, '-', 3) AS BIGINT) >> (6 - r)) AS cell, round(avg(unit_cost_ft), 6) AS bc_unit_cost_ft
  FROM (SELECT *, unnest([3, 4, 5]) AS r FROM bore) GROUP BY ALL)"""


def _bore(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    soil = b.table(spark, sf, "part").select(
        F.concat_ws("-", F.lit("6"), (k * 7 % 400 + 900).cast("string"), (k * 13 % 900 + 450).cast("string")).alias("cell"), "p_partkey", F.when(k % 4 == 0, "soft").when(k % 4 == 1, "mixed").when(k % 4 == 2, "rock").alias("rock"),
        F.when(k % 9 != 0, F.col("p_size") * 1.0).alias("fragments"), F.when(k % 11 != 0, (F.col("p_retailprice") - 900) * 4).alias("depth"), F.when(k % 13 != 0, F.col("p_size") / 4).alias("slope"),
    )
    return soil.withColumn("unit_cost_ft", cells.bore_cost(F.col("rock"), F.col("fragments"), F.col("depth"), F.col("slope")))


def _cost(spark: SparkSession, sf: str) -> DataFrame:
    return cells.parent_cost(_bore(spark, sf)).withColumn("bc_unit_cost_ft", F.round("bc_unit_cost_ft", 6))


@query(f"WITH {_SOIL_SQL} SELECT p_partkey, cell, round(unit_cost_ft, 6) AS unit_cost_ft FROM bore")
def bore_cost(spark: SparkSession, sf: str) -> DataFrame:
    return _bore(spark, sf).select("p_partkey", "cell", F.round("unit_cost_ft", 6).alias("unit_cost_ft"))


@query(f"""WITH {_SOIL_SQL} SELECT coalesce(rock, 'none') AS rock, count(*) AS n, round(avg(unit_cost_ft), 6) AS mean_cost, round(median(unit_cost_ft), 6) AS median_cost,
  round(min(unit_cost_ft), 6) AS least_cost, round(max(unit_cost_ft), 6) AS most_cost FROM bore GROUP BY 1""")
def bore_cost_by_class(spark: SparkSession, sf: str) -> DataFrame:
    c = "unit_cost_ft"
    rows = _bore(spark, sf).withColumn("rock", F.coalesce("rock", F.lit("none")))
    rest = rows.groupBy("rock").agg(F.count("*").alias("n"), F.round(F.avg(c), 6).alias("mean_cost"), F.round(F.min(c), 6).alias("least_cost"), F.round(F.max(c), 6).alias("most_cost"))
    median = cells.medians(rows, ["rock"], c, "median_cost").withColumn("median_cost", F.round("median_cost", 6))
    return rest.join(median, "rock").select("rock", "n", "mean_cost", "median_cost", "least_cost", "most_cost")


@query(f"WITH {_SOIL_SQL}, {_PARENT_SQL} SELECT * FROM cost")
def cost_parent_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _cost(spark, sf)


_FILLED_SQL = f"""{_CELLS_SQL}, {_SOIL_SQL}, {_PARENT_SQL}, filled AS (
  SELECT b.*, round(coalesce(c.bc_unit_cost_ft, m.m), 6) AS bc_unit_cost_ft FROM both_ b LEFT JOIN cost c USING (resolution, cell) LEFT JOIN (SELECT resolution, median(bc_unit_cost_ft) AS m FROM cost GROUP BY 1) m USING (resolution))"""


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    return cells.with_cost(_cells(spark, sf), _cost(spark, sf)).withColumn("bc_unit_cost_ft", F.round("bc_unit_cost_ft", 6))


@query(f"WITH {_FILLED_SQL} SELECT resolution, cell, bc_unit_cost_ft FROM filled")
def cost_median_fill(spark: SparkSession, sf: str) -> DataFrame:
    return _filled(spark, sf).select("resolution", "cell", "bc_unit_cost_ft")


def _rank_sql(c: str, name: str, turned: bool = False) -> str:
    pct = f"""CASE WHEN {c} IS NULL THEN NULL WHEN count({c}) OVER (PARTITION BY resolution) = 1 THEN 0.5 ELSE
    (rank() OVER (PARTITION BY resolution, {c} IS NULL ORDER BY {c}) - 1 + (count(*) OVER (PARTITION BY resolution, {c}) - 1) / 2) / (count({c}) OVER (PARTITION BY resolution) - 1) END"""
    return f"{'1 - ' if turned else ''}{pct} AS {name}"


_FEATURES_SQL = f"""{_FILLED_SQL}, features AS (
  SELECT *, {', '.join(_rank_sql(c, n, c == 'bc_unit_cost_ft') for c, n in cells.PERCENTILES.items())}, coalesce(dc_total_mw, 0) = 0 AND coalesce(pp_total_mw, 0) = 0 AS is_zero FROM filled)"""
_PCTS = tuple(cells.PERCENTILES.values())


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return cells.with_features(_filled(spark, sf))


@query(f"WITH {_FEATURES_SQL} SELECT resolution, cell, is_zero, {', '.join(f'round({c}, 9) AS {c}' for c in _PCTS)} FROM features")
def cell_features_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select("resolution", "cell", "is_zero", *(F.round(c, 9).alias(c) for c in _PCTS))


def _score_sql(weights: dict[str, int]) -> str:
    return "least(1, greatest(0, " + " + ".join(f"coalesce({c} * {w / 100}e0, 0)" for c, w in weights.items()) + "))"


def _composite(preset: str):
    weights = dims.PRESETS[preset]

    def f(spark: SparkSession, sf: str) -> DataFrame:
        return _features(spark, sf).select("resolution", "cell", F.round(cells.composite(weights), 9).alias("score"))

    f.__name__ = f"cell_composite_{preset}"
    return query(f"WITH {_FEATURES_SQL} SELECT resolution, cell, round({_score_sql(weights)}, 9) AS score FROM features")(f)


for _p in dims.PRESETS:
    _composite(_p)

_BAND_SQL = "CASE WHEN is_zero OR p IS NULL OR p <= 0 THEN '{0}' ".format(dims.EMPTY_COLOUR) + " ".join(f"WHEN p <= {round(0.11 * k, 2)} THEN '{c}'" for k, c in enumerate(dims.COLOURS[:-1], 1)) + f" ELSE '{dims.COLOURS[-1]}' END"
_NINTH_SQL = f"CASE WHEN is_zero OR p IS NULL OR p = 0 THEN '{dims.EMPTY_COLOUR}' ELSE {list(dims.COLOURS)}[CAST(least(8, floor(p * 9)) AS INT) + 1] END"


@query(f"WITH {_FEATURES_SQL}, s AS (SELECT *, round({_score_sql(dims.PRESETS['full'])}, 9) AS p FROM features) SELECT resolution, cell, {_BAND_SQL} AS band, {_NINTH_SQL} AS ninth FROM s")
def cell_colors(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    rows = _features(spark, sf).withColumn("p", F.round(cells.composite(dims.PRESETS["full"]), 9))
    return rows.select("resolution", "cell", cells.band_colour(p, F.col("is_zero")).alias("band"), cells.ninth_colour(p, F.col("is_zero")).alias("ninth"))


@query(f"""WITH {_FEATURES_SQL} SELECT resolution, count(*) AS n, CAST(count(bc_pct) AS BIGINT) AS with_cost, round(avg(CAST(is_zero AS INT)), 9) AS zero_share FROM features GROUP BY 1""")
def cell_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).groupBy("resolution").agg(F.count("*").alias("n"), F.count("bc_pct").alias("with_cost"), F.round(F.avg(F.col("is_zero").cast("int")), 9).alias("zero_share"))


_BOUNDS_SQL = "(VALUES " + ", ".join(f"('{s}', {w}e0, {so}e0, {e}e0, {n}e0)" for s, (w, so, e, n) in dims.BOUNDS.items()) + ") AS t(state, west, south, east, north)"


@query(f"""WITH {_CELLS_SQL}, c AS (SELECT DISTINCT cell, (CAST(split_part(cell, '-', 2) AS BIGINT) + 0.5) * pow(2.0, {geo.DEGREE} - resolution) - 90 AS lat, (CAST(split_part(cell, '-', 3) AS BIGINT) + 0.5) * pow(2.0, {geo.DEGREE} - resolution) - 180 AS lon FROM both_)
SELECT cell, state FROM c JOIN {_BOUNDS_SQL} ON lon BETWEEN west AND east AND lat BETWEEN south AND north""")
def cells_in_states(spark: SparkSession, sf: str) -> DataFrame:
    return cells.cells_in_states(_cells(spark, sf), dims.bounds(spark))


@query(f"""WITH {_CELLS_SQL}, c AS (SELECT DISTINCT cell, resolution, CAST(split_part(cell, '-', 2) AS BIGINT) AS y, CAST(split_part(cell, '-', 3) AS BIGINT) AS x, pow(2.0, {geo.DEGREE} - resolution) AS w FROM both_)
SELECT cell, y * w - 90 AS south, (y + 1) * w - 90 AS north, x * w - 180 AS west, (x + 1) * w - 180 AS east FROM c""")
def cell_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    corners = _cells(spark, sf).select("cell", geo.grid_boundary(F.col("cell")).alias("p"))
    return corners.select("cell", F.col("p")[0]["lat"].alias("south"), F.col("p")[2]["lat"].alias("north"), F.col("p")[0]["lon"].alias("west"), F.col("p")[2]["lon"].alias("east"))


_H3 = [("85283473fffffff",), ("8528347bfffffff",), ("852a1073fffffff",), ("86283472fffffff",), ("8a2a1072b59ffff",)]


#: Ids made from customers' keys: resolutions 5 to 10, all base cells, digits 0 to 3.
_DIGITS = int("3" * 15, 8)
_MADE_H3_SQL = f"""SELECT lower(printf('%x', (1::BIGINT << 59) | (r << 52) | ((c_custkey % 122) << 45) | ((c_custkey * 1000003) & {_DIGITS}) | ((1::BIGINT << ((15 - r) * 3)) - 1))) AS cell FROM (SELECT *, 5 + c_custkey % 6 AS r FROM customer)"""


def _h3_ids(spark: SparkSession, sf: str) -> DataFrame:
    k, r = F.col("c_custkey"), F.col("r")
    fine = F.expr("shiftleft(1L, cast((15 - r) * 3 AS int)) - 1")
    parts = F.lit(1 << 59).bitwiseOR(r * (1 << 52)).bitwiseOR(k % 122 * (1 << 45)).bitwiseOR((k * 1000003).bitwiseAND(F.lit(_DIGITS))).bitwiseOR(fine)
    made = b.table(spark, sf, "customer").select(k, (k % 6 + 5).alias("r")).select(F.lower(F.hex(parts)).alias("cell"))
    return b.inline(spark, _H3, "cell string").unionByName(made)


@query("SELECT cell, r AS resolution, lower(printf('%x', (CAST(concat('0x', cell) AS BIGINT) & ~(15::BIGINT << 52)) | (r::BIGINT << 52) | ((1::BIGINT << ((15 - r) * 3)) - 1))) AS parent FROM (SELECT * FROM " + b.values_sql(_H3, "cell string") + " UNION ALL " + _MADE_H3_SQL + "), (SELECT unnest([3, 4]) AS r)")
def h3_parent_bits(spark: SparkSession, sf: str) -> DataFrame:
    rows = _h3_ids(spark, sf)
    three, four = (rows.select("cell", F.lit(r).alias("resolution"), geo.h3_parent(F.col("cell"), r).alias("parent")) for r in (3, 4))
    return three.unionByName(four)


_EXTENTS_SQL = "SELECT 'facilities in ' || state AS state, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM facilities WHERE NOT (lat = 0 AND lon = 0) GROUP BY state"


@query(f"WITH {b.FACILITIES_SQL} SELECT state, round(greatest(4, least(7, 7 - log2(greatest(east - west, north - south)))), 6) AS zoom, round((west + east) / 2, 6) AS lon, round((south + north) / 2, 6) AS lat FROM (SELECT * FROM {_BOUNDS_SQL} UNION ALL {_EXTENTS_SQL})")
def state_viewports(spark: SparkSession, sf: str) -> DataFrame:
    """Of the states' boxes, and of the boxes that facilities fill in each state."""
    box = [F.col(c) for c in ("west", "south", "east", "north")]
    filled = cells.with_coordinates(b.facilities(spark, sf)).groupBy(F.concat(F.lit("facilities in "), "state").alias("state"))
    filled = filled.agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
    return dims.bounds(spark).select("state", "west", "south", "east", "north").unionByName(filled).select("state", F.round(geo.viewport_zoom(*box), 6).alias("zoom"), F.round((F.col("west") + F.col("east")) / 2, 6).alias("lon"), F.round((F.col("south") + F.col("north")) / 2, 6).alias("lat"))


_CHOSEN = {"status": ["Operational", "Planned", "Under Construction"], "company_type": ["BUILDING", "MACHINERY", "AUTOMOBILE"]}
_CHOSEN_SQL = " AND ".join(f"{c} IN {tuple(v)}" for c, v in _CHOSEN.items()) + " AND state IN ('VA', 'TX', 'AZ')"


@query(f"WITH {b.FACILITIES_SQL} SELECT count(*) AS n, round(coalesce(sum(mw), 0), 4) AS total FROM facilities WHERE {_CHOSEN_SQL}")
def facet_kpis(spark: SparkSession, sf: str) -> DataFrame:
    rows = feed.facet_filter(b.facilities(spark, sf), _CHOSEN, ["VA", "TX", "AZ"])
    return feed.kpis(rows, "mw").withColumn("total", F.round("total", 4))


@query(f"WITH {b.FACILITIES_SQL} " + " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM facilities GROUP BY ALL" for c in ("status", "company_type", "state")))
def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return feed.facet_counts(b.facilities(spark, sf), "status", "company_type", "state")


@query(f"WITH {b.FACILITIES_SQL} SELECT status, CAST(list_position({list(dims.STATUSES)}, status) AS BIGINT) AS place, count(*) AS n, round(sum(mw), 4) AS mw FROM facilities GROUP BY ALL")
def facilities_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return feed.status_order(b.facilities(spark, sf), "status", dims.STATUSES).groupBy("status", "place").agg(F.count("*").alias("n"), F.round(F.sum("mw"), 4).alias("mw"))


@query(f"WITH {b.FACILITIES_SQL} SELECT asset_id, greatest(3, least(20, CAST(trunc(pow(mw, 0.4)) AS INT))) AS radius FROM facilities")
def marker_radius(spark: SparkSession, sf: str) -> DataFrame:
    return b.facilities(spark, sf).select("asset_id", F.greatest(F.lit(3), F.least(F.lit(20), F.pow("mw", F.lit(0.4)).cast("int"))).alias("radius"))


