"""The driver's tables in the roles of this library's tables, and small inline tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import STATUSES

STATES = ("VA", "TX", "AZ", "GA", "CA", "OH", "OR", "IL")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql_value(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(_sql_value(x) for x in v) + "]"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


def values_sql(rows: list[tuple], schema: str) -> str:
    """A subquery with the rows of an inline table."""
    types = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    body = ", ".join("(" + ", ".join(_sql_value(v) for v in r) + ")" for r in rows)
    columns = ", ".join(f"CAST({n} AS {types[t]}) AS {n}" for n, t in fields)
    return f"(SELECT {columns} FROM (VALUES {body}) AS t({', '.join(n for n, _ in fields)}))"


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(list(v) if isinstance(v, tuple) else v for v in r) for r in rows], schema)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as articles: two scores from value and props, purchases are tagged, every eleventh is a duplicate."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("published"), F.col("user_id"), F.col("event_type").alias("category"), (F.col("value").cast("int") % 5 + 1).alias("strategy"), (k % 5 + 1).alias("relevance"),
        (F.col("event_type") == "purchase").alias("tagged"), (F.col("event_id") % 11 == 0).alias("is_duplicate"), F.get(F.array(*(F.lit(s) for s in STATES)), (F.col("user_id") % len(STATES)).cast("int")).alias("state"),
    )


_STATES_SQL = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
ARTICLES_SQL = f"""articles AS (
  SELECT event_id AS id, ts AS published, user_id, event_type AS category, CAST(trunc(value) AS BIGINT) % 5 + 1 AS strategy, CAST(props ->> '$.k' AS INT) % 5 + 1 AS relevance,
    event_type = 'purchase' AS tagged, event_id % 11 = 0 AS is_duplicate, {_STATES_SQL}[CAST(user_id % {len(STATES)} AS INT) + 1] AS state FROM events)"""


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as facilities, with places, statuses and capacities made from their keys; every 50th lies at 0, 0."""
    k = F.col("c_custkey")
    lost = k % 50 == 0
    return table(spark, sf_dir, "customer").select(
        k.alias("asset_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("company_type"), F.get(F.array(*(F.lit(s) for s in STATUSES)), (k % len(STATUSES)).cast("int")).alias("status"),
        F.get(F.array(*(F.lit(s) for s in STATES)), (k % len(STATES)).cast("int")).alias("state"), (F.abs(F.col("c_acctbal")) / 10).alias("mw"),
        F.when(lost, 0.0).otherwise(25 + (k * 7 % 240) / 10).alias("lat"), F.when(lost, 0.0).otherwise(-124 + (k * 13 % 570) / 10).alias("lon"),
    )


_STATUS_SQL = "[" + ", ".join(f"'{s}'" for s in STATUSES) + "]"
FACILITIES_SQL = f"""facilities AS (
  SELECT c_custkey AS asset_id, c_name AS name, c_mktsegment AS company_type, {_STATUS_SQL}[CAST(c_custkey % {len(STATUSES)} AS INT) + 1] AS status, {_STATES_SQL}[CAST(c_custkey % {len(STATES)} AS INT) + 1] AS state,
    abs(c_acctbal) / 10 AS mw, CASE WHEN c_custkey % 50 = 0 THEN 0.0 ELSE 25 + (c_custkey * 7 % 240) / 10 END AS lat, CASE WHEN c_custkey % 50 = 0 THEN 0.0 ELSE -124 + (c_custkey * 13 % 570) / 10 END AS lon FROM customer)"""


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as plants, two of three operational."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("plant_id"), F.when(k % 3 == 0, "Planned").otherwise("Operational").alias("pp_status"), (F.abs(F.col("s_acctbal")) / 5).alias("mw"), (25 + (k * 11 % 240) / 10).alias("lat"), (-124 + (k * 17 % 570) / 10).alias("lon"),
    )


PLANTS_SQL = """plants AS (
  SELECT s_suppkey AS plant_id, CASE WHEN s_suppkey % 3 = 0 THEN 'Planned' ELSE 'Operational' END AS pp_status, abs(s_acctbal) / 5 AS mw, 25 + (s_suppkey * 11 % 240) / 10 AS lat, -124 + (s_suppkey * 17 % 570) / 10 AS lon FROM supplier)"""


def generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as generators of plants, orders' parts as technologies; the first lines of some plants lie at latitude 0."""
    line = table(spark, sf_dir, "lineitem").where("l_partkey is not null")
    i = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")
    return line.select(
        i.alias("row_idx"), F.col("l_suppkey").alias("plant_id"), F.concat(F.lit("Plant "), F.col("l_suppkey"), F.lit("/"), F.col("l_partkey") % 3).alias("plant_name"), F.col("l_returnflag").alias("state"),
        F.col("l_linestatus").alias("county"), F.col("l_quantity").alias("mw"), F.get(F.array(*(F.lit(t) for t in TECHNOLOGIES)), (F.col("l_partkey") % len(TECHNOLOGIES)).cast("int")).alias("technology"),
        F.col("l_returnflag").alias("status"), F.when(i % 4 == 1, 0.0).otherwise(F.col("l_discount") * 100 + 30).alias("lat"), F.when(i % 7 == 1, 0.0).otherwise(-F.col("l_tax") * 100 - 80).alias("lon"),
    )


TECHNOLOGIES = ("Solar Photovoltaic", "Onshore Wind Turbine", "Nuclear", "Conventional Steam Coal", "Other Natural Gas", "Batteries", "Tidal")
_TECH_SQL = "[" + ", ".join(f"'{t}'" for t in TECHNOLOGIES) + "]"
GENERATORS_SQL = f"""generators AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS row_idx, l_suppkey AS plant_id, 'Plant ' || l_suppkey || '/' || (l_partkey % 3) AS plant_name, l_returnflag AS state, l_linestatus AS county, l_quantity AS mw,
    {_TECH_SQL}[CAST(l_partkey % {len(TECHNOLOGIES)} AS INT) + 1] AS technology, l_returnflag AS status, CASE WHEN ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) % 4 = 1 THEN 0.0 ELSE l_discount * 100 + 30 END AS lat,
    CASE WHEN ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) % 7 = 1 THEN 0.0 ELSE -l_tax * 100 - 80 END AS lon FROM lineitem WHERE l_partkey IS NOT NULL)"""
