"""Generators to plants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dims import TECH_DEFAULT, TECH_GROUPS, lookup


def tech_group(technology: Column) -> Column:
    """The group of a technology."""
    return lookup(F.trim(technology), {t: g for g, members in TECH_GROUPS.items() for t in members}, TECH_DEFAULT)


def plant_rollup(generators: DataFrame, order: str = "row_idx") -> DataFrame:
    """One row a plant: summed capacity, count, the first name, state and county by ``order``, the first
    latitude and longitude other than 0 (each for itself), sorted statuses. Generators without plant_id are left out."""
    at = F.col(order)

    def first_but_zero(c: str) -> Column:
        # a blank one counts as other than 0 and stays blank
        first = F.min_by(F.struct(c), F.when(F.col(c).isNull() | (F.col(c) != 0), at))
        return F.when(first.isNull(), F.lit(0.0)).otherwise(first[c])

    return generators.where("plant_id is not null").groupBy("plant_id").agg(
        F.min_by("plant_name", at).alias("plant_name"), F.min_by("state", at).alias("state"), F.min_by("county", at).alias("county"),
        F.sum("mw").alias("nameplate_mw"), F.count("*").alias("generator_count"), first_but_zero("lat").alias("lat"), first_but_zero("lon").alias("lon"),
        F.array_join(F.array_sort(F.collect_set("status")), ", ").alias("eia_statuses"),
    )


def dominant_tech(generators: DataFrame) -> DataFrame:
    """plant_id and the technology group with most capacity; ties go to the first name."""
    sums = generators.where("plant_id is not null").groupBy("plant_id", "tech_group").agg(F.sum("mw").alias("mw"))
    first = F.row_number().over(Window.partitionBy("plant_id").orderBy(F.col("mw").desc(), "tech_group"))
    return sums.withColumn("n_", first).where("n_ = 1").select("plant_id", "tech_group", "mw")


def all_plants(operating: DataFrame, planned: DataFrame) -> DataFrame:
    """Operating plants, and those planned ones that aren't among them."""
    new = planned.join(operating.select("plant_id"), "plant_id", "left_anti")
    return operating.withColumn("pp_status", F.lit("Operational")).unionByName(new.withColumn("pp_status", F.lit("Planned")))


def in_both(operating: DataFrame, planned: DataFrame) -> DataFrame:
    return operating.select("plant_id").intersect(planned.select("plant_id"))
