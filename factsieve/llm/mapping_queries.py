"""Queries for mapping free-entered values to canonical lists (problem 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.joins import broadcast_if_small
from factsieve.llm.mapping import distinct_values, map_values, match_projects, match_sectors
from factsieve.plans.tables import table


def _stated(df: DataFrame) -> DataFrame:
    return df.filter(~F.trim(F.regexp_replace("value", r"[\s\p{Z}]+", " ")).isin("", "-"))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    sectors = table(spark, sf_dir, "ref_sectors").select(F.col("sector_id").alias("ref_id"), F.col("부문").alias("name"), F.col("영문명").alias("english"))
    catalog = table(spark, sf_dir, "project_catalog").select(F.col("catalog_id").alias("ref_id"), F.col("사업명").alias("name"))
    emissions, projects = table(spark, sf_dir, "emissions_regional"), table(spark, sf_dir, "appendix4_projects")
    typed = _stated(emissions.select(F.lit("emissions_regional").alias("src"), "row_id", F.lit("부문").alias("field_name"), F.col("부문").alias("value")).unionByName(projects.select(F.lit("appendix4_projects").alias("src"), "row_id", F.lit("부문").alias("field_name"), F.col("부문").alias("value"))))
    named = _stated(projects.select(F.lit("appendix4_projects").alias("src"), "row_id", F.lit("사업명").alias("field_name"), F.col("사업명").alias("value")))
    sector_names, project_names = sectors.select(F.col("name").alias("value")).distinct(), catalog.select(F.col("name").alias("value")).distinct()
    uses = typed.join(broadcast_if_small(sectors.select("ref_id", F.col("name").alias("value"))), "value").groupBy("ref_id").agg(F.count("*").alias("uses"))
    out = map_values(typed, sector_names, match_sectors(distinct_values(typed, sector_names), sectors, uses))
    return out.unionByName(map_values(named, project_names, match_projects(distinct_values(named, project_names), catalog)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped(spark, sf_dir).select("src", "row_id", "field_name", "ref_id")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values that mean no entry, with their number of rows."""
    return _mapped(spark, sf_dir).filter("ref_id = 'UNMATCHED'").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))


QUERIES = {"p2_found": p2_found, "p2_unmatched": p2_unmatched}
