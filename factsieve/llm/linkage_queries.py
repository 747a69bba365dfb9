"""Queries for matching financing rows to factor entries (problem 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.llm.linkage import link
from factsieve.plans.tables import table


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financing rows and the factor entries that apply, with the posterior as confidence."""
    sector = F.nullif(F.regexp_replace(F.trim(F.col("부문")), r"\s*부문$", ""), F.lit(""))
    plan = table(spark, sf_dir, "financial_plan").select("row_id", F.col("사업명").alias("name"), F.nullif(sector, F.lit("-")).alias("sector"), F.col("연도").alias("year"))
    units = table(spark, sf_dir, "appendix3_reduction_units").select(F.col("번호").alias("unit_no"), F.col("감축사업명").alias("entry"), F.trim("부문").alias("sector"), F.col("적용시작연도").alias("first"), F.col("적용종료연도").alias("last"))
    return link(plan, units)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_links(spark, sf_dir).select("row_id", "unit_no")


QUERIES = {"p3_found": p3_found, "p3_links": p3_links}
