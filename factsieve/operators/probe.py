"""Probes that compare two outputs without a golden set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.operators.quality import metric


def fill_rates(df: DataFrame, group: str, required: list[str], optional: list[str]) -> DataFrame:
    """Share of filled required and optional cells of each group."""
    filled = lambda cs: sum((F.when(F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)), 1).otherwise(0) for c in cs), F.lit(0))
    return df.groupBy(group).agg(F.count("*").alias("n_rows"), metric(F.sum(filled(required)), F.count("*") * max(len(required), 1)).alias("required_rate"), metric(F.sum(filled(optional)), F.count("*") * max(len(optional), 1)).alias("optional_rate"))


def code_rate(df: DataFrame, column: str, codes: list[str]) -> Column:
    """Share of the filled values of a column that are codes."""
    c = F.trim(F.col(column))
    return metric(F.count_if(c.isin(codes)), F.count_if(F.coalesce(c != "", F.lit(False))))


def year_band(col: Column, first: Column, last: Column) -> Column:
    """Share of years within a plan's span."""
    return metric(F.count_if(col.between(first, last)), F.count(col))


def agreement(a: DataFrame, b: DataFrame, keys: list[str], group: str, value: str) -> DataFrame:
    """Per group: keys both have, that one has alone, and the share of shared keys whose values agree to half a percent."""
    x = a.groupBy(group, *keys).agg(F.min(value).alias("_a"), F.count("*").alias("_na"))
    y = b.groupBy(group, *keys).agg(F.min(value).alias("_b"), F.count("*").alias("_nb"))
    both = x.join(y, [group, *keys], "full_outer")
    same = F.coalesce(F.abs(F.col("_a") - F.col("_b")) <= 0.005 * F.greatest(F.abs("_a"), F.abs("_b"), F.lit(1.0)), F.lit(False))
    shared = F.col("_na").isNotNull() & F.col("_nb").isNotNull()
    return both.groupBy(group).agg(F.count_if(shared).alias("shared"), F.count_if(F.col("_nb").isNull()).alias("only_a"), F.count_if(F.col("_na").isNull()).alias("only_b"), F.count_if(shared & same).alias("agree")).withColumn("rate", metric(F.col("agree"), F.col("shared")))


def bottom(df: DataFrame, rate: str, k: int = 3) -> DataFrame:
    """The k groups of the lowest rate, null rates last."""
    return df.orderBy(F.col(rate).asc_nulls_last()).limit(k)


def agreed_accuracy(ab: DataFrame, gb: DataFrame, row: str) -> DataFrame:
    """Accuracy of the pairs two outputs agree on: those also matched to the golden set, and of them the equal ones."""
    both = ab.join(gb, row, "left")
    return both.agg(F.count("*").alias("agreed"), F.count("golden_equal").alias("with_golden"), F.count_if(F.col("golden_equal")).alias("equal"))
