"""Context: nearest preceding headings and agreement of claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nearest_preceding(events: DataFrame, key: list[str], order: list[str], is_heading: Column, value: Column, reach: Column | None = None, position: Column | None = None) -> DataFrame:
    """As-of join by one window: each event with the last heading value before it in its key, within ``reach`` of ``position``."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = events.withColumn("scope", F.last(F.when(is_heading, value), ignorenulls=True).over(w))
    if reach is not None and position is not None:
        out = out.withColumn("_at", F.last(F.when(is_heading, position), ignorenulls=True).over(w))
        out = out.withColumn("scope", F.when(position - F.col("_at") <= reach, F.col("scope"))).drop("_at")
    return out


def claim_agreement(claims: DataFrame, key: list[str], value: str, source: str) -> DataFrame:
    """(key…, status, value, n_sources): resolved where all claims agree, held where they differ, missing without a claim."""
    agreed = claims.groupBy(*key).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_v"), F.count_distinct(F.when(F.col(value).isNotNull(), F.col(source))).alias("n_sources"))
    status = F.when(F.col("_n") == 0, "missing").when(F.col("_n") == 1, "resolved").otherwise("held")
    return agreed.select(*key, status.alias("status"), F.when(F.col("_n") == 1, F.col("_v")).alias("value"), "n_sources")


def context_summary(claims: DataFrame) -> DataFrame:
    return claims.groupBy("status").agg(F.count("*").alias("n"))


def page_support(rows: DataFrame, pages: DataFrame, key: str, row_id: str, number: str) -> DataFrame:
    """(row_id, supported): whether a row's number stands on one of its pages, plain or with separators, and not inside another number."""
    wanted = rows.select(F.col(row_id).alias("row_id"), key, F.explode("pages").alias("page"), F.col(number).alias("_x"))
    text = F.regexp_replace("text", r"(?<=[0-9]),(?=[0-9]{3})", "")
    plain = F.regexp_replace(F.col("_x").cast("decimal(24,4)").cast("string"), r"\.?0+$", "")
    hit = F.rlike(text, F.concat(F.lit(r"(?<![0-9.])"), F.regexp_replace(plain, r"\.", r"\\."), F.lit(r"(?![0-9]|\.[0-9])")))
    return wanted.join(pages, [key, "page"], "left").groupBy("row_id").agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("supported"))
