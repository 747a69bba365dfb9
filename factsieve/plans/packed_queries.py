"""Queries for packed fields (problem 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.operators.packed import delimiter_scores, rejected, source_class, split_packed
from factsieve.plans.tables import table


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    meta = table(spark, sf_dir, "document_meta").select("row_id", F.col("목표연도").alias("text"), F.coalesce("지자체유형", F.lit("")).alias("source"))
    plan = table(spark, sf_dir, "financial_plan").select("row_id", F.col("출처페이지").alias("text"), source_class(F.col("추출원천")).alias("source"))
    return meta, plan


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, plan = _inputs(spark, sf_dir)
    years = split_packed(meta, "row_id", "text", "source", "year").withColumn("src", F.lit("document_meta"))
    pages = split_packed(plan, "row_id", "text", "source", "page").withColumn("src", F.lit("financial_plan"))
    return years.unionByName(pages).filter("n_values > 1").select("src", F.col("id").alias("row_id"), F.col("pos").cast("int").alias("pos"), "val")


def p6_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that hold something else than values, with the first such piece."""
    meta, plan = _inputs(spark, sf_dir)
    years = rejected(meta, "row_id", "text", "source", "year").withColumn("src", F.lit("document_meta"))
    return years.unionByName(rejected(plan, "row_id", "text", "source", "page").withColumn("src", F.lit("financial_plan"))).select("src", F.col("id").alias("row_id"), "raw", "piece")


def p6_delimiters(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, plan = _inputs(spark, sf_dir)
    out = delimiter_scores(meta, "text", "source", "year").withColumn("src", F.lit("document_meta"))
    return out.unionByName(delimiter_scores(plan, "text", "source", "page").withColumn("src", F.lit("financial_plan"))).select("src", "source", "delimiter", F.col("n_rows").cast("bigint").alias("n_rows"), F.round("score", 6).alias("score"))


QUERIES = {"p6_found": p6_found, "p6_rejected": p6_rejected, "p6_delimiters": p6_delimiters}

ORACLE = {
    "p6_found": r"""WITH t AS (SELECT 'financial_plan' AS src, row_id, regexp_extract_all(regexp_replace("출처페이지", '표\s*[0-9]+-[0-9]+', '', 'g'), '[0-9]+(?:\s*[-~–∼]\s*[0-9]+)?') AS s FROM financial_plan UNION ALL SELECT 'document_meta', row_id, [CASE WHEN length(x) = 2 THEN '20' || x ELSE x END for x in regexp_extract_all("목표연도", '[0-9]+')] FROM document_meta),
u AS (SELECT src, row_id, unnest(s) AS s, generate_subscripts(s, 1) AS i FROM t),
b AS (SELECT src, row_id, i, regexp_extract(s, '^[0-9]+')::bigint AS lo, regexp_extract(s, '[0-9]+$')::bigint AS hi FROM u),
v AS (SELECT src, row_id, i, unnest(range(lo, hi + 1)) AS val FROM b),
p AS (SELECT src, row_id, row_number() OVER (PARTITION BY src, row_id ORDER BY i, val)::int AS pos, val, count(*) OVER (PARTITION BY src, row_id) AS n FROM v) SELECT src, row_id, pos, val FROM p WHERE n > 1""",
}
