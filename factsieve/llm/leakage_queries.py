"""Queries for evaluation texts in documents (problem 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factsieve.llm.leakage import leaks
from factsieve.plans.tables import table


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and items with the share of the item that one place of the document covers."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_shares(spark, sf_dir).select("doc_id", "item_id")


QUERIES = {"p9_found": p9_found, "p9_shares": p9_shares}
