"""Queries for document and line languages (problem 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.storage import materialize
from factsieve.llm.language import fit_on, label_language, label_lines
from factsieve.plans.tables import table


def p10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (seg 0) and every non-blank line with its language and confidence."""
    documents = table(spark, sf_dir, "documents")
    return label_lines(documents, fit_on(documents))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lines = materialize(p10_languages(spark, sf_dir), "languages")
    whole = lines.filter("seg = 0").join(documents.select("doc_id", label_language(F.col("lang")).alias("_label")), "doc_id")
    wrong = whole.filter(F.col("lang").isNotNull() & ~F.col("_label").eqNullSafe(F.col("lang"))).select("doc_id", "seg", "lang")
    mixed = lines.filter("seg > 0").groupBy("doc_id").agg((F.min("lang") != F.max("lang")).alias("_mixed")).filter("_mixed").select("doc_id")
    return wrong.unionByName(lines.filter("seg > 0").join(mixed, "doc_id", "left_semi").select("doc_id", "seg", "lang"))


QUERIES = {"p10_found": p10_found, "p10_languages": p10_languages}
