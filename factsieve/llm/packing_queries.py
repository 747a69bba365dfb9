"""Queries for filling training sequences (problem 8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.llm.packing import CAPACITY, packed_documents
from factsieve.plans.tables import table


def p8_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's sequence, with its place and length in it."""
    return packed_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of sequences, the least possible for so many tokens, and the share of the capacity in use."""
    used = p8_sequences(spark, sf_dir)
    total = used.agg(F.count_distinct("sequence_id").alias("n_sequences"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    return total.select("n_sequences", F.ceil(F.col("n_tokens") / CAPACITY).alias("least_sequences"), "n_tokens", F.round(F.try_divide(F.col("n_tokens"), F.col("n_sequences") * CAPACITY), 4).alias("fill"))


QUERIES = {"p8_sequences": p8_sequences, "p8_fill": p8_fill}
