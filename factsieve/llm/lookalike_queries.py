"""Queries for visually identical text with different characters (problem 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.llm.lookalikes import DRAWN_ALIKE, consistent_form, count_members, find_variants, representatives
from factsieve.plans.tables import table


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "financial_plan").select(F.lit("financial_plan").alias("src"), "row_id", F.when(F.col("doc_id").isNotNull(), F.unhex(F.md5("doc_id"))).alias("scope"), F.col("사업명").alias("text"))
    both = F.concat_ws("\u0001", "doc_id", "관리번호")
    quant = table(spark, sf_dir, "quantitative_reductions").select(F.lit("quantitative_reductions").alias("src"), "row_id", F.when(F.col("doc_id").isNotNull() & F.col("관리번호").isNotNull(), F.unhex(F.md5(F.concat(F.lit("q"), both)))).alias("scope"), F.col("단위").alias("text"))
    return plan.unionByName(quant)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _inputs(spark, sf_dir)
    return find_variants(rows, representatives(count_members(rows, "text")))


def p4_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its consistent form."""
    rows = _inputs(spark, sf_dir)
    rules = representatives(count_members(rows, "text"))
    return rows.select("src", "row_id", consistent_form(rows, "text", rules).alias("text"))


QUERIES = {"p4_found": p4_found, "p4_consistent": p4_consistent}

_WIDE = "".join(chr(0xFF01 + i) for i in range(94))
_SPACES = "".join(map(chr, [0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))
_FROM = (_WIDE + DRAWN_ALIKE[0] + "\u2027\u30fb\u318d" + _SPACES).replace("'", "''")
_TO = ("".join(chr(0x21 + i) for i in range(94)) + DRAWN_ALIKE[1] + "\u00b7" * 3 + " " * len(_SPACES)).replace("'", "''")
_FORM = f"nfc_normalize(regexp_replace(translate(x, '{_FROM}', '{_TO}'), '[\u00ad\u200b-\u200d\u2060\ufeff]+', '', 'g'))"
ORACLE = {
    "p4_found": "WITH t AS (SELECT 'financial_plan' AS src, row_id, doc_id AS scope, \"사업명\" AS x FROM financial_plan WHERE doc_id IS NOT NULL UNION ALL SELECT 'quantitative_reductions', row_id, doc_id || chr(1) || \"관리번호\", \"단위\" FROM quantitative_reductions WHERE doc_id IS NOT NULL AND \"관리번호\" IS NOT NULL), f AS (SELECT *, " + _FORM + " AS c FROM t WHERE x IS NOT NULL), p AS (SELECT src, scope, x AS c, min(row_id) AS first FROM f WHERE x = c GROUP BY ALL) SELECT src, least(row_id, first) AS row_id_a, greatest(row_id, first) AS row_id_b FROM f JOIN p USING (src, scope, c) WHERE f.x <> f.c AND trim(f.c) <> ''",
}
