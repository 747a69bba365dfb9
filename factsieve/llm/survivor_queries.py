"""Queries for the best representative of each duplicate group (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.joins import broadcast_if_small
from factsieve.functions.storage import materialize
from factsieve.llm.copies import record_key
from factsieve.llm.copy_queries import FINANCE_EXACT, FINANCE_TEXTS, _sql_key
from factsieve.llm.survivors import MAX_SOURCES, pick, present, survivors
from factsieve.plans.tables import table

FIELDS = {"lineage": "n_lineage", "evidence": "n_evidence"}


def _members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Groups and members of financial_plan; a source's number follows its rank in source_trust, 0 and a null rank stand for unknown ones."""
    name = lambda c: F.regexp_replace(F.lower(c), r"[\s\p{Z}_-]+", "")
    listed = table(spark, sf_dir, "source_trust").filter(F.col("추출원천").isNotNull()).groupBy(name(F.col("추출원천")).alias("source")).agg(F.min("trust_rank").alias("rank"))
    # Numbers of the most trusted sources for the model; the ranks of all sources count in the choice of rows.
    top = listed.orderBy("rank", "source").limit(MAX_SOURCES).collect()
    number = F.coalesce(F.element_at(F.create_map(*[x for i, t in enumerate(top) for x in (F.lit(t["source"]), F.lit(i + 1))]), F.col("source")), F.lit(MAX_SOURCES)) if top else F.lit(0)
    listed = listed.withColumn("_bit", number)
    lineage = F.from_json("출처계보", "array<struct<evidence_id:string>>")
    ids = F.array_distinct(F.filter(F.transform(lineage, lambda e: e["evidence_id"]), lambda x: x.isNotNull()))
    rows = table(spark, sf_dir, "financial_plan").select(record_key(FINANCE_TEXTS, FINANCE_EXACT).alias("key"), "row_id", "loaded_at", name(F.col("추출원천")).alias("source"), ids.alias("lineage"), F.array_compact(F.array(present(F.col("근거ID")))).alias("evidence"))
    rows = rows.join(broadcast_if_small(listed), "source", "left")
    rows = rows.select("key", "row_id", F.coalesce("_bit", F.lit(0)).alias("bit"), "rank", "loaded_at", "lineage", "evidence")
    return survivors(materialize(rows, "keyed"), FIELDS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, members, *_ = _members(spark, sf_dir)
    at = F.coalesce("loaded_at", F.lit("0001-01-01").cast(members.schema["loaded_at"].dataType))
    trusted = -F.coalesce(F.col("rank").cast("bigint"), F.lit(2**62))
    best = members.groupBy("key").agg(pick(F.col("n_lineage") > 0, [F.col("n_lineage"), at]).alias("lineage_row_id"), pick(F.col("n_evidence") > 0, [trusted, at]).alias("evidence_row_id"), pick(F.col("rank").isNotNull(), [trusted, at]).alias("source_row_id"), F.min("row_id").alias("first_row_id"))
    return best.select("first_row_id", "lineage_row_id", "evidence_row_id", "source_row_id")


def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the two fields that a group's rows claim, with its posterior: a field keeps all values judged true."""
    groups, _, values, _ = _members(spark, sf_dir)
    firsts = groups.select("key", "first_row_id")
    return values.join(firsts, "key").select("first_row_id", "field", "value", F.col("n_claims").cast("bigint").alias("n_claims"), F.round("truth", 6).alias("truth"), "judged")


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated sensitivity and specificity of each source for each field."""
    *_, qualities = _members(spark, sf_dir)
    rows = [(field, i, float(a), float(b)) for field, (sens, spec) in qualities.items() for i, (a, b) in enumerate(zip(sens, spec))]
    return spark.createDataFrame(rows, "field STRING, source INT, sensitivity DOUBLE, specificity DOUBLE")


QUERIES = {"p5_found": p5_found, "p5_values": p5_values, "p5_sources": p5_sources}

_PRESENT = "CASE WHEN lower(trim(regexp_replace(\"근거ID\", '[\\s\\pZ]+', ' ', 'g'))) NOT IN ('', '-', '—', '미정', '없음', 'n/a') THEN 1 END"
_RANK = "(SELECT min(trust_rank) FROM source_trust t WHERE replace(lower(t.\"추출원천\"), '_', '') = regexp_replace(lower(\"f\".\"추출원천\"), '[\\s\\pZ_-]+', '', 'g'))"
ORACLE = {
    "p5_found": f"""WITH k AS (SELECT row_id, loaded_at, {_sql_key(FINANCE_TEXTS, FINANCE_EXACT)} AS k, CASE WHEN json_valid("출처계보") THEN len(list_distinct(json_extract_string("출처계보", '$[*].evidence_id'))) END AS n, {_PRESENT} AS ev, {_RANK} AS r FROM financial_plan f),
g AS (SELECT k FROM k GROUP BY k HAVING count(*) > 1), m AS (SELECT k.* FROM k JOIN g USING (k)),
o AS (SELECT k, min(row_id) OVER (PARTITION BY k) AS first_row_id, row_id, n, ev, r, row_number() OVER (PARTITION BY k ORDER BY coalesce(n, 0) DESC, loaded_at DESC, row_id) AS a, row_number() OVER (PARTITION BY k ORDER BY ev NULLS LAST, coalesce(r, 99), loaded_at DESC, row_id) AS b, row_number() OVER (PARTITION BY k ORDER BY coalesce(r, 99), loaded_at DESC, row_id) AS c FROM m)
SELECT first_row_id, max(CASE WHEN a = 1 THEN CASE WHEN n > 0 THEN row_id ELSE -1 END END) AS lineage_row_id, max(CASE WHEN b = 1 THEN CASE WHEN ev = 1 THEN row_id ELSE -1 END END) AS evidence_row_id, max(CASE WHEN c = 1 THEN CASE WHEN r IS NOT NULL THEN row_id ELSE -1 END END) AS source_row_id FROM o GROUP BY k, first_row_id""",
}
