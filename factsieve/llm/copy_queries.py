"""Queries for duplicates hidden by formatting (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.storage import materialize
from factsieve.llm.copies import CopyLedger, find_copies, payload_key, record_key
from factsieve.plans.tables import table

FINANCE_TEXTS, FINANCE_EXACT = ["doc_id", "계획구분", "부문", "사업명", "재원구분", "예산단위"], ["연도", "예산액"]
TARGET_TEXTS, TARGET_EXACT = ["doc_id", "목표수준", "목표범위", "부문", "단위"], ["기준연도", "목표연도", "기준배출량", "목표배출량", "목표감축량"]
SOURCES = ("financial_plan", "reduction_targets", "raw_extracts")


def keyed_records(spark: SparkSession, sf_dir: str, src: str) -> DataFrame:
    """(key, id) of one of the three deliveries."""
    rows = table(spark, sf_dir, src)
    if src == "financial_plan":
        return rows.select(record_key(FINANCE_TEXTS, FINANCE_EXACT).alias("key"), F.col("row_id").alias("id"))
    if src == "reduction_targets":
        return rows.select(record_key(TARGET_TEXTS, TARGET_EXACT).alias("key"), F.col("row_id").alias("id"))
    return rows.select(payload_key(F.col("payload"), ["doc_id", "sheet_key"]).alias("key"), F.col("raw_id").alias("id"))


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, key, id) of all three deliveries; a key holds its table's name, so one ledger serves all."""
    out = None
    for src in SOURCES:
        part = keyed_records(spark, sf_dir, src).select(F.lit(src).alias("src"), F.unhex(F.md5(F.concat(F.lit(src), F.hex("key")))).alias("key"), "id")
        out = part if out is None else out.unionByName(part)
    return materialize(out, "keys")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(all_records(spark, sf_dir), CopyLedger(spark)).select("src", "first_id", F.col("id").alias("dup_id"))


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct record, named by its earliest row, with its number of copies."""
    out = None
    for src in SOURCES:
        ledger = CopyLedger(spark)
        ledger.absorb(keyed_records(spark, sf_dir, src))
        part = ledger.table().select(F.lit(src).alias("src"), "first_id", F.col("n").alias("copies"))
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {"p1_found": p1_found, "p1_records": p1_records}

_CLEAN = r"regexp_replace(lower(concat_ws(chr(1), {})), '[\s\pZ\pP!-/:-@\[-`{{-~■-◿]+', '', 'g')"


def _sql_key(texts: list[str], exact: list[str]) -> str:
    mark = lambda c: f"coalesce({c}, chr(2))"
    return _CLEAN.format(", ".join(mark(f'"{c}"') for c in texts)) + "".join(f" || chr(1) || coalesce(\"{c}\"::varchar, chr(2))" for c in exact)


_VALUE = r"""(SELECT string_agg(part, chr(1) ORDER BY part) FROM (SELECT regexp_replace(lower(j.key), '[\s\pZ\pP!-/:-@\[-`{-~■-◿]+', '', 'g') || chr(3) || coalesce((CASE WHEN regexp_full_match(regexp_replace(j.value ->> '$', '[,\s]', '', 'g'), '[+-]?[0-9]+(\.[0-9]+)?') THEN regexp_replace(j.value ->> '$', '[,\s]', '', 'g') WHEN regexp_full_match(regexp_replace(j.value ->> '$', '[\s\pZ\pP!-/:-@\[-`{-~■-◿]+', '', 'g'), '[0-9]+') THEN regexp_replace(j.value ->> '$', '[\s\pZ\pP!-/:-@\[-`{-~■-◿]+', '', 'g') END)::double::varchar, regexp_replace(lower(j.value ->> '$'), '[\s\pZ\pP!-/:-@\[-`{-~■-◿]+', '', 'g')) AS part FROM json_each(r.payload) j WHERE json_type(j.value) <> 'NULL'))"""
_KEYS = f"""keys AS (
  SELECT 'financial_plan' AS src, row_id AS id, {_sql_key(FINANCE_TEXTS, FINANCE_EXACT)} AS k FROM financial_plan
  UNION ALL SELECT 'reduction_targets', row_id, {_sql_key(TARGET_TEXTS, TARGET_EXACT)} FROM reduction_targets
  UNION ALL SELECT 'raw_extracts', raw_id, coalesce(doc_id, chr(2)) || chr(1) || coalesce(sheet_key, chr(2)) || chr(1) || {_VALUE} FROM raw_extracts r)"""
ORACLE = {
    "p1_found": f"WITH {_KEYS}, firsts AS (SELECT src, id, min(id) OVER (PARTITION BY src, k) AS first_id FROM keys) SELECT src, first_id, id AS dup_id FROM firsts WHERE id <> first_id",
    "p1_records": f"WITH {_KEYS} SELECT src, min(id) AS first_id, count(*) AS copies FROM keys GROUP BY src, k",
}
