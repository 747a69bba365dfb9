"""Cleaning: defaults, required fields, first-non-null and contract deduplication, blank statistics."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.canon import PROVENANCE
from factsieve.functions.codes import axis, forecast_method, forecast_scope, mapped, sector
from factsieve.functions.codes import ACHIEVEMENT, PROJECT_TYPE
from factsieve.functions.ids import project_id
from factsieve.functions.numbers import measure, whole
from factsieve.functions.text import folded, is_blank


def fill_default(df: DataFrame, column: str, value: str) -> DataFrame:
    """``column`` with ``value`` where it is blank."""
    return df.withColumn(column, F.when(is_blank(F.col(column)), F.lit(value)).otherwise(F.col(column)))


def has_any(*columns: str) -> Column:
    """Whether any of the columns is filled; zero is a value."""
    return reduce(lambda a, b: a | b, [~is_blank(F.col(c).cast("string")) for c in columns])


def split_by_contract(df: DataFrame, keep: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a contract, and the others with the reason they are dropped for."""
    ok = F.coalesce(keep, F.lit(False))
    return df.filter(ok), df.filter(~ok).withColumn("_dropped_for", F.lit(reason))


#: Per sheet: whole-number fields, measures, and the fields of which one must be filled.
SHEETS: dict[str, tuple[list[str], list[str], list[str]]] = {
    "document_meta": (["계획시작연도", "계획종료연도", "기준연도"], [], []),
    "plan_overview": ([], [], []),
    "regional_conditions": (["연도"], ["값"], ["값", "지표명"]),
    "emissions_regional": (["연도"], ["배출량"], ["배출량"]),
    "emissions_management": (["연도"], ["배출량"], ["관리부문"]),
    "emissions_forecast": (["연도"], ["전망값"], ["전망값"]),
    "reduction_targets": (["기준연도", "목표연도"], ["기준배출량", "배출전망", "목표감축량", "목표배출량", "감축률(%)"], []),
    "vision_strategy": ([], [], ["비전문구", "전략명"]),
    "mitigation_projects": ([], [], ["사업명"]),
    "annual_implementation": (["기간시작", "기간종료", "연도"], ["목표물량"], ["사업명", "연간계획", "목표물량"]),
    "quantitative_reductions": (["연도"], ["활동량", "감축원단위값", "예상감축량"], ["사업명", "예상감축량"]),
    "financial_plan": (["연도"], ["예산액"], ["예산액"]),
    "foundation_measures": ([], [], ["과제명", "주요내용"]),
    "governance_feedback": ([], [], ["거버넌스기구", "역할", "절차단계"]),
    "monitoring_performance": (["점검연도"], [], ["사업명", "이행실적"]),
    "changes_actions": (["점검연도"], [], ["사업명", "변경사유", "조치계획"]),
}


def clean_sheet(df: DataFrame, sheet: str, municipality: str | None = None) -> DataFrame:
    """One of the sixteen cleaners: types, codes, default municipality and the row filter of the sheet."""
    wholes, measures, required = SHEETS[sheet]
    have = set(df.columns)
    if sheet == "reduction_targets" and "감축률" in have:
        df = df.withColumn("감축률(%)", F.coalesce("감축률(%)", "감축률") if "감축률(%)" in have else F.col("감축률"))
        have = set(df.columns)
    changes = {c: whole(F.col(c)) for c in wholes if c in have} | {c: measure(F.col(c)) for c in measures if c in have}
    for c in ("부문", "관리부문"):
        if c in have:
            changes[c] = sector(F.col(c))
    for c in ("배출유형", "직간접구분"):
        if c in have:
            changes[c] = axis(c, F.col(c))["value"]
            changes[f"_{c}_rejected"] = axis(c, F.col(c))["rejected"]
    if "관리번호" in have:
        changes["관리번호"] = project_id(F.col("관리번호"))
    if "전망범위" in have:
        changes["전망범위"] = F.coalesce(forecast_scope(F.col("전망범위")), F.trim("전망범위"))
    if "전망방법원문" in have:
        changes["전망방법코드"] = forecast_method(F.col("전망방법원문"))
    if "달성여부" in have:
        changes["달성여부"] = mapped(ACHIEVEMENT, F.col("달성여부"))
    if "사업유형" in have:
        changes["사업유형"] = mapped(PROJECT_TYPE, F.col("사업유형"))
    out = df.withColumns(changes) if changes else df
    if municipality and "지자체명" in have:
        out = fill_default(out, "지자체명", municipality)
    needed = [c for c in required if c in have]
    return out.filter(has_any(*needed)) if needed else out


def first_non_null(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row a key with the first non-null value of every other column in ``order`` (unique within a key).

    Keys compare trimmed and a null key is the empty text. An aggregation with map-side combine, so a key that holds a
    large share of the rows needs no sort in one task.
    """
    cleaned = [F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(k) for k in keys]
    firsts = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in df.columns if c not in keys and c != order]
    return df.groupBy(*cleaned).agg(*firsts, F.min(order).alias(order))


def key_blank_stats(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n_rows, n_blank, blank_rate): one pass, one output row a field."""
    blanks = df.agg(F.count("*").alias("n_rows"), *[F.count_if(is_blank(F.col(f).cast("string"))).alias(f"b{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col("n_rows"), F.col(f"b{i}").alias("n_blank")) for i, f in enumerate(fields)])
    return blanks.select(F.inline(rows)).withColumn("blank_rate", F.round(F.coalesce(F.try_divide("n_blank", "n_rows"), F.lit(0.0)), 6))


def contract_dedup(df: DataFrame, keys: list[str], value: str, seq: str = "seq", ids: tuple[str, ...] = (), axis_original: str | None = None) -> DataFrame:
    """Merge rows of one key, value and original axis where exactly one earlier row is compatible, and mark conflicts of one key.

    Order-dependent by definition, hence a kernel on the bucket (key, value and ``axis_original``, an annotation in text),
    sorted by canonical JSON. Rows are compatible if all content fields filled on both sides are equal but for case and
    white space; the merge fills blanks and unites the ``ids`` (columns of evidence, given as sorted arrays in the result).
    Adds _copies and _conflict: null, or same_entity_different_value or same_entity_different_field where a key has
    several rows left. Exact repetitions collapse before the shuffle, so that a bucket holds distinct rows only.
    """
    content = [c for c in df.columns if c not in PROVENANCE and not c.startswith("_") and c not in (seq, *ids)]
    axes = [axis_original] if axis_original else []
    distinct = df.groupBy(*content, *axes).agg(F.min(seq).alias(seq), F.count("*").alias("_copies"), *[F.array_sort(F.collect_set(c)).alias(c) for c in ids])
    fold = [F.coalesce(folded(F.col(c).cast("string")), F.lit("")).alias(f"_k{i}") for i, c in enumerate([*keys, value, *axes])]
    bucketed = distinct.select("*", F.xxhash64(*fold).alias("_bucket"))
    schema = distinct.schema

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns=["_bucket"])
        records = rows.astype(object).where(rows.notna(), None).to_dict("records")
        records.sort(key=lambda r: json.dumps({k: r[k] for k in content}, sort_keys=True, ensure_ascii=False, default=str))
        plain = lambda x: "".join(str(x).lower().split())
        kept: list[dict] = []
        for r in records:
            own = [(c, plain(r[c])) for c in content if r[c] not in (None, "")]
            fits = [o for o in kept if all(o[c] in (None, "") or plain(o[c]) == x for c, x in own)]
            if len(fits) == 1:
                o = fits[0]
                for c in content:
                    if o[c] in (None, ""):
                        o[c] = r[c]
                for c in ids:
                    o[c] = sorted({*o[c], *r[c]})
                o["_copies"] += r["_copies"]
                o[seq] = min(o[seq], r[seq])
            else:
                kept.append(r)
        return pd.DataFrame(kept, columns=list(schema.names))

    # Only buckets with several distinct rows have anything to merge; the others don't pass through Python.
    crowded = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n")).filter("_n > 1").select("_bucket")
    alone = bucketed.join(crowded, "_bucket", "left_anti").select(*schema.names)
    merged = alone.unionByName(bucketed.join(crowded, "_bucket", "left_semi").groupBy("_bucket").applyInPandas(merge, schema))
    entity = [F.coalesce(folded(F.col(k).cast("string")), F.lit("")).alias(f"_s{i}") for i, k in enumerate(keys)]
    sizes = merged.groupBy(F.xxhash64(*entity).alias("_entity")).agg(F.count("*").alias("_n"), F.count_distinct(F.coalesce(folded(F.col(value).cast("string")), F.lit(""))).alias("_values"))
    out = merged.withColumn("_e", F.xxhash64(*entity)).join(sizes, F.col("_e") == F.col("_entity"))
    reason = F.when((F.col("_n") > 1) & (F.col("_values") > 1), "same_entity_different_value").when(F.col("_n") > 1, "same_entity_different_field")
    return out.select(*schema.names, reason.alias("_conflict"))
