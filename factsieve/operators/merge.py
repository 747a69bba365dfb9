"""Evidence-preserving merge: equal facts share their evidence, different values are both kept and cross-referenced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.canon import payload_fields, payload_hash

#: The fields that name one entity, by sheet.
ENTITY = {
    "regional_conditions": ["지자체명", "지표범주", "지표세부범주", "지표명", "연도", "단위"],
    "emissions_regional": ["지자체명", "인벤토리출처", "배출범위", "배출유형", "부문", "세부부문", "연도", "단위"],
    "emissions_management": ["지자체명", "인벤토리출처", "관리부문", "세부부문", "직간접구분", "연도", "단위"],
    "emissions_forecast": ["지자체명", "시나리오", "전망범위", "부문", "세부부문", "연도", "단위"],
    "reduction_targets": ["지자체명", "목표수준", "목표범위", "부문", "기준연도", "목표연도", "단위"],
    "annual_implementation": ["지자체명", "관리번호", "사업명", "연도", "기간시작", "기간종료", "목표단위"],
    "quantitative_reductions": ["지자체명", "관리번호", "사업명", "연도", "단위", "감축량유형", "시간기준"],
    "financial_plan": ["지자체명", "계획구분", "부문", "사업명", "재원구분", "연도", "예산단위"],
    "mitigation_projects": ["지자체명", "관리번호", "사업명", "부문"],
    "monitoring_performance": ["지자체명", "점검연도", "관리번호", "사업명", "부문"],
}


def stable_merge(df: DataFrame, fields: list[str], ids: list[str], seq: str) -> DataFrame:
    """One row per distinct content: ``fields``, the union of each id column (sorted), first_seq and n_rows.

    Independent of input order; grouping is on a hash of the canonical payload, with map-side combine of the id sets.
    """
    keyed = df.withColumn("_payload", payload_hash(df, sorted(fields)))
    unions = [F.array_sort(F.collect_set(c)).alias(c) for c in ids]
    return keyed.groupBy("_payload").agg(*[F.min_by(c, seq).alias(c) for c in fields], *unions, F.min(seq).alias("first_seq"), F.count("*").alias("n_rows")).drop("_payload")


def conflict_pairs(df: DataFrame, entity: list[str], values: list[str], seq: str) -> DataFrame:
    """(entity…, earlier, later, differing): pairs of distinct facts of one entity that differ in a field filled in both.

    Only entities with several distinct facts are joined; each pair stands once, the earlier ``seq`` first. Facts equal
    in all values count once, by their first row, so copies don't multiply the pairs.
    """
    facts = df.groupBy(*entity, *values).agg(F.min(seq).alias("_seq"))
    several = facts.groupBy(*entity).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    same = lambda a, b: reduce(lambda x, y: x & y, [a[e].eqNullSafe(b[e]) for e in entity])
    a = facts.join(several, same(facts, several), "left_semi")
    b = a.select(*[F.col(c).alias(f"_b_{c}") for c in a.columns])
    on = reduce(lambda x, y: x & y, [F.col(e).eqNullSafe(F.col(f"_b_{e}")) for e in entity]) & (F.col("_seq") < F.col("_b__seq"))
    differ = F.array_compact(F.array(*[F.when(F.col(v).isNotNull() & F.col(f"_b_{v}").isNotNull() & (F.col(v) != F.col(f"_b_{v}")), F.lit(v)) for v in values]))
    return a.join(b, on).select(*entity, F.col("_seq").alias("earlier"), F.col("_b__seq").alias("later"), differ.alias("differing")).filter(F.size("differing") > 0)


def conflict_id(*cols: Column) -> Column:
    """Stable id of a conflict."""
    return F.concat(F.lit("cf-"), F.substring(F.sha2(F.to_json(F.struct(*cols)), 256), 1, 24))


def resolve_blank_scope(df: DataFrame, keys: list[str], value: str, scope: str, others: list[str], seq: str) -> DataFrame:
    """Each row with _scope_status and _target, the scope it has or is absorbed into.

    A row without scope may be absorbed by a row with one that is equal in the keys and the value and compatible in the
    ``others`` (equal wherever both are filled); exactly one must be so ("absorbed"). With several scopes among them it is
    "ambiguous_blank_scope", with several rows of one scope "several", with only incompatible ones
    "scope_candidate_payload_conflict", without any "alone"; a row with a scope is "known". Texts compare without case and
    white space; rows with a scope are counted by what is compared first, so copies multiply nothing.
    """
    fold = lambda c: F.coalesce(F.regexp_replace(F.lower(F.col(c).cast("string")), r"[\s\p{Z}]+", ""), F.lit(""))
    blank = F.coalesce(F.trim(scope) == "", F.lit(True))
    bucket = F.xxhash64(*[fold(c) for c in [*keys, value]])
    known = df.filter(~blank).groupBy(bucket.alias("_kb"), F.col(scope).alias("_ks"), *[fold(c).alias(f"_k{i}") for i, c in enumerate(others)]).agg(F.count("*").alias("_kn"))
    open_ = df.filter(blank).select(F.col(seq).alias("_seq"), bucket.alias("_ob"), *[fold(c).alias(f"_o{i}") for i, c in enumerate(others)])
    fits = reduce(lambda a, b: a & b, [(F.col(f"_k{i}") == "") | (F.col(f"_o{i}") == "") | (F.col(f"_k{i}") == F.col(f"_o{i}")) for i in range(len(others))], F.lit(True))
    pairs = open_.join(known, F.col("_ob") == F.col("_kb")).withColumn("_fits", fits)
    found = pairs.groupBy("_seq").agg(F.coalesce(F.sum(F.when(F.col("_fits"), F.col("_kn"))), F.lit(0)).alias("_rows"), F.count_distinct(F.when(F.col("_fits"), F.col("_ks"))).alias("_scopes"), F.min(F.when(F.col("_fits"), F.col("_ks"))).alias("_only"))
    out = df.join(found, F.col(seq) == F.col("_seq"), "left")
    status = F.when(~blank, "known").when(F.col("_rows").isNull(), "alone").when(F.col("_scopes") > 1, "ambiguous_blank_scope").when(F.col("_rows") == 0, "scope_candidate_payload_conflict").when(F.col("_rows") == 1, "absorbed").otherwise("several")
    return out.withColumns({"_scope_status": status, "_target": F.when(~blank, F.col(scope)).when(F.col("_rows") == 1, F.col("_only"))}).drop("_seq", "_rows", "_scopes", "_only")


def append_only(baseline: DataFrame, incoming: DataFrame, entity: list[str]) -> DataFrame:
    """``incoming`` with _decision: already (same content stored), held (its entity is stored otherwise), add."""
    fields = payload_fields(baseline)
    b = baseline.select(payload_hash(baseline, fields).alias("_p"), F.xxhash64(*[F.coalesce(F.col(e).cast("string"), F.lit("")) for e in entity]).alias("_e"))
    i = incoming.withColumns({"_p": payload_hash(incoming, fields), "_e": F.xxhash64(*[F.coalesce(F.col(e).cast("string"), F.lit("")) for e in entity])})
    stored = b.select("_p").distinct().withColumn("_has", F.lit(True))
    entities = b.select("_e").distinct().withColumn("_known", F.lit(True))
    out = i.join(stored, "_p", "left").join(entities, "_e", "left")
    return out.withColumn("_decision", F.when(F.col("_has"), "already").when(F.col("_known"), "held").otherwise("add")).drop("_p", "_e", "_has", "_known")
