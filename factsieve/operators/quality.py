"""Declarative data-quality rules: each is a predicate that gives an issue row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.numbers import finite
from factsieve.functions.text import is_blank

#: Required fields, alternatives and identities by sheet.
REQUIRED = {
    "document_meta": ["지자체명", "계획명", "계획시작연도", "계획종료연도"],
    "plan_overview": ["개요유형", "항목명", "항목값"],
    "regional_conditions": ["지표명", "값"],
    "emissions_regional": ["배출유형", "부문", "연도", "배출량", "단위"],
    "emissions_management": ["관리부문", "직간접구분", "연도", "배출량", "단위"],
    "emissions_forecast": ["시나리오", "연도", "전망값", "단위"],
    "reduction_targets": ["목표수준", "기준연도", "목표연도"],
    "vision_strategy": ["전략수준"],
    "mitigation_projects": ["사업명", "부문"],
    "annual_implementation": ["사업명"],
    "quantitative_reductions": ["사업명", "연도", "예상감축량", "단위"],
    "financial_plan": ["사업명", "연도", "예산액", "예산단위"],
    "foundation_measures": ["대응기반영역", "과제명"],
    "governance_feedback": ["거버넌스기구", "역할"],
    "monitoring_performance": ["점검연도", "사업명", "이행실적"],
    "changes_actions": ["점검연도", "사업명"],
}
ALTERNATIVES = {"vision_strategy": ["전략명", "비전문구"], "annual_implementation": ["연간계획", "목표물량"], "reduction_targets": ["목표감축량", "목표배출량", "감축률(%)"], "changes_actions": ["변경사유", "지연미달성사유", "조치계획"]}
IDENTITIES = {
    "financial_plan": ["지자체명", "계획구분", "부문", "사업명", "재원구분", "연도"],
    "quantitative_reductions": ["지자체명", "사업명", "관리번호", "연도", "모니터링인자"],
    "emissions_regional": ["지자체명", "인벤토리출처", "배출범위", "배출유형", "부문", "세부부문", "연도"],
    "emissions_management": ["지자체명", "인벤토리출처", "관리부문", "세부부문", "직간접구분", "연도"],
    "emissions_forecast": ["지자체명", "전망범위", "시나리오", "부문", "세부부문", "연도"],
}
VALUES = {"financial_plan": "예산액", "quantitative_reductions": "예상감축량", "emissions_regional": "배출량", "emissions_management": "배출량", "emissions_forecast": "전망값"}
MONEY_WORDS = ["원", "천원", "만원", "백만원", "억원", "조원", "krw"]
NON_MONEY = ["tco2eq", "천톤co2eq", "톤co2eq", "만톤", "tco2", "개", "개소", "개소(가구)", "가구", "일", "%", "명", "대", "kwh", "mwh"]
UNSTATED = ["원문에단위표기없음", "단위미상", "미상", "미표기", "단위미표기", "알수없음"]


@dataclass(frozen=True)
class Rule:
    """A rule finds a row faulty where ``predicate`` holds; null counts as not."""

    id: str
    field: str
    predicate: Column
    certainty: str = "confirmed"
    severity: str = "error"


def unit_norm(col: Column) -> Column:
    """Unit without case, spaces, brackets, the word for unit and a last full stop."""
    out = F.regexp_replace(F.lower(col), r"[\s\[\]()]+", "")
    return F.regexp_replace(F.regexp_replace(out, "^단위[:：]?", ""), r"\.$", "")


def sheet_rules(sheet: str, columns: list[str], page_count: Column | None = None, municipality: str | None = None) -> list[Rule]:
    """The rules of a sheet over the columns it has."""
    have = set(columns)
    rules = [Rule("required.missing", c, is_blank(F.col(c).cast("string"))) for c in REQUIRED.get(sheet, []) if c in have]
    options = [c for c in ALTERNATIVES.get(sheet, []) if c in have]
    if options:
        rules.append(Rule("required.one_of", ",".join(options), reduce(lambda a, b: a & b, [is_blank(F.col(c).cast("string")) for c in options])))
    for c in columns:
        text = F.col(c).cast("string")
        if c in ("배출량", "전망값", "기준배출량", "목표배출량", "목표감축량", "예상감축량", "예산액", "감축률(%)"):
            rules.append(Rule("type.numeric", c, ~is_blank(text) & finite(F.col(c)).isNull()))
        if c.endswith("연도") or c in ("기간시작", "기간종료"):
            years = F.regexp_extract_all(text, F.lit("([0-9]{4})"), 1)
            outside = F.exists(years, lambda y: ~y.cast("int").between(1800, 2200))
            residue = F.regexp_replace(F.regexp_replace(text, r"[0-9]{4}(\.0)?", ""), r"[\s,;/\[\]년~–-]", "")
            many = F.lit(c != "목표연도") & (F.size(years) > 1)
            rules.append(Rule("time.invalid_year", c, ~is_blank(text) & ((F.size(years) == 0) | outside | many | (residue != ""))))
    for a, b in (("계획시작연도", "계획종료연도"), ("기간시작", "기간종료"), ("기준연도", "목표연도")):
        if {a, b} <= have:
            rules.append(Rule("time.reversed_period", b, finite(F.col(a)) > finite(F.col(b))))
    if municipality and "지자체명" in have:
        from factsieve.functions.codes import same_city

        rules.append(Rule("context.municipality_mismatch", "지자체명", ~is_blank(F.col("지자체명")) & ~same_city(F.lit(municipality), F.col("지자체명")), "suspected", "warning"))
    if sheet == "financial_plan" and "예산단위" in have:
        u = unit_norm(F.col("예산단위"))
        strange = ~is_blank(F.col("예산단위")) & ~u.isin(MONEY_WORDS)
        bad = u.isin(NON_MONEY) | F.contains(u, F.lit("co2"))
        rules += [Rule("budget.non_money_unit", "예산단위", strange & bad), Rule("budget.unit_unassessed", "예산단위", strange & ~bad & u.isin(UNSTATED), "unassessed", "warning"), Rule("budget.unknown_unit", "예산단위", strange & ~bad & ~u.isin(UNSTATED), "suspected", "warning")]
    if sheet in ("emissions_regional", "emissions_management", "emissions_forecast", "quantitative_reductions") and "단위" in have:
        rules.append(Rule("emissions.unit_dimension", "단위", ~is_blank(F.col("단위")) & ~F.contains(F.translate(unit_norm(F.col("단위")), "₂", "2"), F.lit("co2")), "suspected", "warning"))
    if page_count is not None and "출처페이지" in have:
        p = F.col("출처페이지").try_cast("int")
        rules.append(Rule("provenance.invalid_page", "출처페이지", (p < 1) | (p > page_count)))
    return rules


def evaluate(df: DataFrame, sheet: str, rules: list[Rule], row_id: str) -> DataFrame:
    """(rule_id, sheet, row_id, field, certainty, severity) of every violated rule: one projection over one scan."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(r.predicate, F.lit(False)), F.struct(F.lit(r.id).alias("rule_id"), F.lit(r.field).alias("field"), F.lit(r.certainty).alias("certainty"), F.lit(r.severity).alias("severity"))) for r in rules]))
    return df.select(F.col(row_id).alias("row_id"), F.inline(found)).select("rule_id", F.lit(sheet).alias("sheet"), "row_id", "field", "certainty", "severity")


def identity_issues(df: DataFrame, sheet: str, content: list[str], row_id: str) -> DataFrame:
    """Duplicate and conflict issues of a sheet's identity: (rule_id, sheet, row_id, n).

    Exact duplicates name the first row of each repeated content; value conflicts name the first row of each identity
    that has several distinct values. Both are aggregations with map-side combine.
    """
    value = VALUES[sheet]
    same = df.groupBy(*content).agg(F.min(row_id).alias("row_id"), F.count("*").alias("n")).filter("n > 1").select(F.lit("identity.exact_duplicate").alias("rule_id"), "row_id", "n")
    facts = df.filter(F.col(value).isNotNull()).groupBy(*IDENTITIES[sheet]).agg(F.min(row_id).alias("row_id"), F.count_distinct(value).alias("n")).filter("n > 1").select(F.lit("identity.value_conflict").alias("rule_id"), "row_id", "n")
    return same.unionByName(facts).select("rule_id", F.lit(sheet).alias("sheet"), "row_id", "n")


def deduplicate(issues: DataFrame) -> DataFrame:
    """Issues of one rule, sheet and field with their number and highest severity."""
    rank = F.when(F.col("severity") == "error", 2).when(F.col("severity") == "warning", 1).otherwise(0)
    return issues.groupBy("rule_id", "sheet", "field").agg(F.count("*").alias("occurrences"), F.max_by("severity", rank).alias("severity"))


def metric(numerator: Column, denominator: Column) -> Column:
    """Ratio to six places; null where there is nothing to divide by."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), 6)


def unpivot_cells(df: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """(row_no, field, value STRING)."""
    return df.select(F.col(row_id).alias("row_no"), *[F.col(f).cast("string").alias(f) for f in fields]).unpivot("row_no", fields, "field", "value")


def compare_storage(expected: DataFrame, saved: DataFrame) -> DataFrame:
    """(row_no, field, issue): cells that differ between two cell tables; numbers compare to 1e-14 relative.

    A full outer join on (row, field); a row missing on one side differs in each of its filled cells.
    """
    e = expected.select("row_no", "field", F.col("value").alias("_e"))
    s = saved.select("row_no", "field", F.col("value").alias("_s"))
    both = e.join(s, ["row_no", "field"], "full_outer")
    a, b = F.col("_e").try_cast("double"), F.col("_s").try_cast("double")
    near = F.coalesce(F.abs(a - b) <= F.greatest(F.abs(a), F.abs(b)) * 1e-14, F.lit(False))
    same = F.col("_e").eqNullSafe(F.col("_s")) | near | (is_blank(F.col("_e")) & is_blank(F.col("_s")))
    return both.filter(~same).select("row_no", "field", F.when(F.col("_e").isNull(), "storage.extra").when(F.col("_s").isNull(), "storage.missing").otherwise("storage.cell_mismatch").alias("issue"))
