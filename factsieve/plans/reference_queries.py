"""Queries for the operators of the document-fact engine, each over whole tables, with the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.codes import SECTOR
from factsieve.functions.geometry import iou
from factsieve.functions.ids import project_id
from factsieve.functions.numbers import strict_decimal, whole
from factsieve.functions.pages import page_digits
from factsieve.functions.similarity import bigrams, tokens
from factsieve.functions.storage import shared_dir
from factsieve.functions.text import alnum_fold
from factsieve.operators import clean, context, coverage, golden, guard, ledger, merge, objects, probe, quality, route
from factsieve.plans.tables import table
from factsieve.sources.html_tables import html_grid
from factsieve.streaming.ledger_stream import coalesce_stream

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


FOLD_SQL = "regexp_replace(lower({}), '[^0-9a-z가-힣]+', '', 'g')"
UNIT_SQL = r"regexp_replace(regexp_replace(replace(regexp_replace(lower({}), '\s+', '', 'g'), '₂', '2'), '㎡|m²|제곱미터', 'm2', 'g'), 'co2-eq|co2e$', 'co2eq', 'g')"
UNITS_SQL = "(VALUES " + ", ".join(f"('{k}', '{d}', {f})" for k, (d, f) in coverage.UNITS.items()) + ") AS {}(token, dim, factor)"
BLANK_SQL = r"coalesce(trim(regexp_replace({}::varchar, '[\s\pZ]+', ' ', 'g')) = '', true)"


def _plan_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financing facts as delivered in JSON text, and each stored row as a fact of its own, so that every status occurs."""
    raw = table(spark, sf_dir, "raw_extracts").filter("sheet_key = 'financial_plan'")
    p = F.from_json("payload", "`사업명` string, `연도` string, `예산액` string, `예산단위` string, `재원구분` string, `부문` string")
    facts = raw.select(F.concat(F.lit("r"), "raw_id").alias("fact_id"), "doc_id", p.alias("p")).select("fact_id", "doc_id", alnum_fold(F.col("p.사업명")).alias("name"), whole(F.col("p.연도")).alias("year"), strict_decimal(F.col("p.예산액")).alias("value"), F.col("p.예산단위").alias("unit"))
    return facts.unionByName(_saved_budgets(spark, sf_dir).select(F.concat(F.lit("p"), "row_id").alias("fact_id"), "doc_id", "name", "year", "value", "unit"))


def _saved_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "financial_plan").filter(F.col("예산액").isNotNull()).select("row_id", "doc_id", alnum_fold(F.col("사업명")).alias("name"), F.col("연도").alias("year"), F.col("예산액").cast("decimal(20,6)").alias("value"), F.col("예산단위").alias("unit"))


_FACTS_SQL = f"""saved AS (SELECT row_id, doc_id, {FOLD_SQL.format('"사업명"')} AS name, "연도" AS year, "예산액"::decimal(20,6) AS value, "예산단위" AS unit FROM financial_plan WHERE "예산액" IS NOT NULL),
facts AS (SELECT 'r' || raw_id AS fact_id, doc_id, {FOLD_SQL.format("payload ->> '$.사업명'")} AS name, try_cast(replace(payload ->> '$.연도', ',', '') AS int) AS year, try_cast(replace(payload ->> '$.예산액', ',', '') AS decimal(20,6)) AS value, payload ->> '$.예산단위' AS unit FROM raw_extracts WHERE sheet_key = 'financial_plan' UNION ALL SELECT 'p' || row_id, doc_id, name, year, value, unit FROM saved),
f AS (SELECT facts.*, coalesce(u.dim, 'literal:' || coalesce({UNIT_SQL.format("unit")}, '')) AS dim, value * coalesce(u.factor, 1) AS base FROM facts LEFT JOIN {UNITS_SQL.format("u")} ON u.token = {UNIT_SQL.format("unit")}),
s AS (SELECT saved.*, CASE WHEN trim(coalesce(unit, '')) <> '' THEN coalesce(u.dim, 'literal:' || {UNIT_SQL.format("unit")}) END AS dim, value * coalesce(u.factor, 1) AS base FROM saved LEFT JOIN {UNITS_SQL.format("u")} ON u.token = {UNIT_SQL.format("unit")}),
counts AS (SELECT fact_id, count(*) FILTER (s.name IS NOT NULL AND f.dim = s.dim AND f.base = s.base) AS good, count(*) FILTER (s.name IS NOT NULL AND f.dim = s.dim AND f.base IS DISTINCT FROM s.base) AS conflict, count(*) FILTER (s.name IS NOT NULL AND s.dim IS NULL) AS unclear, count(*) FILTER (s.name IS NOT NULL AND f.dim <> s.dim) AS unit FROM f LEFT JOIN s USING (doc_id, name, year) GROUP BY fact_id)
SELECT fact_id, CASE WHEN conflict > 0 THEN 'conflict_review' WHEN unit > 0 THEN 'unit_review' WHEN unclear > 0 THEN 'ambiguous_review' WHEN good > 0 THEN 'covered' ELSE 'absent' END AS status FROM counts"""


@query(f"WITH {_FACTS_SQL}")
def coverage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.reconcile(_plan_facts(spark, sf_dir), _saved_budgets(spark, sf_dir), ["doc_id", "name", "year"])


@query(f"SELECT status, count(*) AS n FROM (WITH {_FACTS_SQL}) GROUP BY status")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.status_summary(coverage_status(spark, sf_dir))


@query(f"""SELECT row_id, coalesce(u.dim, 'literal:' || {UNIT_SQL.format('"단위"')}) AS dimension, round("예상감축량" * coalesce(u.factor, 1), 3) AS base FROM quantitative_reductions LEFT JOIN {UNITS_SQL.format("u")} ON u.token = {UNIT_SQL.format('"단위"')}""")
def unit_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quantitative_reductions")
    return q.select("row_id", coverage.dimension(F.col("단위")).alias("dimension"), F.round(F.col("예상감축량") * coverage.factor(F.col("단위")).cast("double"), 3).alias("base"))


@query("""SELECT trim(coalesce("지자체명", '')) AS "지자체명", trim(coalesce("계획명", '')) AS "계획명", arg_min("지자체유형", row_id) FILTER ("지자체유형" IS NOT NULL) AS "지자체유형", arg_min("발간기관", row_id) FILTER ("발간기관" IS NOT NULL) AS "발간기관", arg_min("기준연도", row_id) FILTER ("기준연도" IS NOT NULL) AS "기준연도", min(row_id) AS row_id FROM document_meta GROUP BY 1, 2""")
def first_non_null_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "document_meta").select("row_id", "지자체명", "계획명", "지자체유형", "발간기관", "기준연도")
    return clean.first_non_null(meta, ["지자체명", "계획명"], "row_id")


_BLANKS = ["부문", "사업명", "예산단위", "근거ID", "출처페이지"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS field, count(*) AS n_rows, count(*) FILTER ({BLANK_SQL.format(f'"{c}"')}) AS n_blank, round(count(*) FILTER ({BLANK_SQL.format(f'"{c}"')}) / count(*), 6) AS blank_rate FROM financial_plan""" for c in _BLANKS))
def key_blank_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.key_blank_stats(table(spark, sf_dir, "financial_plan"), _BLANKS)


_SECTOR_CASE = lambda t: f"CASE {t} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SECTOR.items()) + " END"
_SECTOR_SQL = f"coalesce({_SECTOR_CASE('t')}, {_SECTOR_CASE('bare')}, CASE WHEN length(t) <= 40 THEN t END)"


@query(f"""SELECT row_id, {_SECTOR_SQL} AS "부문", CASE WHEN e IN ('직접배출', '간접배출', '흡수원') THEN e END AS "배출유형" FROM (SELECT row_id, trim("부문") AS t, trim(regexp_replace(trim("부문"), '^[0-9A-Z]+[A-Za-z0-9]*\\s+', '')) AS bare, CASE trim("배출유형") WHEN '직접 배출' THEN '직접배출' WHEN '직접배출량' THEN '직접배출' WHEN '간접 배출' THEN '간접배출' WHEN '간접배출량' THEN '간접배출' WHEN '흡수' THEN '흡수원' WHEN '흡수량' THEN '흡수원' ELSE trim("배출유형") END AS e FROM emissions_regional WHERE "배출량" IS NOT NULL)""")
def clean_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sheet(table(spark, sf_dir, "emissions_regional"), "emissions_regional").select("row_id", "부문", "배출유형")


@query()
def contract_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "emissions_regional").select("doc_id", "배출유형", "부문", "세부부문", "연도", "배출량", "단위", F.col("근거ID").alias("evidence"), F.col("row_id").alias("seq"))
    out = clean.contract_dedup(e, ["doc_id", "배출유형", "부문", "세부부문", "연도"], "배출량", ids=("evidence",))
    return out.select("doc_id", "부문", "연도", "배출량", "seq", F.col("_copies").alias("n_copies"), F.array_join("evidence", "|").alias("evidence"), F.col("_conflict").alias("conflict"))


_MERGED = ["doc_id", "관리번호", "사업명", "연도", "예상감축량", "단위"]


@query(f"""SELECT min(row_id) AS first_seq, count(*) AS n_rows, coalesce(array_to_string(list_sort(list(DISTINCT "근거ID") FILTER ("근거ID" IS NOT NULL)), '|'), '') AS evidence FROM quantitative_reductions GROUP BY {", ".join(f"nullif(\"{c}\"::varchar, '')" for c in _MERGED)}""")
def stable_fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quantitative_reductions")
    return merge.stable_merge(q, _MERGED, ["근거ID"], "row_id").select("first_seq", "n_rows", F.array_join("근거ID", "|").alias("evidence"))


_BUDGET = ["doc_id", "계획구분", "부문", "사업명", "재원구분", "연도", "예산단위"]


@query(f"""WITH f AS (SELECT {", ".join(f'"{c}"' for c in _BUDGET)}, "예산액" AS a, "출처페이지" AS b, min(row_id) AS id FROM financial_plan GROUP BY ALL)
SELECT x.id AS earlier, y.id AS later, concat_ws('|', CASE WHEN x.a <> y.a THEN '예산액' END, CASE WHEN x.b <> y.b THEN '출처페이지' END) AS differing FROM f x JOIN f y ON {" AND ".join(f'x."{c}" IS NOT DISTINCT FROM y."{c}"' for c in _BUDGET)} AND x.id < y.id WHERE x.a <> y.a OR x.b <> y.b""")
def merge_conflict_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = merge.conflict_pairs(table(spark, sf_dir, "financial_plan"), _BUDGET, ["예산액", "출처페이지"], "row_id")
    return pairs.select("earlier", "later", F.array_join("differing", "|").alias("differing"))


_SCOPE_KEYS, _SCOPE_OTHERS = ["doc_id", "목표수준", "부문", "기준연도", "목표연도", "단위"], ["기준배출량", "목표배출량", "출처페이지"]
_TIGHT = r"coalesce(regexp_replace(lower({}::varchar), '[\s\pZ]+', '', 'g'), '')"


@query(rf"""WITH t AS (SELECT row_id, "목표범위" AS scope, coalesce(trim("목표범위"), '') = '' AS blank, {" || chr(1) || ".join(_TIGHT.format(f'"{c}"') for c in [*_SCOPE_KEYS, "목표감축량"])} AS k, {", ".join(_TIGHT.format(f'"{c}"') + f" AS o{i}" for i, c in enumerate(_SCOPE_OTHERS))} FROM (SELECT * FROM reduction_targets UNION ALL SELECT * REPLACE (-row_id AS row_id, NULL AS "목표범위") FROM reduction_targets)),
p AS (SELECT a.row_id, b.scope, {" AND ".join(f"(a.o{i} = '' OR b.o{i} = '' OR a.o{i} = b.o{i})" for i in range(len(_SCOPE_OTHERS)))} AS fits FROM t a JOIN t b ON a.k = b.k WHERE a.blank AND NOT b.blank),
g AS (SELECT row_id, count(*) FILTER (fits) AS n, count(DISTINCT scope) FILTER (fits) AS scopes, min(scope) FILTER (fits) AS only_one FROM p GROUP BY row_id)
SELECT t.row_id, CASE WHEN NOT blank THEN 'known' WHEN n IS NULL THEN 'alone' WHEN scopes > 1 THEN 'ambiguous_blank_scope' WHEN n = 0 THEN 'scope_candidate_payload_conflict' WHEN n = 1 THEN 'absorbed' ELSE 'several' END AS scope_status, CASE WHEN NOT blank THEN scope WHEN n = 1 THEN only_one END AS target FROM t LEFT JOIN g USING (row_id)""")
def blank_scope_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target once as it is and once, under the negative id, without its scope."""
    t = table(spark, sf_dir, "reduction_targets")
    t = t.unionByName(t.withColumns({"row_id": -F.col("row_id"), "목표범위": F.lit(None).cast("string")}))
    out = merge.resolve_blank_scope(t, _SCOPE_KEYS, "목표감축량", "목표범위", _SCOPE_OTHERS, "row_id")
    return out.select("row_id", F.col("_scope_status").alias("scope_status"), F.col("_target").alias("target"))


_U = r"""regexp_replace(regexp_replace(regexp_replace(lower("예산단위"), '[\s\[\]()]+', '', 'g'), '^단위[:：]?', ''), '\.$', '')"""
_list = lambda xs: ", ".join(f"'{x}'" for x in xs)
_STRANGE = f"""NOT {BLANK_SQL.format('"예산단위"')} AND {_U} NOT IN ({_list(quality.MONEY_WORDS)})"""
_BAD = f"""({_U} IN ({_list(quality.NON_MONEY)}) OR contains({_U}, 'co2'))"""


@query(" UNION ALL ".join([f"""SELECT 'required.missing' AS rule_id, 'financial_plan' AS sheet, '{c}' AS field, count(*) AS occurrences, 'error' AS severity FROM financial_plan WHERE {BLANK_SQL.format(f'"{c}"')} HAVING count(*) > 0""" for c in quality.REQUIRED["financial_plan"]] + [f"""SELECT 'time.invalid_year', 'financial_plan', '연도', count(*), 'error' FROM financial_plan WHERE "연도" NOT BETWEEN 1800 AND 2200 HAVING count(*) > 0""", f"""SELECT 'budget.non_money_unit', 'financial_plan', '예산단위', count(*), 'error' FROM financial_plan WHERE {_STRANGE} AND {_BAD} HAVING count(*) > 0""", f"""SELECT 'budget.unknown_unit', 'financial_plan', '예산단위', count(*), 'warning' FROM financial_plan WHERE {_STRANGE} AND NOT {_BAD} AND {_U} NOT IN ({_list(quality.UNSTATED)}) HAVING count(*) > 0"""]))
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "financial_plan").drop("출처페이지")
    issues = quality.evaluate(plan, "financial_plan", quality.sheet_rules("financial_plan", plan.columns), "row_id")
    return quality.deduplicate(issues)


_IDENT = quality.IDENTITIES["financial_plan"]
_Q = ", ".join(f'"{c}"' for c in _IDENT)


@query(f"""SELECT 'identity.exact_duplicate' AS rule_id, 'financial_plan' AS sheet, min(row_id) AS row_id, count(*) AS n FROM financial_plan GROUP BY {_Q}, "예산액", "예산단위" HAVING count(*) > 1 UNION ALL SELECT 'identity.value_conflict', 'financial_plan', min(row_id), count(DISTINCT "예산액") FROM financial_plan WHERE "예산액" IS NOT NULL GROUP BY {_Q} HAVING count(DISTINCT "예산액") > 1""")
def identity_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.identity_issues(table(spark, sf_dir, "financial_plan"), "financial_plan", [*_IDENT, "예산액", "예산단위"], "row_id")


@query("""WITH e AS (SELECT row_id AS row_no, "예상감축량" AS v FROM quantitative_reductions), s AS (SELECT row_id AS row_no, CASE WHEN "단위" = 'tCO2' THEN "예상감축량" + 1 WHEN "단위" IS NULL THEN NULL ELSE "예상감축량" END AS v FROM quantitative_reductions)
SELECT row_no, '예상감축량' AS field, CASE WHEN e.v IS NULL THEN 'storage.extra' WHEN s.v IS NULL THEN 'storage.missing' ELSE 'storage.cell_mismatch' END AS issue FROM e FULL JOIN s USING (row_no) WHERE e.v IS DISTINCT FROM s.v""")
def storage_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quantitative_reductions").select("row_id", "예상감축량", "단위")
    changed = q.withColumn("예상감축량", F.when(F.col("단위").isNull(), None).when(F.col("단위") == "tCO2", F.col("예상감축량") + 1).otherwise(F.col("예상감축량")))
    return quality.compare_storage(quality.unpivot_cells(q, "row_id", ["예상감축량"]), quality.unpivot_cells(changed, "row_id", ["예상감축량"]))


@query("""WITH e AS (SELECT g.row_id AS g_row, o.row_id AS o_row, coalesce(o."배출량"::varchar, '') || '|' || coalesce(o."단위", '') AS p FROM emissions_regional g JOIN emissions_regional o ON g.doc_id = o.doc_id AND g."연도" = o."연도" AND g."배출유형" = o."배출유형" AND (coalesce(g."부문", '') = '' OR coalesce(o."부문", '') = '' OR g."부문" = o."부문") AND (coalesce(g."세부부문", '') = '' OR coalesce(o."세부부문", '') = '' OR g."세부부문" = o."세부부문")),
d AS (SELECT o_row, count(*) AS d FROM e GROUP BY o_row), p AS (SELECT g_row, min(e.o_row) AS o_row, count(DISTINCT p) AS n, max(d) AS d FROM e JOIN d USING (o_row) GROUP BY g_row)
SELECT row_id AS g_row, CASE WHEN n = 1 AND d = 1 THEN o_row END AS o_row, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 AND d = 1 THEN 'matched' ELSE 'ambiguous' END AS status FROM emissions_regional LEFT JOIN p ON g_row = row_id""")
def golden_unique_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "emissions_regional")
    return golden.unique_graph(e, e, ["doc_id", "연도", "배출유형"], ["부문", "세부부문"], ["배출량", "단위"], "row_id")


_FIFO = """(SELECT g.row_id AS g_row, o.row_id AS o_row FROM (SELECT row_id, doc_id, "연도" AS y, row_number() OVER (PARTITION BY doc_id, "연도" ORDER BY row_id) AS n FROM quantitative_reductions WHERE doc_id IS NOT NULL AND "연도" IS NOT NULL) g JOIN (SELECT row_id, doc_id, "연도" AS y, row_number() OVER (PARTITION BY doc_id, "연도" ORDER BY row_id) AS n FROM financial_plan WHERE doc_id IS NOT NULL AND "연도" IS NOT NULL) o USING (doc_id, y, n))"""


@query(f"SELECT * FROM {_FIFO}")
def golden_strict_fifo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.strict_fifo(table(spark, sf_dir, "quantitative_reductions"), table(spark, sf_dir, "financial_plan"), ["doc_id", "연도"], "row_id")


@query(f"""WITH m AS (SELECT * FROM {_FIFO}), c AS (SELECT f.field, trim(CASE f.field WHEN '사업명' THEN q."사업명" ELSE q."지자체명" END) AS g, m.o_row, trim(CASE f.field WHEN '사업명' THEN p."사업명" ELSE p."지자체명" END) AS o FROM quantitative_reductions q CROSS JOIN (VALUES ('사업명'), ('지자체명')) f(field) LEFT JOIN m ON m.g_row = q.row_id LEFT JOIN financial_plan p ON p.row_id = m.o_row)
SELECT field, count(*) FILTER (g <> '') AS golden_cells, count(*) FILTER (o_row IS NOT NULL AND g <> '' AND o <> '') AS both, count(*) FILTER (o_row IS NOT NULL AND g <> '' AND o <> '' AND regexp_replace(lower(g), '\\s+', '', 'g') = regexp_replace(lower(o), '\\s+', '', 'g')) AS equal, count(*) FILTER (o_row IS NOT NULL AND g <> '' AND coalesce(o, '') = '') AS golden_only, count(*) FILTER (o_row IS NOT NULL AND coalesce(g, '') = '' AND o <> '') AS output_only FROM c GROUP BY field""")
def golden_cell_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, o = table(spark, sf_dir, "quantitative_reductions"), table(spark, sf_dir, "financial_plan")
    return golden.cell_tally(golden_strict_fifo(spark, sf_dir), g, o, ["사업명", "지자체명"], "row_id")


@query()
def golden_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.relaxed_kernel(table(spark, sf_dir, "quantitative_reductions"), table(spark, sf_dir, "financial_plan"), ["doc_id", "연도"], "사업명", "row_id")


@query()
def golden_scope_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "reduction_targets")
    p = F.from_json("payload", "`목표수준` string, `목표범위` string, `부문` string, `기준연도` string, `목표연도` string")
    g = table(spark, sf_dir, "raw_extracts").filter("sheet_key = 'reduction_targets'").select(F.col("raw_id").alias("row_id"), "doc_id", p.alias("p")).select("row_id", "doc_id", "p.목표수준", "p.목표범위", "p.부문", whole(F.col("p.기준연도")).alias("기준연도"), whole(F.col("p.목표연도")).alias("목표연도"))
    return golden.scope_match(g, t, ["doc_id", "목표수준", "부문", "기준연도", "목표연도"], ["doc_id", "부문", "목표연도"], "목표범위", "row_id")


_SETS = {"tokens": r"list_distinct(regexp_extract_all(lower({}), '[\pL\pN]+'))", "bigrams": r"list_distinct([substr(t, i, 2) for i in range(1, length(t))])"}


@query(r"""WITH g AS (SELECT substr(catalog_id, 2)::bigint AS g_row, list_distinct(regexp_extract_all(lower("사업명"), '[\pL\pN]+')) AS a FROM project_catalog), o AS (SELECT row_id AS o_row, list_distinct(regexp_extract_all(lower("사업명"), '[\pL\pN]+')) AS b FROM appendix4_projects WHERE "사업명" IS NOT NULL), p AS (SELECT g_row, o_row, len(list_intersect(a, b)) AS i, len(a) + len(b) AS n FROM g, o) SELECT g_row, o_row, round(i / (n - i), 6) AS similarity FROM p WHERE i > 0 AND i / (n - i) >= 0.6""")
def token_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "project_catalog").select(F.substring("catalog_id", 2, 10).cast("bigint").alias("row_id"), tokens(F.col("사업명")).alias("items"))
    o = table(spark, sf_dir, "appendix4_projects").filter(F.col("사업명").isNotNull()).select("row_id", tokens(F.col("사업명")).alias("items"))
    return golden.similar_pairs(g, o, [], "items", golden.TOKEN_JACCARD, "row_id").withColumn("similarity", F.round("similarity", 6))


_BIGRAMS = """WITH g AS MATERIALIZED (SELECT substr(catalog_id, 2)::bigint AS g_row, regexp_replace(lower("사업명"), '\\s+', '', 'g') AS t FROM project_catalog), o AS (SELECT row_id AS o_row, regexp_replace(lower("사업명"), '\\s+', '', 'g') AS t FROM appendix4_projects WHERE "사업명" IS NOT NULL), gs AS (SELECT g_row, list_distinct([substr(t, i, 2) for i in range(1, length(t))]) AS a FROM g), os AS (SELECT o_row, list_distinct([substr(t, i, 2) for i in range(1, length(t))]) AS b FROM o), p AS (SELECT g_row, o_row, len(list_intersect(a, b)) AS i, len(a) + len(b) AS n FROM gs, os), s AS MATERIALIZED (SELECT g_row, o_row, i / (n - i) AS similarity FROM p WHERE i > 0 AND i / (n - i) >= 0.3)"""


def _bigram_inputs(spark: SparkSession, sf_dir: str) -> tuple:
    """The arguments of a bigram match of catalogue and project names: names as they are, so that each is cut and compared once."""
    g = table(spark, sf_dir, "project_catalog").select(F.substring("catalog_id", 2, 10).cast("bigint").alias("row_id"), "사업명")
    o = table(spark, sf_dir, "appendix4_projects").select("row_id", "사업명")
    return g, o, [], "사업명", golden.BIGRAM_JACCARD, "row_id", bigrams


@query(_BIGRAMS + " SELECT g_row, o_row, round(similarity, 6) AS similarity FROM s")
def bigram_jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.similar_pairs(*_bigram_inputs(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


@query(_BIGRAMS + ", tg AS (SELECT g_row, max(similarity) AS m, count(*) FILTER (similarity = x) AS n FROM (SELECT *, max(similarity) OVER (PARTITION BY g_row) AS x FROM s) GROUP BY g_row), t_o AS (SELECT o_row, max(similarity) AS m, count(*) FILTER (similarity = x) AS n FROM (SELECT *, max(similarity) OVER (PARTITION BY o_row) AS x FROM s) GROUP BY o_row) SELECT s.g_row, s.o_row, round(s.similarity, 6) AS similarity FROM s JOIN tg ON tg.g_row = s.g_row AND tg.m = s.similarity AND tg.n = 1 JOIN t_o ON t_o.o_row = s.o_row AND t_o.m = s.similarity AND t_o.n = 1")
def mutual_best_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.mutual_best(golden.similar_sets(*_bigram_inputs(spark, sf_dir))).withColumn("similarity", F.round("similarity", 6))


#: Words that route pages to subjects: strong, weak and negative ones.
ROUTES = [("emissions_regional", ["배출량", "간접배출"], ["기준연도", "천톤CO2eq"], ["예산"]), ("reduction_targets", ["목표", "감축수단"], ["2030년", "줄이는"], ["설문"]), ("financial_plan", ["예산", "재원"], ["국비", "시비", "백만원"], ["배출계수"]), ("monitoring_performance", ["이행점검", "달성률"], ["정상추진", "지연"], ["전망"])]


def _routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROUTES, "sheet string, strong array<string>, weak array<string>, negative array<string>")


_ROUTES_SQL = "(VALUES " + ", ".join(f"('{s}', [{_list(a)}], [{_list(b)}], [{_list(c)}])" for s, a, b, c in ROUTES) + ") r(sheet, strong, weak, negative)"
_HEAD = r"'^\s*(제\s*[0-9]+\s*[장절]|[0-9]+(\.[0-9]+)*[.)]?\s|[가-하][.)]\s|#)'"
_SCORES = f"""scores AS (SELECT sheet, doc_id, (3 * len([w for w in strong if contains(text, w)]) + len([w for w in weak if contains(text, w)]) + 2 * len([l for l in string_split(substr(text, 1, 1200), chr(10))[1:18] if (regexp_matches(l, {_HEAD}) OR length(trim(l)) <= 36) AND trim(l) <> '' AND len([w for w in list_concat(strong, weak) if contains(l, w)]) > 0]) - 2 * len([w for w in negative if contains(text, w)]))::int AS score FROM documents, {_ROUTES_SQL} WHERE text IS NOT NULL)"""


@query(f"WITH {_SCORES} SELECT * FROM scores WHERE score >= 3")
def page_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select("doc_id", "text")
    return route.page_scores(pages, _routes(spark)).filter(F.col("score") >= route.MIN_SCORE).select("sheet", "doc_id", "score")


@query("""WITH a AS (SELECT DISTINCT plan_id, page_number AS p FROM documents WHERE plan_id IS NOT NULL AND contains(text, '달성률')) SELECT DISTINCT 'monitoring_performance' AS sheet, d.plan_id, d.page_number FROM documents d JOIN a ON a.plan_id = d.plan_id AND d.page_number BETWEEN a.p - 1 AND a.p + 1""")
def context_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("plan_id", "page_number", "text")
    anchors = pages.filter(F.col("plan_id").isNotNull() & F.contains("text", F.lit("달성률"))).select(F.lit("monitoring_performance").alias("sheet"), "plan_id", "page_number")
    return route.with_context(anchors, pages, "plan_id", "page_number")


TERMS = [("financial_plan", "예산"), ("financial_plan", "재원"), ("financial_plan", "국비"), ("emissions_regional", "배출량"), ("emissions_regional", "간접배출"), ("reduction_targets", "목표"), ("reduction_targets", "감축"), ("monitoring_performance", "점검"), ("monitoring_performance", "달성률")]
_TERMS_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TERMS) + ") t(sheet, term)"


@query(f"""WITH c AS (SELECT doc_id, section_name AS x, 3.0::double AS w FROM documents UNION ALL SELECT doc_id, text, 2.0 FROM documents), s AS (SELECT doc_id, sheet, sum(w) AS score FROM c JOIN {_TERMS_SQL} ON contains(x, term) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, sheet DESC) AS n, lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, sheet DESC) AS second FROM s) SELECT doc_id, sheet, score, coalesce(second, 0) AS runner_up FROM r WHERE n = 1 AND score >= 5 AND score - coalesce(second, 0) >= 1.5""")
def semantic_target_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    channels = d.select("doc_id", F.col("section_name").alias("text"), F.lit(3.0).alias("weight")).unionByName(d.select("doc_id", "text", F.lit(2.0).alias("weight")))
    return route.semantic_targets(channels, spark.createDataFrame(TERMS, "sheet string, term string"), ["doc_id"])


@query("""SELECT doc_id, floor((row_number() OVER (PARTITION BY plan_id ORDER BY doc_id) - 1) / 20)::int AS batch_no FROM documents""")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.batches(table(spark, sf_dir, "documents"), ["plan_id"], "doc_id", 20).select("doc_id", "batch_no")


_PAGE_FORMS = "(SELECT 'plain' AS form, text FROM documents UNION ALL SELECT 'titled', '그림 목 차' || chr(10) || text FROM documents UNION ALL SELECT 'listed', regexp_replace(text, '(?m)^(.*)$', '표 1 \\1 ..... 7', 'g') FROM documents)"
_LINES = r"[l for l in [trim(regexp_replace(x, '[\s\pZ]+', ' ', 'g')) for x in regexp_split_to_array(text, '\r\n|[\n\r]')] if l <> '']"
_LISTED = r"[l for l in ls if regexp_matches(l, '^[<\[(]?\s*(표|그림|figure)\s*[0-9]', 'i')]"


@query(rf"""WITH p AS (SELECT form, {_LINES} AS ls FROM {_PAGE_FORMS}), k AS (SELECT form, [k for k in [CASE WHEN regexp_full_match(l, '표\s*(목\s*차|차\s*례)|tables?', 'i') THEN 'table_index' WHEN regexp_full_match(l, '(그림|도|사진)\s*(목\s*차|차\s*례)|figures?', 'i') THEN 'figure_index' WHEN regexp_full_match(l, '목\s*차|차\s*례|contents?', 'i') THEN 'contents' END for l in ls[1:3]] if k IS NOT NULL][1] AS title, len({_LISTED}) AS n, len([l for l in {_LISTED} if regexp_matches(l, '(\.{{3,}}|·{{4,}}|…{{2,}})\s*[0-9]+\s*$')]) AS leaders FROM p)
SELECT form, coalesce(title, CASE WHEN n >= 8 AND leaders >= 4 THEN 'contents' END, 'none') AS kind, count(*) AS n FROM k GROUP BY 1, 2""")
def toc_page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of pages: as they are, with a title put before them, and with every line as an entry of a list."""
    d = table(spark, sf_dir, "documents")
    forms = F.array(F.struct(F.lit("plain").alias("form"), F.col("text")), F.struct(F.lit("titled").alias("form"), F.concat(F.lit("그림 목 차\n"), "text").alias("text")), F.struct(F.lit("listed").alias("form"), F.regexp_replace("text", "(?m)^(.*)$", "표 1 $1 ..... 7").alias("text")))
    pages = d.select(F.inline(forms))
    return pages.groupBy("form", F.coalesce(route.index_page_kind(F.col("text")), F.lit("none")).alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH q AS (SELECT doc_id, "연도" AS y, "예상감축량" AS v, "출처페이지" AS p, "근거ID" AS e FROM quantitative_reductions UNION ALL SELECT doc_id, "목표연도", "목표감축량" * 1.003, "출처페이지", "근거ID" FROM reduction_targets)
SELECT DISTINCT t.row_id FROM reduction_targets t JOIN q ON t.doc_id = q.doc_id AND t."목표연도" = q.y AND abs(t."목표감축량" - q.v) / greatest(abs(t."목표감축량"), abs(q.v), 1.0) <= 0.005 WHERE (trim(t."근거ID") <> '' AND t."근거ID" = q.e) OR (t."출처페이지" = q.p AND trim(t."목표수준") = '연차경로')""")
def leakage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that a quantitative row repeats: same year and number, and the same evidence, or the same page of a yearly path.

    Beside the table's own rows, the targets themselves stand among the quantitative ones, with numbers a little larger.
    """
    t, q = table(spark, sf_dir, "reduction_targets"), table(spark, sf_dir, "quantitative_reductions")
    columns = ["doc_id", "연도", "예상감축량", "출처페이지", "근거ID"]
    other = q.select(*columns).unionByName(t.select("doc_id", F.col("목표연도").alias("연도"), (F.col("목표감축량") * 1.003).alias("예상감축량"), "출처페이지", "근거ID"))
    residual = ((F.trim("근거ID") != "") & (F.col("근거ID") == F.col("_r_근거ID"))) | ((F.col("출처페이지") == F.col("_r_출처페이지")) & (F.trim("목표수준") == "연차경로"))
    return guard.duplicated_elsewhere(t, other, [("doc_id", "doc_id"), ("목표연도", "연도")], ("목표감축량", "예상감축량"), "row_id", residual, ("근거ID", "출처페이지"))


@query(r"""WITH p AS (SELECT doc_id, text, [[c for c in string_split(l, '|')] for l in string_split(text, chr(10))] AS rows FROM documents), t AS (SELECT *, CASE WHEN len([r for r in rows if len(r) > 1]) >= 2 THEN 'table' ELSE 'text' END AS kind, list_max([len(r) for r in rows]) AS width, flatten(rows) AS cells FROM p), c AS (SELECT *, len([c for c in cells if trim(regexp_replace(c, '[\s\pZ]+', ' ', 'g')) <> '']) AS filled FROM t),
s AS (SELECT doc_id, kind, CASE WHEN kind = 'text' THEN CASE WHEN length(trim(coalesce(text, ''))) >= 80 THEN 0.98 WHEN length(trim(coalesce(text, ''))) >= 20 THEN 0.78 ELSE 0.25 END ELSE greatest(0, 0.96 - CASE WHEN filled / len(cells) < 0.7 THEN 0.3 ELSE 0 END - CASE WHEN len([r for r in rows if len(r) <> width]) / len(rows) > 0.25 THEN 0.25 ELSE 0 END - CASE WHEN filled < 4 THEN 0.35 ELSE 0 END - CASE WHEN len(rows) >= 45 OR width >= 12 THEN 0.18 ELSE 0 END) END::double AS confidence FROM c)
SELECT doc_id, kind AS object_type, round(confidence, 4) AS confidence, CASE WHEN kind = 'table' AND confidence < 0.78 THEN 'ocr_required' ELSE 'native_keep' END AS action FROM s""")
def object_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence and action for every page as one object, a table where two lines or more have cells."""
    d = table(spark, sf_dir, "documents")
    rows = F.transform(F.split("text", "\n"), lambda l: F.split(l, r"\|"))  # noqa: E741
    typed = d.select("doc_id", "text", rows.alias("rows")).withColumn("object_type", F.when(F.size(F.filter("rows", lambda r: F.size(r) > 1)) >= 2, "table").otherwise("text"))
    no = F.lit(False)
    scored = typed.withColumns({"confidence": objects.native_confidence(F.col("object_type"), F.col("text"), F.col("rows"), no, F.lit(None).cast("string")), "signals": objects.data_signals(F.col("text")), "negative": F.filter(F.array(*[F.lit(w) for w in objects.NEGATIVE_SIGNALS]), lambda w: F.contains(F.col("text"), w)), "render_proxy": no, "index_caption": no})
    return objects.triage(scored).select("doc_id", "object_type", "confidence", "action")


@query("""WITH r AS (SELECT "목표수준" AS sheet, 'no_target_quantity' AS reason FROM reduction_targets WHERE "목표감축량" IS NULL AND "목표배출량" IS NULL UNION ALL SELECT "목표수준", 'visual_metric_label_as_sector' FROM reduction_targets WHERE regexp_matches("부문", '배출량|감축량|비율|증감|%') UNION ALL SELECT "목표수준", 'no_scope' FROM reduction_targets WHERE "목표범위" IS NULL) SELECT sheet, reason, count(*) AS n FROM r GROUP BY CUBE (sheet, reason)""")
def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = guard.target_reasons() | {"no_scope": F.col("목표범위").isNull()}
    _, rejected = guard.quarantine(table(spark, sf_dir, "reduction_targets"), reasons)
    return guard.summarize(rejected, "목표수준")


@query()
def containment_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.containment_quarantine(table(spark, sf_dir, "quantitative_reductions"), ["doc_id", "관리번호", "연도"], "사업명", "예상감축량", "row_id")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS scope FROM events""")
def asof_heading_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = context.nearest_preceding(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", F.col("event_id"))
    return out.select("event_id", "scope")


@query("""WITH c AS (SELECT doc_id, "지자체명" AS v, 'meta' AS s FROM document_meta UNION ALL SELECT doc_id, "지자체명", 'plan' FROM financial_plan UNION ALL SELECT doc_id, "지자체명", 'emissions' FROM emissions_regional) SELECT doc_id, CASE count(DISTINCT v) WHEN 0 THEN 'missing' WHEN 1 THEN 'resolved' ELSE 'held' END AS status, CASE WHEN count(DISTINCT v) = 1 THEN min(v) END AS value, count(DISTINCT CASE WHEN v IS NOT NULL THEN s END) AS n_sources FROM c GROUP BY doc_id""")
def claim_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"document_meta": "meta", "financial_plan": "plan", "emissions_regional": "emissions"}
    claims = None
    for t, s in names.items():
        part = table(spark, sf_dir, t).select("doc_id", F.col("지자체명").alias("value"), F.lit(s).alias("source"))
        claims = part if claims is None else claims.unionByName(part)
    return context.claim_agreement(claims, ["doc_id"], "value", "source")


_CELLS = r"regexp_split_to_array(l, '\s*[|;\t]\s*')"


@query(rf"""WITH ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, n, {_CELLS} AS cells FROM ls), h AS (SELECT *, list_contains([trim(x) for x in cells], '사업명') AS is_h FROM c), w AS (SELECT *, last_value(CASE WHEN is_h THEN cells END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS hd FROM h), f AS (SELECT doc_id, n, trim(cells[list_position([trim(x) for x in hd], '사업명')]) AS name, hd, cells, generate_subscripts(cells, 1) AS i FROM w WHERE NOT is_h AND hd IS NOT NULL)
SELECT doc_id, n - 1 AS row_no, i - 1 AS column_no, name, try_cast(regexp_extract(hd[i], '^\s*((19|20)[0-9][0-9])년?\s*$', 1) AS int) AS year, trim(cells[i]) AS raw_value FROM f WHERE name <> '' AND name NOT IN ('합계', '소계', '계', '총계') AND regexp_matches(hd[i], '^\s*((19|20)[0-9][0-9])년?\s*$') AND trim(cells[i]) NOT IN ('', '-', '—', '–', '미정', '미표기', '없음', 'n/a')""")
def wide_to_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda l: F.split(l, r"\s*[|;\t]\s*"))  # noqa: E741
    grids = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select("doc_id", lines.alias("rows"))
    return coverage.itemize(grids, ["doc_id"]).select("doc_id", F.col("row_no").cast("bigint").alias("row_no"), F.col("column_no").cast("bigint").alias("column_no"), "name", "year", "raw_value")


@query("""SELECT "번호" AS unit_no, 1 AS row_no, unnest([1, 2, 3]) - 1 AS column_no, unnest(["부문", "감축사업명", trim(coalesce("단위", ''))]) AS value FROM appendix3_reduction_units UNION ALL SELECT "번호", 0, unnest([1, 2, 3]) - 1, unnest(['부문', '감축사업명', '단위']) FROM appendix3_reduction_units""")
def html_table_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "appendix3_reduction_units")
    cells = F.concat(*[F.concat(F.lit("<td>"), F.coalesce(c, F.lit("")), F.lit("</td>")) for c in ("부문", "감축사업명", "단위")])
    html = F.concat(F.lit("<table><tr><th>부문</th><th>감축사업명</th><th>단위</th></tr><tr>"), cells, F.lit("</tr></table>"))
    grids = units.select(F.col("번호").alias("unit_no"), html_grid(html).alias("g"))
    rows = grids.select("unit_no", F.posexplode("g.rows").alias("row_no", "cells"))
    return rows.select("unit_no", "row_no", F.posexplode("cells").alias("column_no", "value"))


@query("""WITH b AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity AS x0, l_quantity + 20 AS x1, l_discount * 100 AS y0, l_discount * 100 + 8 AS y1 FROM lineitem), p AS (SELECT a.k, a.n AS left_no, c.n AS right_no, greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0) * greatest(least(a.y1, c.y1) - greatest(a.y0, c.y0), 0) AS i FROM b a JOIN b c ON a.k = c.k AND a.n < c.n) SELECT k AS orderkey, left_no, right_no, round(i / (320 - i), 6) AS iou FROM p WHERE i / (320 - i) >= 0.55""")
def object_iou_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.struct(F.col("l_quantity").alias("x0"), (F.col("l_quantity") + 20).alias("x1"), (F.col("l_discount") * 100).alias("y0"), (F.col("l_discount") * 100 + 8).alias("y1"))
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("left_no"), box.alias("a"))
    b = a.select("orderkey", F.col("left_no").alias("right_no"), F.col("a").alias("b"))
    return a.join(b, "orderkey").filter("left_no < right_no").select("orderkey", "left_no", "right_no", F.round(iou(F.col("a"), F.col("b")), 6).alias("iou")).filter(F.col("iou") >= objects.IOU_CANDIDATE)


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_status, bool_or(event_type = 'ok') AS ever_ok, count(*) AS attempts FROM events GROUP BY user_id""")
def ledger_last_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return ledger.last_status(e, "user_id", "at", "event_type")


def _as_ledger(e: DataFrame) -> DataFrame:
    """Events as a ledger: a purchase is an ok, others are failures; an event with a value has payload."""
    return e.select(F.col("user_id").alias("batch_id"), F.col("event_id").alias("line_no"), F.when(F.col("event_type") == "purchase", "ok").when(F.col("value") > 0, "partial").otherwise("call_fail").alias("status"), F.when(F.col("value") > 0, F.array(F.col("event_type"))).otherwise(F.array().cast("array<string>")).alias("payload"))


@query()
def ledger_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.coalesce_ledger(_as_ledger(table(spark, sf_dir, "events"))).withColumn("payload", F.array_join("payload", "|"))


@query()
def ledger_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream that ends: the last update of each batch."""
    out = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    stream = _as_ledger(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))

    def save(df: DataFrame, batch: int) -> None:
        df.withColumn("at", F.lit(batch)).write.mode("append").parquet(f"{out}/rows")

    coalesce_stream(stream).writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.groupBy("batch_id").agg(*[F.max_by(c, "at").alias(c) for c in ("status", "payload", "recovered")]).withColumn("payload", F.array_join("payload", "|"))


@query("""SELECT c_custkey, CASE WHEN s = 'purchase' THEN 'restore' WHEN s IS NULL THEN 'execute' ELSE 'retry' END AS decision FROM customer LEFT JOIN (SELECT user_id, arg_max(event_type, (ts, event_id)) AS s FROM events GROUP BY user_id) ON user_id = c_custkey""")
def resume_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = ledger_last_status(spark, sf_dir).select(F.col("user_id").alias("c_custkey"), F.when(F.col("last_status") == "purchase", "ok").otherwise(F.col("last_status")).alias("status"))
    return ledger.resume(table(spark, sf_dir, "customer").select("c_custkey"), last, "c_custkey")


@query("""SELECT o_orderkey, running_cost::bigint AS running_cost FROM (SELECT o_orderkey, sum(floor(o_totalprice)::bigint) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS running_cost FROM orders) WHERE running_cost <= 500000""")
def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = table(spark, sf_dir, "orders").withColumn("cost", F.floor("o_totalprice"))
    return ledger.within_budget(calls, "o_custkey", "o_orderkey", "cost", 500_000).select("o_orderkey", "running_cost")


@query("""WITH a AS (SELECT payload ->> '$.부문' AS g, doc_id, try_cast(replace(payload ->> '$.목표연도', ',', '') AS int) AS y, min(try_cast(replace(payload ->> '$.기준배출량', ',', '') AS decimal(20,6))::double) AS va FROM raw_extracts WHERE sheet_key = 'reduction_targets' GROUP BY ALL), b AS (SELECT "부문" AS g, doc_id, "목표연도" AS y, min("기준배출량") AS vb, 1 AS h FROM reduction_targets GROUP BY ALL), j AS (SELECT coalesce(a.g, b.g) AS g, va, vb, a.doc_id IS NOT NULL AS ha, b.h IS NOT NULL AS hb FROM (SELECT * FROM a) a FULL JOIN b ON a.g = b.g AND a.doc_id = b.doc_id AND a.y = b.y)
SELECT g AS "부문", count(*) FILTER (ha AND hb) AS shared, count(*) FILTER (NOT hb) AS only_a, count(*) FILTER (NOT ha) AS only_b, count(*) FILTER (ha AND hb AND abs(va - vb) <= 0.005 * greatest(abs(va), abs(vb), 1)) AS agree, round(count(*) FILTER (ha AND hb AND abs(va - vb) <= 0.005 * greatest(abs(va), abs(vb), 1)) / nullif(count(*) FILTER (ha AND hb), 0), 6) AS rate FROM j GROUP BY g""")
def probe_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("payload", "`부문` string, `목표연도` string, `기준배출량` string")
    a = table(spark, sf_dir, "raw_extracts").filter("sheet_key = 'reduction_targets'").select("doc_id", p.alias("p")).select("doc_id", "p.부문", whole(F.col("p.목표연도")).alias("목표연도"), strict_decimal(F.col("p.기준배출량")).cast("double").alias("기준배출량"))
    return probe.agreement(a, table(spark, sf_dir, "reduction_targets"), ["doc_id", "목표연도"], "부문", "기준배출량")


@query("""SELECT "계획구분", count(*) AS n_rows, round((count(*) FILTER (trim("사업명") <> '') + count(*) FILTER ("연도" IS NOT NULL) + count(*) FILTER ("예산액" IS NOT NULL)) / (count(*) * 3), 6) AS required_rate, round((count(*) FILTER (trim("부문") <> '') + count(*) FILTER (trim("비고") <> '')) / (count(*) * 2), 6) AS optional_rate FROM financial_plan GROUP BY 1""")
def probe_fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probe.fill_rates(table(spark, sf_dir, "financial_plan"), "계획구분", ["사업명", "연도", "예산액"], ["부문", "비고"])


@query("""SELECT source, lang, count(*) AS n, count(*) FILTER (n_chars > 500) AS hits, round(count(*) FILTER (n_chars > 500) / count(*), 6) AS rate FROM documents GROUP BY ROLLUP (source, lang)""")
def score_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.score_rollup(table(spark, sf_dir, "documents"), ["source", "lang"], F.col("n_chars") > 500)


SOURCE_GROUPS = {"native_table": "text_side", "native_text": "text_side", "ocr_table": "visual_side", "ocr_text": "visual_side", "visual": "visual_side"}


@query("""WITH e AS (SELECT unnest([x for x in ["추출원천", CASE WHEN "추출원천" IN ('native_table', 'native_text') THEN 'text_side' WHEN "추출원천" IN ('ocr_table', 'ocr_text', 'visual') THEN 'visual_side' END] if x IS NOT NULL]) AS grp, "예산액" FROM financial_plan) SELECT grp, count(*) AS n, count(*) FILTER ("예산액" > 0) AS hits FROM e GROUP BY grp""")
def source_group_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.source_groups(table(spark, sf_dir, "financial_plan"), "추출원천", SOURCE_GROUPS, F.col("예산액") > 0)


@query(r"""WITH ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL) SELECT doc_id, line_no, last_value(CASE WHEN regexp_matches(l, '^\s*(제\s*[0-9]+\s*[장절]|[0-9]+\.\s|#+\s)') THEN trim(l) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM ls""")
def section_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").filter(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return objects.sections(lines, "doc_id", ["line_no"], "line").select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "section")


@query("""SELECT row_id, array_to_string(list_sort(list_distinct([x::int for x in regexp_extract_all("출처페이지", '[0-9]+') if x::int > 0])), ',') AS pages FROM financial_plan WHERE "출처페이지" IS NOT NULL""")
def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = table(spark, sf_dir, "financial_plan").filter(F.col("출처페이지").isNotNull())
    return plan.select("row_id", F.array_join(page_digits(F.col("출처페이지")).cast("array<string>"), ",").alias("pages"))


@query(r"""SELECT row_id, regexp_replace(replace(upper(trim("관리번호")), '_', '-'), '(^|[^0-9])0+([0-9]+)', '\1\2', 'g') AS project_id FROM quantitative_reductions""")
def project_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "quantitative_reductions").select("row_id", project_id(F.col("관리번호")).alias("project_id"))


@query("""SELECT "번호" AS unit_no, unnest(range(1, len(string_split("모니터링인자", ';')) + 1))::int AS item, trim(unnest(string_split("모니터링인자", ';'))) AS factor_name FROM appendix3_reduction_units""")
def factor_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "appendix3_reduction_units")
    return units.select(F.col("번호").alias("unit_no"), F.posexplode(F.split("모니터링인자", ";")).alias("i", "x")).select("unit_no", (F.col("i") + 1).alias("item"), F.trim("x").alias("factor_name"))


@query("""WITH k AS (SELECT row_id, f.field, f.v FROM quantitative_reductions, LATERAL (VALUES ('활동량', "활동량"), ('예상감축량', "예상감축량")) f(field, v)) SELECT field, count(v) AS n_values, count(*) AS n_rows, round(count(v) / count(*), 6) AS rate FROM k GROUP BY field""")
def value_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "quantitative_reductions").select("row_id", "활동량", "예상감축량").unpivot("row_id", ["활동량", "예상감축량"], "field", "v")
    return q.groupBy("field").agg(F.count("v").alias("n_values"), F.count("*").alias("n_rows"), quality.metric(F.count("v"), F.count("*")).alias("rate"))
