import pytest
from pyspark.sql import functions as F

from factsieve.operators import units
from factsieve.operators.packed import split_packed
from factsieve.plans.unit_queries import budget_amounts, factor_amounts, p7_predicted, reduction_amounts

PAGES = {1: ("86~88/90", [86, 87, 88, 90]), 2: ('["9", "9"]', [9, 9]), 3: ("표 3-2, 12쪽, 13쪽", [12, 13]), 4: ("표 3-2 (64쪽)", [64]), 5: ("p.91, p.97", [91, 97]), 6: ("50, 53 및 59", [50, 53, 59]), 7: ("15\n18", [15, 18]), 8: (None, None), 9: ("", None), 10: ("pp. 52∼53", [52, 53]), 11: ("9-2", [9, 2]), 12: ("1-6000", list(range(1, 6001))), 13: ("없음", None), 14: ("12쪽 참고", None), 15: ('"3, 4"; 5', None), 16: ('"7","8"', [7, 8]), 17: ("9" * 30, None)}


def test_pages_and_years(spark):
    df = spark.createDataFrame([(i, t, "s", "clash") for i, (t, _) in PAGES.items()], "row_id bigint, text string, source string, _raw string")
    got = {}
    for r in split_packed(df, "row_id", "text", "source", "page").orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["val"])
    assert got == {i: v for i, (_, v) in PAGES.items() if v}
    years = spark.createDataFrame([(1, "’30, ’50", None), (2, "2030(중기) / 2050(장기)", None), (3, "2030년, 2030년", "a")], "row_id bigint, text string, source string")
    rows = split_packed(years, "row_id", "text", "source", "year").orderBy("id", "pos").collect()
    assert [(r["id"], r["val"]) for r in rows] == [(1, 2030), (1, 2050), (2, 2030), (2, 2050), (3, 2030), (3, 2030)]


def test_empty_table(spark):
    assert split_packed(spark.createDataFrame([], "row_id bigint, text string, source string"), "row_id", "text", "source").count() == 0


@pytest.mark.parametrize("text,expected", [("백만 원", 1e6), ("[천원]", 1e3), ("원(KRW)", 1), ("단위 : 십억원", 1e9), ("억", 1e8), ("tCO2eq", None), ("천원/년", 1e3), ("-", None)])
def test_money_units(spark, text, expected):
    got = spark.createDataFrame([(text,)], "x string").select(units.won_factor(units.clean_unit(F.col("x"))).alias("y")).first()["y"]
    assert got == expected


@pytest.mark.parametrize("text,expected", [("천tCO₂-eq", 1e6), ("ｋｇＣＯ２ｅｑ", 1), ("GgCO2eq", 1e6), ("만 톤 CO₂eq", 1e7), ("tCO2", None), ("tϹO2еq", 1e3), ("1,000tCO2eq", 1e6)])
def test_emission_units(spark, text, expected):
    got = spark.createDataFrame([(text,)], "x string").select(units.emission_factor_kg(units.clean_unit(F.col("x"))).alias("y")).first()["y"]
    assert got == expected


PLAN = "row_id bigint, doc_id string, `계획구분` string, `재원구분` string, `부문` string, `추출원천` string, `예산액` double, `예산단위` string, `비고` string"


def test_amounts_in_notes(spark):
    rows = [(1, "d", "a", "b", "c", "s", None, None, "총사업비 2억 9,168만 원"), (2, "d", "a", "b", "c", "s", 5.0, "-", "※ 단위:천원"), (3, "d", "a", "b", "c", "s", 0.0, "억원", None), (4, "d", "a", "b", "c", "s", 7.0, "%", "(단위: 원)"), (5, "d", "a", "b", "c", "s", 3.0, None, None), (6, None, None, None, None, None, None, "천원", None)]
    got = {r["rec_key"]: (r["won"], r["origin"]) for r in budget_amounts(spark.createDataFrame(rows, PLAN)).collect()}
    assert got["1"] == (291680000.0, "amount_text") and got["2"] == (5000.0, "text") and got["3"] == (0.0, "field")
    assert got["4"] == (None, "other") and got["5"][1] in ("review", "predicted") and got["6"] == (None, "absent")


def test_empty_plan(spark):
    assert budget_amounts(spark.createDataFrame([], PLAN)).count() == 0


def test_missing_units_are_predicted(spark):
    rows = [(i, f"d{i % 3}", "a", "b", "c", "s", float(10 ** (i % 2 * 6) * (1 + i % 7)), ("백만원" if i % 2 == 0 else "원") if i > 40 else None, None) for i in range(1000)]
    got = budget_amounts(spark.createDataFrame(rows, PLAN)).filter("origin = 'predicted'").collect()
    assert len(got) >= 35 and all(float(r["unit"]) == (1e6 if r["stated"] < 100 else 1.0) for r in got)


def test_factors(spark):
    rows = [("1", "0.5 tCO2eq/MWh; 73.85", "; kgCO₂eq/ha"), ("2", "814,800", "kgCO2eq/GWh"), ("3", "1", None), ("4", None, "tCO2eq/kW"), ("5", "2", "tCO2/대")]
    df = spark.createDataFrame(rows, "`번호` string, `원단위값` string, `단위` string")
    got = {(r["rec_key"], r["item"]): (r["mg"] and round(r["mg"], 6), r["origin"]) for r in factor_amounts(df).collect()}
    assert got == {("1", 1): (500000.0, "text"), ("1", 2): (7385.0, "field"), ("2", 1): (814800.0, "field"), ("3", 1): (None, "none"), ("5", 1): (None, "other")}
    quant = spark.createDataFrame([(1, None, "천tCO2eq"), (2, 2.0, "kgCO2eq"), (3, 2.0, "")], "row_id bigint, `예상감축량` double, `단위` string")
    assert [(r["kg"], r["origin"]) for r in reduction_amounts(quant).orderBy("rec_key").collect()] == [(None, "absent"), (2.0, "field"), (None, "none")]


def test_every_value_without_a_unit_is_predicted_or_reviewed(spark, tmp_path):
    plan = [(i, f"d{i % 3}", "a", "b", "c", "s", float(10 ** (i % 2 * 6) * (1 + i % 7)), ("백만원" if i % 2 == 0 else "원") if i > 5 else None, None) for i in range(300)]
    spark.createDataFrame(plan, PLAN).write.parquet(str(tmp_path / "financial_plan.parquet"))
    quant = [(i, f"d{i % 3}", 10.0 + i % 9, 2.0, "1-2", (10.0 + i % 9) * 2 * (1000 if i % 2 else 1), ("kgCO2eq" if i % 2 else "tCO2eq") if i >= 40 else [None, " "][i % 3 % 2]) for i in range(1000)] + [(1000, None, None, None, None, 5.0, None), (1001, "d1", None, None, None, None, None)]
    spark.createDataFrame(quant, "row_id bigint, doc_id string, `활동량` double, `감축원단위값` double, `감축원단위ID` string, `예상감축량` double, `단위` string").write.parquet(str(tmp_path / "quantitative_reductions.parquet"))
    spark.createDataFrame([("1", "0.5; 7", "tCO2eq/kW; "), ("2", "3", None)], "`번호` string, `원단위값` string, `단위` string").write.parquet(str(tmp_path / "appendix3_reduction_units.parquet"))
    got = p7_predicted(spark, str(tmp_path)).collect()
    keys = lambda src: {(r["rec_key"], r["item"]) for r in got if r["src"] == src}
    assert keys("financial_plan") == {(str(i), 1) for i in range(6)}
    assert keys("quantitative_reductions") == {(str(i), 1) for i in [*range(40), 1000]}
    assert keys("appendix3_reduction_units") == {("1", 2), ("2", 1)}
    sure = [r for r in got if r["src"] == "quantitative_reductions" and r["origin"] == "predicted"]
    assert len(sure) >= 35 and all(float(r["unit"]) == (1.0 if int(r["rec_key"]) % 2 else 1000.0) and r["val"] == r["stated"] * float(r["unit"]) for r in sure)
