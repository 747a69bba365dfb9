import pytest
from pyspark.sql import functions as F

from factsieve.functions import codes, geometry, ids, numbers, pages, similarity
from factsieve.functions.joins import skew_safe_join
from factsieve.functions.text import composed


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [("1,234.5", 1234.5), ("약 12", 12.0), ("", None), ("열", None), (None, None), ("-3", -3.0)])
def test_measure(spark, text, expected):
    assert one(spark, numbers.measure, text) == expected


@pytest.mark.parametrize("text,expected", [("−2.5", "-2.500000"), ("1e3", None), (".5", "0.500000"), ("1,000", "1000.000000")])
def test_strict_decimal(spark, text, expected):
    got = one(spark, numbers.strict_decimal, text)
    assert (None if got is None else str(got)) == expected


def test_numbers_that_agree(spark):
    df = spark.createDataFrame([(100.0, 100.4), (100.0, 101.0), (0.0, 0.0), (5.0, 5000.0)], "a double, b double")
    got = df.select(numbers.same_number(F.col("a"), F.col("b")).alias("s"), numbers.same_but_scale(F.col("a"), F.col("b")).alias("t")).collect()
    assert [(r["s"], r["t"]) for r in got] == [(True, False), (False, False), (True, False), (False, True)]


@pytest.mark.parametrize("text,expected", [("3,5-7", [3, 5, 6, 7]), ("[12, 11]", [11, 12]), ("", []), ("9-2", []), ("1-99999", [])])
def test_page_set(spark, text, expected):
    assert one(spark, pages.page_set, text) == expected


def test_ids(spark):
    assert one(spark, ids.evidence_ids, "EV-p1|b,EV-p1") == ["ev-p1", "b"]
    assert one(spark, ids.project_id, "m1_007-a010") == "M1-7-A10"
    assert one(spark, ids.object_number, "[표 3-2] 배출량") == "3-2"


def test_codes(spark):
    assert one(spark, codes.sector, "A3 교통") == "수송"
    assert one(spark, lambda c: codes.axis("배출유형", c)["rejected"], "합계") == "합계"
    assert one(spark, codes.forecast_method, "회귀분석과 시계열") == "stat_time_series"


def test_iou_and_rotation(spark):
    box = "struct(0D AS x0, 0D AS y0, 10D AS x1, 10D AS y1)"
    half = "struct(5D AS x0, 0D AS y0, 15D AS x1, 10D AS y1)"
    r = spark.range(1).select(geometry.iou(F.expr(box), F.expr(half)).alias("i"), geometry.to_points(F.expr("struct(0D AS x0, 0D AS y0, 999D AS x1, 999D AS y1)"), F.lit(100.0), F.lit(200.0), F.lit(90)).alias("p")).first()
    assert round(r["i"], 4) == 0.3333
    assert r["p"].asDict() == {"x0": 0.0, "y0": 0.0, "x1": 100.0, "y1": 200.0}


def test_similarity(spark):
    df = spark.createDataFrame([("부문별 온실가스 배출량 추이", "온실가스 배출량 추이"), ("같다", "같다"), (None, "x")], "a string, b string")
    got = [r["s"] for r in df.select(similarity.caption_similarity("a", "b").alias("s")).collect()]
    assert got[0] == pytest.approx(9 / 12) and got[1] == 1.0 and got[2] == 0.0


def test_join_with_a_hot_key(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(3000)] + [("b", 1), ("c", 2), (None, 3)], "key string, id int")
    per_key = rows.groupBy("key").agg(F.count("*").alias("n"))
    assert skew_safe_join(rows, per_key, "key", "n").groupBy("key", "n").count().collect().__len__() == 3
    assert skew_safe_join(rows, per_key.filter("key != 'c'"), "key", "n", "left").filter("n IS NULL").count() == 2


@pytest.mark.parametrize("text", ["천tCO2eq", "백만 원 그루", "값x힣가", "없음", "plain", ""])
def test_composed_hangul(spark, text):
    import unicodedata

    df = spark.createDataFrame([(unicodedata.normalize("NFD", text), text)], "a string, b string")
    assert tuple(df.select(composed(F.col("a")), composed(F.col("b"))).first()) == (text, text)


def test_composed_of_open_syllable_and_null(spark):
    df = spark.createDataFrame([("처\u11ab", ), (None,)], "a string")
    assert [r[0] for r in df.select(composed(F.col("a"))).collect()] == ["천", None]
