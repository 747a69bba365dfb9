"""Code books: sector, axis, status, type and forecast-method maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Other names of the eight sectors.
SECTOR = {"건물부문": "건물", "수송부문": "수송", "농업부문": "농축산", "농업": "농축산", "폐기물부문": "폐기물", "흡수": "흡수원", "산업부문": "산업", "에너지전환": "전환", "전환부문": "전환", "수소부문": "수소", "상업/공공": "건물", "상업·공공": "건물", "가정·상업": "건물", "가정/상업": "건물", "도로수송": "수송", "도로": "수송", "비도로수송": "수송", "에너지생산": "전환", "에너지 생산": "전환", "가정": "건물", "상업": "건물", "공공": "건물", "에너지": "전환", "전력": "전환", "열": "전환", "산업공정": "산업", "관리권한 배출량": "합계", "관리 권한 배출량": "합계", "교통": "수송", "교통부문": "수송", "탄소흡수": "흡수원", "탄소 흡수": "흡수원", "공원녹지": "흡수원", "공원·녹지": "흡수원", "순환경제": "폐기물", "자원순환": "폐기물", "도시건물": "건물", "수송교통": "수송"}
#: Emission types, direct or indirect, achievement states and project types.
EMISSION_TYPE = {"직접 배출": "직접배출", "직접배출량": "직접배출", "간접 배출": "간접배출", "간접배출량": "간접배출", "흡수": "흡수원", "흡수량": "흡수원"}
DIRECTNESS = {"direct": "직접", "직접배출": "직접", "직접 배출": "직접", "indirect": "간접", "간접배출": "간접", "간접 배출": "간접", "sink": "흡수", "absorption": "흡수", "흡수원": "흡수", "흡수량": "흡수", "direct+indirect": "직접+간접", "직접+간접배출": "직접+간접", "직접 및 간접": "직접+간접", "직접 + 간접": "직접+간접"}
AXIS = {"배출유형": ["직접배출", "간접배출", "흡수원"], "직간접구분": ["직접", "간접", "흡수", "직접+간접"]}
ACHIEVEMENT = {"달성": "달성", "완료": "달성", "목표달성": "달성", "정상추진": "정상추진", "정상 추진": "정상추진", "추진중": "정상추진", "지연": "지연", "일부지연": "지연", "미달성": "미달성", "미이행": "미달성", "중단": "미달성"}
PROJECT_TYPE = {"기존": "기존", "계속": "기존", "유지": "기존", "변경": "변경", "수정": "변경", "폐지": "변경", "신규": "신규", "추가": "신규", "새로운": "신규"}
#: The first keyword found decides the forecast method.
FORECAST_METHOD = [("시계열", "stat_time_series"), ("시계열분석", "stat_time_series"), ("회귀분석", "stat_regression"), ("회귀", "stat_regression"), ("증가율", "stat_growth_rate"), ("증가율분석", "stat_growth_rate"), ("LEAP", "bottom_up_accounting_LEAP"), ("MARKAL", "bottom_up_optimization_MARKAL")]
#: Names of one municipality.
CITIES = [["서울", "서울시", "서울특별시"], ["경기", "경기도"], ["강원도", "강원특별자치도"], ["부산", "부산시", "부산광역시"], ["인천", "인천시", "인천광역시"]]


def mapped(table: dict[str, str], col: Column) -> Column:
    """The code of a text, the trimmed text itself where the table has none."""
    key = F.trim(col)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key), key)


def sector(col: Column) -> Column:
    """Sector code of a text as it stands or behind a prefix code such as "1A3 "; other texts stay, unless of more than 40 characters."""
    text = F.trim(col)
    table = F.create_map(*[F.lit(x) for pair in SECTOR.items() for x in pair])
    bare = F.trim(F.regexp_replace(text, r"^[0-9A-Z]+[A-Za-z0-9]*\s+", ""))
    return F.coalesce(F.element_at(table, text), F.element_at(table, bare), F.when(F.length(text) <= 40, text))


def axis(field: str, col: Column) -> Column:
    """Struct (value, rejected): the axis value, blank with the original kept where it is outside the enumeration."""
    value = mapped(EMISSION_TYPE if field == "배출유형" else DIRECTNESS, F.when(F.lit(field == "배출유형"), col).otherwise(F.lower(col)))
    ok = value.isin(AXIS[field])
    return F.struct(F.when(ok, value).alias("value"), F.when(~ok & (F.trim(col) != ""), col).alias("rejected"))


def forecast_method(col: Column) -> Column:
    """Forecast method code by the first keyword, in the order of the table, that the text contains."""
    out = F.lit(None).cast("string")
    for word, code in reversed(FORECAST_METHOD):
        out = F.when(F.contains(col, F.lit(word)), F.lit(code)).otherwise(out)
    return out


def forecast_scope(col: Column) -> Column:
    """Scope of a forecast: the whole region or the area of authority; negated texts and others give null."""
    text = F.regexp_replace(col, r"\s+", "")
    return F.when(text.rlike("^(지역|지자체)?(전체|전역|총괄)$"), "지역전체").when(text.rlike("^관리권한(부문|범위|내)?$"), "관리권한")


def same_city(a: Column, b: Column) -> Column:
    """Whether two texts name one municipality."""
    canon = {name: names[0] for names in CITIES for name in names}
    key = lambda c: mapped(canon, F.regexp_replace(F.lower(c), r"\s+", ""))
    return key(a) == key(b)
