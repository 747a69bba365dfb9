"""Source coverage: wide tables to facts, unit-exact reconciliation with stored rows, and status precedence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Dimension and factor of a unit token. CO2 and CO2eq are different dimensions.
UNITS = {"m2": ("area", 1), "ha": ("area", 10000), "kw": ("power", 1), "mw": ("power", 1000), "그루": ("trees", 1), "천그루": ("trees", 1000), "원": ("krw", 1), "천원": ("krw", 1000), "백만원": ("krw", 1000000), "억원": ("krw", 100000000), "tco2eq": ("co2eq", 1), "톤co2eq": ("co2eq", 1), "천톤co2eq": ("co2eq", 1000), "천tco2eq": ("co2eq", 1000), "tco2": ("co2", 1), "톤co2": ("co2", 1), "천톤co2": ("co2", 1000)}
#: Headers that name a field.
HEADER_FIELD = {"사업명": "name", "과제명": "name", "세부사업명": "name", "연도": "year", "단위": "unit", "예상감축량": "reduction", "감축량": "reduction", "예산액": "budget", "사업비": "budget", "활동량": "activity", "구분": "context", "재원구분": "context"}


def unit_token(col: Column) -> Column:
    out = F.regexp_replace(F.lower(col), r"\s+", "")
    out = F.regexp_replace(F.regexp_replace(F.translate(out, "₂", "2"), "㎡|m²|제곱미터", "m2"), "co2-eq|co2e$", "co2eq")
    return out


def dimension(col: Column) -> Column:
    """Dimension of a unit; an unknown unit is a dimension of its own."""
    token = unit_token(col)
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, (d, _) in UNITS.items() for x in (k, d)]), token), F.concat(F.lit("literal:"), token))


def factor(col: Column) -> Column:
    """Whole factor of a unit to the base of its dimension, as DECIMAL(15,0), so that products lose no digit."""
    table = F.create_map(*[F.lit(x) for k, (_, f) in UNITS.items() for x in (k, f)])
    return F.coalesce(F.element_at(table, unit_token(col)), F.lit(1)).cast("decimal(15,0)")


def reconcile(facts: DataFrame, saved: DataFrame, key: list[str], pages: str | None = None) -> DataFrame:
    """Facts with the first status that holds: conflict_review, unit_review, ambiguous_review, covered or absent.

    Both sides have the key, value DECIMAL(20,6) and unit; facts have fact_id. Of the saved rows equal in the key, one with
    another amount in the same dimension is a conflict whatever else agrees; one in another dimension asks for a unit
    review; one without value or unit, or, where ``pages`` names an array column of both sides, without a common page, is
    ambiguous. Amounts are compared exactly after conversion. Saved rows are counted by key, dimension and amount first,
    so repeated ones multiply nothing; null keys match nothing.
    """
    blank = F.coalesce(F.trim("unit") == "", F.lit(True))
    side = lambda df, dim: df.withColumns({"_base": F.col("value") * factor(F.col("unit")), "_dim": F.when(~blank, dimension(F.col("unit"))).otherwise(F.lit(dim))})
    at = [pages] if pages else []
    f = side(facts, "literal:").select("fact_id", *[F.col(k).alias(f"_f_{k}") for k in key], F.col("_base").alias("f_base"), F.col("_dim").alias("f_dim"), *[F.col(c).alias("f_pages") for c in at])
    kept = [F.col(k).alias(f"_s_{k}") for k in key]
    s = side(saved, None).groupBy(*kept, F.col("_base").alias("s_base"), F.col("_dim").alias("s_dim"), *[F.array_sort(F.array_distinct(c)).alias("s_pages") for c in at]).agg(F.count("*").alias("n"))
    joined = f.join(s, reduce(lambda a, b: a & b, [F.col(f"_f_{k}") == F.col(f"_s_{k}") for k in key]), "left")
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    there, whole = F.col("n").isNotNull(), F.col("s_base").isNotNull() & F.col("s_dim").isNotNull()
    same = there & whole & (F.col("f_dim") == F.col("s_dim"))
    near = F.coalesce(F.arrays_overlap("f_pages", "s_pages"), F.lit(False)) if pages else F.lit(True)
    equal = F.coalesce(F.col("f_base") == F.col("s_base"), F.lit(False))
    counts = joined.groupBy("fact_id").agg(n(same & near & equal).alias("good"), n(same & near & ~equal).alias("conflict"), n(there & whole & (F.col("f_dim") != F.col("s_dim"))).alias("unit"), n(there & (~whole | (same & ~near))).alias("unclear"))
    status = F.when(F.col("conflict") > 0, "conflict_review").when(F.col("unit") > 0, "unit_review").when(F.col("unclear") > 0, "ambiguous_review").when(F.col("good") > 0, "covered").otherwise("absent")
    return counts.select("fact_id", status.alias("status"))


def stage_status(stages: list[tuple[str, DataFrame]], quarantined: DataFrame) -> DataFrame:
    """(fact_id, status): an absent fact is cleaning_excluded if quarantined, storage_review if an earlier stage covered it, else missing_candidate."""
    last_name, last = stages[-1]
    out = last.select("fact_id", F.col("status").alias("_last"))
    for i, (_, df) in enumerate(stages[:-1]):
        out = out.join(df.select("fact_id", F.col("status").alias(f"_s{i}")), "fact_id", "left")
    out = out.join(quarantined.select("fact_id").distinct().withColumn("_q", F.lit(True)), "fact_id", "left")
    earlier = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_s{i}") == "covered", F.lit(False)) for i in range(len(stages) - 1)]) if len(stages) > 1 else F.lit(False)
    status = F.when(F.col("_last") != "absent", F.col("_last")).when(F.col("_q"), "cleaning_excluded").when(earlier, "storage_review").otherwise("missing_candidate")
    return out.select("fact_id", status.alias("status"))


def itemize(tables: DataFrame, key: list[str]) -> DataFrame:
    """Facts of grids: (key…, row_no, column_no, name, year, field, raw_value, raw_unit, fact_id).

    ``tables`` has the key and rows ARRAY<ARRAY<STRING>>. A header row is one in which a name and a year or field header
    stand; the last header row at or above a row holds for it, repeated ones included. Cells under a year are facts of
    the row's name; subtotal rows and blank or dashed cells are left out.
    """
    rows = tables.select(*key, F.posexplode("rows").alias("row_no", "cells"))
    field_of = F.create_map(*[F.lit(x) for p in HEADER_FIELD.items() for x in p])
    name_at = F.array_position(F.transform("cells", lambda c: F.element_at(field_of, F.regexp_replace(c, r"\s+", "")) == "name"), True)
    is_header = (name_at > 0) & F.exists("cells", lambda c: c.rlike(r"^\s*(19|20)[0-9]{2}년?\s*$") | F.element_at(field_of, F.regexp_replace(c, r"\s+", "")).isNotNull())
    w = Window.partitionBy(*key).orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    with_header = rows.withColumn("_h", is_header).withColumn("header", F.last(F.when(F.col("_h"), F.col("cells")), ignorenulls=True).over(w)).filter(~F.col("_h") & F.col("header").isNotNull())
    at = lambda field: F.array_position(F.transform("header", lambda c: F.coalesce(F.element_at(field_of, F.regexp_replace(c, r"\s+", "")), F.lit("")) == field), True)
    cell = lambda position: F.when(position > 0, F.get("cells", (position - 1).cast("int")))
    named = with_header.select("*", F.trim(cell(at("name"))).alias("name"), F.trim(cell(at("unit"))).alias("raw_unit")).filter((F.col("name") != "") & ~F.col("name").rlike("^(합계|소계|계|총계)$"))
    exploded = named.select(*key, "row_no", "name", "raw_unit", "header", F.posexplode("cells").alias("column_no", "raw_value"))
    year = F.nullif(F.regexp_extract(F.get("header", F.col("column_no")), r"^\s*((?:19|20)[0-9]{2})년?\s*$", 1), F.lit("")).try_cast("int")
    facts = exploded.withColumn("year", year).filter(F.col("year").isNotNull() & ~F.trim("raw_value").isin("", "-", "—", "–", "미정", "미표기", "없음", "n/a"))
    return facts.select(*key, "row_no", "column_no", "name", "year", F.trim("raw_value").alias("raw_value"), "raw_unit", F.substring(F.sha2(F.to_json(F.struct(*key, "name", "year", "raw_value", "raw_unit")), 256), 1, 24).alias("fact_id"))


def embedded_unit(col: Column) -> Column:
    """The one known unit in a text's brackets; null where none or several stand."""
    found = F.array_distinct(F.filter(F.transform(F.regexp_extract_all(col, F.lit(r"[\[(]\s*(?:단위\s*[:：]?\s*)?([^\[\]()]+?)\s*[\])]"), 1), unit_token), lambda u: u.isin(list(UNITS))))
    return F.when(F.size(found) == 1, found[0])


def period_years(col: Column) -> Column:
    """Years of a span of a plan, its ends in four or two digits: 2024~2033, '24~'33."""
    lo = F.regexp_extract(col, r"((?:20)?[0-9]{2})\s*[~∼-]\s*['’]?((?:20)?[0-9]{2})", 1)
    hi = F.regexp_extract(col, r"((?:20)?[0-9]{2})\s*[~∼-]\s*['’]?((?:20)?[0-9]{2})", 2)
    full = lambda y: F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y).try_cast("int")
    return F.when((full(lo) <= full(hi)) & (full(hi) - full(lo) < 100), F.sequence(full(lo), full(hi)))


def spatial_unit(tables: DataFrame, notes: DataFrame, doc: str, page: str) -> DataFrame:
    """(object_id, unit): unit notes of the same document and page just above a table (-6 to 48 points) that overlap it across; only where all agree."""
    n = notes.select(F.col(doc).alias("_d"), F.col(page).alias("_p"), F.col("box").alias("_b"), "unit")
    near = tables.join(n, (F.col(doc) == F.col("_d")) & (F.col(page) == F.col("_p")) & (F.col("box.y0") - F.col("_b.y1")).between(-6, 48) & (F.least("box.x1", "_b.x1") > F.greatest("box.x0", "_b.x0")))
    return near.groupBy(doc, "object_id").agg(F.min("unit").alias("unit"), F.max("unit").alias("_m")).filter("unit = _m").select("object_id", "unit")


def funding_components(rows: DataFrame, key: list[str], order: str, name: str) -> DataFrame:
    """Number of the named row each unnamed row below belongs to: islands by a running count."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("island", F.sum(F.when(F.trim(F.coalesce(name, F.lit(""))) != "", 1).otherwise(0)).over(w))


def related(facts: DataFrame, distance: int = 2) -> DataFrame:
    """(fact_id, other_id): facts of one document, name and year within ``distance`` pages; the band joins by equality on page numbers."""
    a = facts.select("fact_id", "doc_id", "name", "year", F.explode(F.sequence(F.col("page") - distance, F.col("page") + distance)).alias("page"))
    b = facts.select(F.col("fact_id").alias("other_id"), "doc_id", "name", "year", "page")
    return a.join(b, ["doc_id", "name", "year", "page"]).filter("fact_id < other_id").select("fact_id", "other_id")


def status_summary(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count("*").alias("n"))
