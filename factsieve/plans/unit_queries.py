"""Queries for quantities in different units (problem 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factsieve.functions.joins import skew_safe_join
from factsieve.functions.storage import materialize
from factsieve.operators import units as U
from factsieve.operators.packed import source_class
from factsieve.plans.tables import table

#: A predicted unit is converted from this calibrated confidence on; below it the row goes to review.
CONFIDENT = 0.9
CATEGORIES = ["source", "계획구분", "재원구분", "sector", "doc_unit"]
NUMERIC = ["magnitude", "decimals", "zeros"]
REDUCTION_CATEGORIES, REDUCTION_NUMERIC = ["class", "doc_unit"], [*NUMERIC, "ratio"]


def stated_budgets(plan: DataFrame) -> DataFrame:
    """Budget rows with the unit of their field or note read exactly: the columns of the plan that count, unit_read, factor, stated, won and origin."""
    return U.parse_money(plan.select("row_id", "doc_id", "계획구분", "재원구분", "부문", "추출원천", "예산액", "예산단위", "비고"), "예산액", "예산단위", "비고")


def _budget_features(plan: DataFrame) -> DataFrame:
    """Stated budgets as rows of the classifier."""
    rows = stated_budgets(plan).select(F.col("row_id").cast("string").alias("rec_key"), "doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("계획구분", "재원구분")], F.regexp_replace(F.coalesce("부문", F.lit("")), "부문$", "").alias("sector"), source_class(F.col("추출원천")).alias("source"), *[c.alias(k) for k, c in _number_features(F.col("예산액")).items()], "unit_read", "factor", "stated", "won", "origin")
    # Read once and kept: a filter on the parsed columns would otherwise be pushed below the parser and repeat it.
    return materialize(rows, "units")


def _with_prevailing(rows: DataFrame, every: DataFrame) -> DataFrame:
    """``rows`` with doc_unit: the prevailing factor of the other rows of their document in ``every``, blank without any.

    Of each document only its two most frequent factors are kept, so that a row's own may be taken out; the join is
    balanced by the documents' rows.
    """
    counted = every.filter("factor IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id", "factor").agg(F.count("*").alias("_n"))
    first = counted.groupBy("doc_id").agg(F.max(F.struct("_n", "factor")).alias("_a"), F.sum("_n").alias("_rows"))
    second = counted.join(first, "doc_id").filter(F.col("factor") != F.col("_a.factor")).groupBy("doc_id").agg(F.max(F.struct("_n", "factor")).alias("_b"))
    tops = first.join(second, "doc_id", "left")
    out = skew_safe_join(rows, tops, "doc_id", "_rows", how="left")
    left = F.col("_a._n") - F.when(F.col("factor") == F.col("_a.factor"), 1).otherwise(0)
    other = F.coalesce(F.col("_b._n") - F.when(F.col("factor") == F.col("_b.factor"), 1).otherwise(0), F.lit(0))
    unit = F.when((left >= other) & (left > 0), F.col("_a.factor")).when(other > 0, F.col("_b.factor"))
    return out.withColumn("doc_unit", F.coalesce(unit.cast("string"), F.lit(""))).drop("_a", "_b", "_rows")


def _fitted(rows: DataFrame, categories: list[str], numeric: list[str]) -> U.UnitModel | None:
    """The forest fitted on a bounded sample of the rows whose unit is known."""
    known = rows.filter("factor IS NOT NULL AND stated != 0")
    return U.fit_unit_model(_with_prevailing(U.bounded_sample(known), rows).withColumn("label", F.col("factor").cast("string")), categories, numeric)


def _decided(guessed: DataFrame, value: str) -> DataFrame:
    """(rec_key, unit, stated, value, origin, confidence): confident predictions converted, the others for review."""
    sure = (F.col("confidence") >= CONFIDENT) & F.col("predicted").isNotNull()
    return guessed.select("rec_key", F.when(sure, F.col("predicted")).alias("unit"), "stated", F.when(sure, F.col("stated") * F.col("predicted").cast("double")).alias(value), F.when(sure, "predicted").otherwise("review").alias("origin"), F.round("confidence", 4).alias("confidence"))


def budget_amounts(plan: DataFrame) -> DataFrame:
    """Budget rows in won: (rec_key, unit, stated, won, origin, confidence), one per row of ``plan``.

    A unit in the field or the note converts exactly. Where a value has no unit, the forest predicts one from magnitude,
    source, category and the prevailing unit of the document's other rows; from CONFIDENT on it converts (origin
    "predicted"), below it the row waits (origin "review"). Values absent, of other units, and zero keep their row.
    """
    rows = _budget_features(plan)
    features = rows.filter(F.col("origin").isin("field", "text", "none"))
    guessed = U.predict_units(_fitted(features, CATEGORIES, NUMERIC), _with_prevailing(features.filter("origin = 'none'"), features))
    stated = rows.filter("origin != 'none'").select("rec_key", F.col("unit_read").alias("unit"), "stated", "won", "origin", F.lit(1.0).alias("confidence"))
    return stated.unionByName(_decided(guessed, "won"))


def reduction_amounts(quant: DataFrame) -> DataFrame:
    """Expected reductions in kgCO2eq: (rec_key, unit, factor, kg, origin)."""
    unit = U.clean_unit(F.col("단위"))
    factor = U.emission_factor_kg(unit)
    origin = F.when(F.col("예상감축량").isNull(), "absent").when(unit.isNull(), "none").when(factor.isNull(), "other").otherwise("field")
    return quant.select(F.col("row_id").cast("string").alias("rec_key"), unit.alias("unit"), factor.alias("factor"), (F.col("예상감축량") * factor).alias("kg"), origin.alias("origin"))


def _number_features(value: Column) -> dict[str, Column]:
    """The NUMERIC features of a value."""
    text = F.abs(value).cast("decimal(38,8)").cast("string")
    part = lambda pattern: F.coalesce(F.length(F.regexp_extract(text, pattern, 1)), F.lit(0)).cast("double")
    return {"magnitude": F.coalesce(F.log10(F.abs(value) + 0.001), F.lit(-3.0)), "decimals": part(r"\.([0-9]*[1-9])"), "zeros": part(r"(0*)\.")}


def predicted_reductions(quant: DataFrame) -> DataFrame:
    """Expected reductions without a unit, in kgCO2eq: (rec_key, unit, stated, kg, origin, confidence).

    The forest is fitted on the rows with an emission unit and predicts from the value, what it is of its activity times
    its factor, the factor's sector and the document's prevailing unit; origin is "predicted" from
    CONFIDENT on, else "review".
    """
    unit = U.clean_unit(F.col("단위"))
    stated = F.col("예상감축량").cast("double")
    product = F.col("활동량").cast("double") * F.col("감축원단위값").cast("double")
    ratio = F.coalesce(F.log10(F.abs(stated) + 1e-9) - F.log10(F.abs(product) + 1e-9), F.lit(-99.0))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = quant.filter(stated.isNotNull()).select(F.col("row_id").cast("string").alias("rec_key"), "doc_id", F.regexp_extract(text("감축원단위ID"), "^([0-9]+)", 1).alias("class"), unit.alias("unit"), U.emission_factor_kg(unit).alias("factor"), stated.alias("stated"), ratio.alias("ratio"), *[c.alias(k) for k, c in _number_features(stated).items()])
    rows = materialize(rows, "reductions")
    guessed = U.predict_units(_fitted(rows, REDUCTION_CATEGORIES, REDUCTION_NUMERIC), _with_prevailing(rows.filter("unit IS NULL"), rows))
    return _decided(guessed, "kg")


def factor_amounts(units: DataFrame) -> DataFrame:
    """Emission factors in mgCO2eq per named quantity, one per list entry: (rec_key, item, unit, mg, base, origin)."""
    rows = units.select(F.col("번호").alias("rec_key"), F.split(F.coalesce("단위", F.lit("")), ";").alias("_u"), F.posexplode(F.split("원단위값", ";")).alias("_i", "_v"))
    own = U.clean_unit(F.get("_u", F.col("_i")))
    inside = U.clean_unit(F.regexp_replace("_v", r"^\s*-?[0-9][0-9,]*(?:\.[0-9]+)?", ""))
    value = F.regexp_replace(F.regexp_extract("_v", r"^\s*(-?[0-9][0-9,]*(?:\.[0-9]+)?)", 1), ",", "").try_cast("double")
    unit = F.coalesce(own, inside)
    factor = U.factor_mg(unit)
    origin = F.when(value.isNull(), "absent").when(unit.isNull(), "none").when(factor.isNull(), "other").when(own.isNotNull(), "field").otherwise("text")
    return rows.select("rec_key", (F.col("_i") + 1).cast("int").alias("item"), unit.alias("unit"), value.alias("stated"), (value * factor).alias("mg"), F.coalesce(U.is_base_factor(unit), F.lit(False)).alias("base"), origin.alias("origin"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = F.col("origin").isin("field", "text", "amount_text")
    million = F.coalesce(U.won_factor(F.col("unit")) == 1e6, F.lit(False))
    # The forest isn't fitted here: a value without any unit, all that it could add, is no case.
    money = stated_budgets(table(spark, sf_dir, "financial_plan")).select(F.col("row_id").cast("string").alias("rec_key"), F.col("unit_read").alias("unit"), "won", "origin")
    money = money.filter(stated & ~million).select(F.lit("financial_plan").alias("src"), "rec_key", F.lit(1).alias("item"), F.round("won").cast("bigint").alias("val"))
    quant = reduction_amounts(table(spark, sf_dir, "quantitative_reductions")).filter(stated & (F.col("factor") != 1000)).select(F.lit("quantitative_reductions").alias("src"), "rec_key", F.lit(1).alias("item"), F.round("kg").cast("bigint").alias("val"))
    units = factor_amounts(table(spark, sf_dir, "appendix3_reduction_units")).filter(stated & ~F.col("base")).select(F.lit("appendix3_reduction_units").alias("src"), "rec_key", "item", F.round("mg").cast("bigint").alias("val"))
    return money.unionByName(quant).unionByName(units)


def p7_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without a unit of all three tables: the predicted unit where confident, else for review.

    val is in won, kgCO2eq or mgCO2eq by table, as in p7_found. The list of factors is too short and its units too many
    to fit a forest on, so its entries without a unit all go to review.
    """
    open_ = F.col("origin").isin("predicted", "review")
    key = lambda src, item: [F.lit(src).alias("src"), "rec_key", item.alias("item")]
    money = budget_amounts(table(spark, sf_dir, "financial_plan")).filter(open_).select(*key("financial_plan", F.lit(1)), "unit", "stated", F.col("won").alias("val"), "origin", "confidence")
    quant = predicted_reductions(table(spark, sf_dir, "quantitative_reductions")).select(*key("quantitative_reductions", F.lit(1)), "unit", "stated", F.col("kg").alias("val"), "origin", "confidence")
    factors = factor_amounts(table(spark, sf_dir, "appendix3_reduction_units")).filter("origin = 'none'").select(*key("appendix3_reduction_units", F.col("item")), F.lit(None).cast("string").alias("unit"), "stated", F.lit(None).cast("double").alias("val"), F.lit("review").alias("origin"), F.lit(0.0).alias("confidence"))
    return money.unionByName(quant).unionByName(factors)


def p7_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget rows whose stated unit the forest contradicts with confidence, for review: (rec_key, stated, factor, predicted, confidence)."""
    rows = _budget_features(table(spark, sf_dir, "financial_plan"))
    features = rows.filter(F.col("origin").isin("field", "text", "none"))
    judged = U.predict_units(_fitted(features, CATEGORIES, NUMERIC), _with_prevailing(features.filter("factor IS NOT NULL AND stated != 0"), features))
    return judged.filter((F.col("confidence") >= CONFIDENT) & (F.col("predicted") != F.col("factor").cast("string"))).select("rec_key", "stated", "factor", "predicted", F.round("confidence", 4).alias("confidence"))


def p7_withheld(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the forest does on stated units withheld from it: every fifth document, of which no row was fitted or calibrated on.

    (n, n_confident, n_right): all such rows with a known unit, those converted, and those converted rightly.
    """
    rows = _budget_features(table(spark, sf_dir, "financial_plan")).filter(F.col("origin").isin("field", "text"))
    withheld = F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)) == 0, F.lit(False))
    model = _fitted(rows.filter(~withheld), CATEGORIES, NUMERIC)
    judged = U.predict_units(model, _with_prevailing(rows.filter(withheld & (F.col("stated") != 0)), rows))
    sure = F.col("confidence") >= CONFIDENT
    return judged.agg(F.count("*").alias("n"), F.count_if(sure).alias("n_confident"), F.count_if(sure & (F.col("predicted") == F.col("factor").cast("string"))).alias("n_right"))


QUERIES = {"p7_contradictions": p7_contradictions, "p7_withheld": p7_withheld, "p7_found": p7_found, "p7_predicted": p7_predicted}
