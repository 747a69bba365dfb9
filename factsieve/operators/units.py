"""Quantities in different units: parse the stated unit, convert, and predict the unit where none is stated."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factsieve.functions.text import composed, plain

#: Korean and numeric scale words.
SCALES = {"": 1, "1": 1, "십": 10, "10": 10, "백": 100, "100": 100, "천": 1e3, "1000": 1e3, "1천": 1e3, "만": 1e4, "1만": 1e4, "십만": 1e5, "10만": 1e5, "백만": 1e6, "1백만": 1e6, "100만": 1e6, "천만": 1e7, "억": 1e8, "1억": 1e8, "십억": 1e9, "10억": 1e9, "백억": 1e10, "천억": 1e11, "조": 1e12}
#: Kilograms in a mass word, in lower case. mt and gg are megatonnes and gigagrams.
MASS_KG = {"t": 1e3, "kg": 1.0, "g": 1e-3, "kt": 1e6, "mt": 1e9, "gg": 1e6, "gt": 1e12}
#: The named quantity and how many of it one unit of a denominator is.
PER = {"kw": 1.0, "mw": 1e3, "gw": 1e6, "kwh": 1.0, "mwh": 1e3, "gwh": 1e6, "m2": 1.0, "ha": 1e4, "km2": 1e6, "m3": 1.0, "kg": 1.0, "t": 1e3, "mj": 1.0, "gj": 1e3, "tj": 1e6, "km": 1.0, "그루": 1.0, "대": 1.0, "개": 1.0, "가구": 1.0, "건": 1.0}
_SCALE_WORDS = "|".join(sorted((k for k in SCALES if k), key=len, reverse=True))
_MASS_WORDS = "|".join(sorted(MASS_KG, key=len, reverse=True))


def _lookup(table: dict[str, float], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v))]), key)


def clean_unit(col: Column) -> Column:
    """A unit text without look-alikes, spaces, brackets, the word for unit, and the per-year mark; null where absent."""
    out = F.regexp_replace(F.lower(composed(plain(col))), r"[\s\p{Z}\[\]()（）{}<>「」※.]+", "")
    out = F.regexp_replace(out, "^(?:단위)?[:：]?", "")
    out = F.regexp_replace(F.regexp_replace(out, "(?<=[0-9]),(?=[0-9]{3})", ""), "/(?:년|yr|year)$", "")
    return F.when(out.isin("", "-", "—", "없음", "미정", "n/a"), None).otherwise(out)


#: Every spelling of a cleaned money unit and the won in it, by rule from the scale words.
WON = {f"{k}{w}": v for k, v in SCALES.items() for w in ("원", "원krw")} | {k: v for k, v in SCALES.items() if k.endswith(("억", "조"))} | {"krw": 1, "won": 1}


def won_factor(unit: Column) -> Column:
    """Won in one of a cleaned money unit; null where it is no money unit."""
    return _lookup(WON, unit)


def emission_factor_kg(unit: Column) -> Column:
    """Kilograms of CO2eq in one of a cleaned emission unit; null for CO2 alone and other units."""
    core = F.regexp_replace(F.regexp_replace(F.translate(unit, "₂", "2"), "킬로그램", "kg"), "톤", "t")
    pattern = f"^({_SCALE_WORDS})?({_MASS_WORDS})co2-?(?:eq|e)$"
    # Without a match both groups are empty, and no mass has an empty name.
    return _lookup(SCALES, F.regexp_extract(core, pattern, 1)) * _lookup(MASS_KG, F.regexp_extract(core, pattern, 2))


def factor_mg(unit: Column) -> Column:
    """Milligrams of CO2eq per named quantity in one of a cleaned factor unit; null where it is none."""
    core = F.regexp_replace(F.regexp_replace(F.translate(unit, "₂", "2"), "킬로그램", "kg"), "톤", "t")
    core = F.regexp_replace(F.regexp_replace(F.regexp_replace(core, "㎡|m²|m\\^2", "m2"), "㎥|m³|m\\^3", "m3"), "㏊", "ha")
    per = "|".join(sorted(PER, key=len, reverse=True))
    pattern = f"^({_MASS_WORDS})co2-?(?:eq|e)/({_SCALE_WORDS})?({per})$"
    value = _lookup(MASS_KG, F.regexp_extract(core, pattern, 1)) * F.lit(1e6)
    return F.when(core.rlike(pattern), value / (_lookup(SCALES, F.regexp_extract(core, pattern, 2)) * _lookup(PER, F.regexp_extract(core, pattern, 3))))


def is_base_factor(unit: Column) -> Column:
    """Whether a cleaned factor unit is tonnes per one named quantity, however spelled."""
    core = F.regexp_replace(F.translate(unit, "₂", "2"), "톤", "t")
    core = F.regexp_replace(F.regexp_replace(core, "㎡|m²", "m2"), "㎥|m³", "m3")
    return core.rlike("^tco2-?(?:eq|e)/(?:kw|kwh|m2|m3|kg|mj|km|그루|대|개|가구|건)$")


NUMBER = r"([0-9][0-9,]*(?:\.[0-9]+)?)"
UNIT_IN_TEXT = rf"(?:단위\s*[:：]?\s*|금액은\s*)((?:{_SCALE_WORDS})?\s*원|억)"
AMOUNT_IN_TEXT = rf"(?:{NUMBER}\s*조\s*)?(?:{NUMBER}\s*억\s*)?(?:{NUMBER}\s*(십만|백만|천만|만|천|십|백)?\s*)?원"


def _num(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def parse_money(df: DataFrame, amount: str, unit: str, note: str) -> DataFrame:
    """Add stated DOUBLE, unit_read STRING, factor DOUBLE, won DOUBLE, origin STRING to each row.

    Origin is "field" or "text" by where the unit stands, "amount_text" for a whole amount in the note where both the
    amount and its unit are absent, "other" for a unit of another kind, "none" without any unit, "absent" without a
    value. Columns are added step by step so that no expression is evaluated twice.
    """
    part = lambda i: F.nullif(F.regexp_extract("_note", AMOUNT_IN_TEXT, i), F.lit(""))
    steps: list[dict[str, Column]] = [
        {"_own": clean_unit(F.col(unit))},
        # Only a row without a unit of its own has its note read.
        {"_note": F.when(F.col("_own").isNull() & F.col(note).rlike(r"원|억|[\x{1100}-\x{11ff}]"), F.regexp_replace(composed(plain(F.col(note))), r"\s+", " "))},
        {"_noted": F.nullif(F.regexp_replace(F.regexp_extract("_note", UNIT_IN_TEXT, 1), " ", ""), F.lit("")), "_read": F.col("_note").isNotNull() & F.col(amount).isNull()},
        {"_jo": F.when(F.col("_read"), part(1)), "_eok": F.when(F.col("_read"), part(2)), "_rest": F.when(F.col("_read"), part(3)), "_scale": F.when(F.col("_read"), part(4))},
        {"_in_text": F.coalesce("_jo", "_eok", "_rest").isNotNull(), "_used": F.coalesce("_own", "_noted")},
        {"_whole": F.when(F.col("_in_text"), F.coalesce(_num(F.col("_jo")) * 1e12, F.lit(0.0)) + F.coalesce(_num(F.col("_eok")) * 1e8, F.lit(0.0)) + F.coalesce(_num(F.col("_rest")) * _lookup(SCALES, F.coalesce("_scale", F.lit(""))), F.lit(0.0)))},
        {"unit_read": F.when(F.col("_in_text"), F.concat(F.when(F.col("_jo").isNotNull(), "조").when(F.col("_eok").isNotNull(), "억").otherwise(F.coalesce("_scale", F.lit(""))), F.lit("원"))).otherwise(F.col("_used")), "stated": F.when(F.col("_in_text"), F.col("_whole")).otherwise(F.col(amount))},
        {"factor": F.when(F.col("_in_text"), F.lit(1.0)).otherwise(won_factor(F.col("_used")))},
        {"won": F.col("stated") * F.col("factor"), "origin": F.when(F.col("_in_text"), "amount_text").when(F.col(amount).isNull(), "absent").when(F.col("_used").isNull(), "none").when(F.col("factor").isNull(), "other").when(F.col("_own").isNotNull(), "field").otherwise("text")},
    ]
    for columns in steps:
        df = df.withColumns(columns)
    return df.drop("_own", "_note", "_noted", "_read", "_jo", "_eok", "_rest", "_scale", "_in_text", "_used", "_whole")


@dataclass(frozen=True)
class UnitModel:
    """A fitted unit classifier and the calibration of its top probability."""

    pipeline: object
    calibration: object
    labels: list[str]


#: Bound of the labelled rows the classifier is fitted on; the rows are those of the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000


def bounded_sample(df: DataFrame, max_rows: int = MAX_TRAINING_ROWS, seed: int = 7) -> DataFrame:
    """About ``max_rows`` rows of ``df``, all where it has fewer, chosen by the hash of ``rec_key``."""
    keep = min(1.0, max_rows / max(df.count(), 1))
    return df.filter(F.pmod(F.xxhash64("rec_key", F.lit(seed)), F.lit(1_000_000)) < int(keep * 1_000_000))


def fit_unit_model(labelled: DataFrame, categories: list[str], numeric: list[str], trees: int = 12, depth: int = 7, seed: int = 7) -> UnitModel | None:
    """Random forest for the column ``label`` with isotonic calibration of the top probability on held-out rows.

    ``labelled`` is a bounded sample; the rows of every fifth document, by the hash of ``doc_id``, calibrate, so no record
    has a copy on both sides. Returns None where fewer than two labels occur.
    """
    sample = labelled.withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(5))).coalesce(4).cache()
    train, held = sample.filter("_fold > 0"), sample.filter("_fold = 0")
    if len(train.select("label").distinct().take(2)) < 2:
        sample.unpersist()
        return None
    # A forest needs a bin for each value of a category.
    values = train.agg(*[F.count_distinct(c).alias(c) for c in categories]).first()
    bins = max([64, *(n + 2 for n in values)])
    stages = [StringIndexer(inputCols=categories, outputCols=[f"_{c}_i" for c in categories], handleInvalid="keep"), StringIndexer(inputCol="label", outputCol="_y", handleInvalid="skip"), VectorAssembler(inputCols=[f"_{c}_i" for c in categories] + numeric, outputCol="_x", handleInvalid="keep"), RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, maxBins=bins, seed=seed)]
    pipeline = Pipeline(stages=stages).fit(train)
    top = F.array_max(vector_to_array("probability"))
    scored = pipeline.transform(held).select((F.col("prediction") == F.col("_y")).cast("double").alias("hit"), top.alias("top"))
    calibration = IsotonicRegression(labelCol="hit", featuresCol="top").fit(scored) if scored.take(1) else None
    sample.unpersist()
    return UnitModel(pipeline, calibration, list(pipeline.stages[1].labels))


def predict_units(model: UnitModel | None, df: DataFrame) -> DataFrame:
    """Add ``predicted`` and its calibrated ``confidence``; null and 0 without a model."""
    if model is None:
        return df.withColumns({"predicted": F.lit(None).cast("string"), "confidence": F.lit(0.0)})
    indexer, _, assembler, forest = model.pipeline.stages
    labels = F.array(*[F.lit(x) for x in model.labels])
    out = forest.transform(assembler.transform(indexer.transform(df)))
    out = out.withColumn("top", F.array_max(vector_to_array("probability")))
    if model.calibration is None:
        return out.withColumns({"predicted": F.get(labels, F.col("prediction").cast("int")), "confidence": F.col("top")})
    xs, ys = model.calibration.boundaries.toArray().tolist(), model.calibration.predictions.toArray().tolist()
    steps = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in zip(xs, ys)])
    below = F.filter(steps, lambda s: s["x"] <= F.col("top"))
    level = F.when(F.size(below) > 0, F.element_at(below, -1)["y"]).otherwise(F.lit(float(ys[0])))
    return out.withColumns({"predicted": F.get(labels, F.col("prediction").cast("int")), "confidence": level})
