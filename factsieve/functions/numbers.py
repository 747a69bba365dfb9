"""Number readers. Each accepts what its users accept; they are named apart and never unified."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def measure(col: Column) -> Column:
    """Measure as DOUBLE: thousands separators and a leading "약 " are dropped; other text gives null."""
    return F.regexp_replace(F.regexp_replace(F.trim(col.cast("string")), "^약 *", ""), ",", "").try_cast("double")


def measure_map(values: Column) -> Column:
    """Sum of the numeric members of a map; a sum of zero counts as absent."""
    total = F.aggregate(F.map_values(values), F.lit(0.0), lambda a, v: a + F.coalesce(measure(v), F.lit(0.0)))
    return F.nullif(total, F.lit(0.0))


def strict_decimal(col: Column) -> Column:
    """Plain decimal text as DECIMAL(20,6); a minus sign may be U+2212; anything else gives null."""
    text = F.translate(F.regexp_replace(F.trim(col.cast("string")), ",", ""), "−", "-")
    return F.when(text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"), text.try_cast("decimal(20,6)"))


def finite(col: Column) -> Column:
    """Finite DOUBLE; NaN and the infinities give null."""
    x = F.regexp_replace(F.trim(col.cast("string")), ",", "").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def percent(col: Column) -> Column:
    """Number that may end in a percent sign."""
    return finite(F.regexp_replace(col.cast("string"), "%", ""))


def whole(col: Column) -> Column:
    """Whole number as INT; fractions and other text give null."""
    x = F.regexp_replace(F.trim(col.cast("string")), ",", "").try_cast("double")
    return F.when((x == F.floor(x)) & (F.abs(x) < 2147483647), x.cast("int"))


def year(col: Column) -> Column:
    """First four-digit year from 1800 to 2200 in a text."""
    y = F.nullif(F.regexp_extract(col.cast("string"), r"(?<![0-9])((?:18|19|20|21)[0-9]{2}|2200)(?![0-9])", 1), F.lit(""))
    return y.try_cast("int")


def same_number(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Equal within a relative tolerance, by default half a percent."""
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1.0)) <= tolerance


def relative_error(truth: Column, value: Column) -> Column:
    """Distance relative to the truth; zero against zero is no error, anything else against zero is a whole one."""
    return F.when(truth == 0, F.when(value == 0, 0.0).otherwise(1.0)).otherwise(F.abs(truth - value) / F.abs(truth))


def same_but_scale(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Different numbers that agree after a factor of a thousand or a million either way."""
    agree = [relative_error(a, b * f) <= tolerance for f in (1e3, 1e6, 1e-3, 1e-6)]
    out = agree[0]
    for x in agree[1:]:
        out = out | x
    return out & ~(relative_error(a, b) <= tolerance)


def text_variants(col: Column) -> Column:
    """The ways a number may be printed: plain, with separators, and in thousands."""
    plain = F.regexp_replace(col.cast("decimal(24,4)").cast("string"), r"\.?0+$", "")
    return F.array_distinct(F.array(plain, F.format_number(col, 0), F.format_number(col / 1000, 0)))
