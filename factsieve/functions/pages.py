"""Page sets out of lists, ranges and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_RANGE = 5000


def _tidy(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x > 0))))


def _spans(text: Column) -> Column:
    parts = F.filter(F.split(F.regexp_replace(text, r"[\[\]\"'\s]", ""), "[,;/]"), lambda p: p != "")

    def span(p: Column) -> Column:
        lo, hi = F.get(F.split(p, "[-~–]"), 0).try_cast("int"), F.get(F.split(p, "[-~–]"), 1).try_cast("int")
        ok = lo.isNotNull() & hi.isNotNull() & (hi >= lo) & (hi - lo < MAX_RANGE)
        return F.when(ok, F.sequence(F.when(ok, lo).otherwise(0), F.when(ok, hi).otherwise(0))).otherwise(F.array(p.try_cast("int")))

    return F.flatten(F.transform(parts, span))


def page_set(col: Column) -> Column:
    """Sorted distinct pages of "3,5-7", a list in text or a single number; ranges of MAX_RANGE and more are left out."""
    return _tidy(_spans(col.cast("string")))


def page_set_strict(col: Column) -> Column:
    """Struct (pages, error): an error is any part that is neither a page nor a rising range."""
    text = F.regexp_replace(col.cast("string"), r"[\[\]\s]", "")
    bad = ~text.rlike(r"^[0-9]+([-~–][0-9]+)?([,;/][0-9]+([-~–][0-9]+)?)*$")
    return F.struct(F.when(~bad, page_set(col)).alias("pages"), (bad & (text != "")).alias("error"))


def page_digits(col: Column) -> Column:
    """Every run of digits as a page; no ranges."""
    return _tidy(F.transform(F.regexp_extract_all(col.cast("string"), F.lit("([0-9]{1,9})"), 1), lambda x: x.try_cast("int")))


def page_set_within(col: Column, page_count: Column) -> Column:
    """Pages of the set that exist in a document of ``page_count`` pages."""
    return F.filter(page_set(col), lambda p: p <= page_count)


def adjacent(a: Column, b: Column, distance: int = 0) -> Column:
    """Whether two page sets have pages at most ``distance`` apart."""
    return F.exists(a, lambda x: F.exists(b, lambda y: F.abs(x - y) <= distance))
