"""Evidence, object and project ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(col: Column) -> Column:
    text = F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), r"[\[\]\"']", "")
    return F.filter(F.transform(F.split(text, r"[|,;]"), lambda x: F.trim(x)), lambda x: x != "")


def ids_in_order(col: Column) -> Column:
    """Distinct ids of a list in text, in the order they first stand in."""
    return F.array_distinct(_parts(col))


def ids_sorted(col: Column) -> Column:
    """Distinct ids of a list in text, sorted."""
    return F.array_sort(F.array_distinct(_parts(col)))


def evidence_ids(col: Column) -> Column:
    """Distinct ids in order; those that begin with ev- in any case are put in lower case."""
    return F.array_distinct(F.transform(_parts(col), lambda x: F.when(F.lower(x).startswith("ev-"), F.lower(x)).otherwise(x)))


def union_ids(*cols: Column) -> Column:
    """Distinct ids of several id arrays, sorted; null arrays count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(*[F.coalesce(c, empty) for c in cols])))


def project_id(col: Column) -> Column:
    """Upper case, underscores as hyphens, no leading zeros in any number."""
    return F.regexp_replace(F.translate(F.upper(F.trim(col)), "_", "-"), r"(?<![0-9])0+([0-9]+)", "$1")


def object_number(col: Column) -> Column:
    """The number of a table or figure caption, such as 3-2."""
    return F.nullif(F.regexp_extract(col, r"(?i)(?:표|그림|table|figure)\s*[<\[]?\s*([0-9]+(?:[-.][0-9]+)*)", 1), F.lit(""))


def evidence_id(page: Column, family: Column, anchor: Column) -> Column:
    """Stable evidence id of an object: its page, family and anchor text."""
    return F.concat(F.lit("ev-"), F.substring(F.sha1(F.concat_ws("|", page.cast("string"), family, F.regexp_replace(F.lower(anchor), r"\s+", ""))), 1, 16))
