"""Canonical forms: payload JSON, hashes and record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Provenance fields, which are no part of a record's content.
PROVENANCE = ["출처페이지", "출처페이지추정", "source_object_ids", "object_id", "evidence_id", "evidence_ids", "근거ID", "근거ID목록", "객체ID", "근거객체ID", "물리객체ID", "추출원천", "추출엔진", "OCR보완여부", "출처계보", "원본근거ID", "원본객체ID", "source_evidence_ids", "source_evidence_id", "source_engines", "ocr_source_file", "ocr_source_line"]


def payload_fields(df: DataFrame, leave_out: tuple[str, ...] = ()) -> list[str]:
    """Content columns: neither provenance nor annotations nor ``leave_out``, in the order of their names."""
    return sorted(c for c in df.columns if c not in PROVENANCE and not c.startswith("_") and c not in leave_out)


def payload_json(df: DataFrame, fields: list[str]) -> Column:
    """Canonical JSON text of the filled fields; numbers of one value have one text whatever their type."""

    def text(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        value = F.col(name).cast("double").cast("string") if kind in ("integer", "long", "double", "float", "short") else F.col(name).cast("string")
        return F.when(value.isNotNull() & (value != ""), F.concat(F.to_json(F.struct(F.lit(name).alias("k"), value.alias("v")))))

    return F.concat(F.lit("["), F.concat_ws(",", *[text(f) for f in fields]), F.lit("]"))


def payload_hash(df: DataFrame, fields: list[str]) -> Column:
    return F.sha2(payload_json(df, fields), 256)


def record_key(*cols: Column) -> Column:
    """Fields joined by a bar, folded; null where any field is blank."""
    folded = [F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), r"\s+", "") for c in cols]
    blank = folded[0] == ""
    for c in folded[1:]:
        blank = blank | (c == "")
    return F.when(~blank, F.concat_ws("|", *folded))
