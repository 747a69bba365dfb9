"""Tolerant JSON and strict ledgers."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def _extract(text: str | None) -> str | None:
    if not text:
        return None
    fenced = re.search(r"```(?:json)?\s*(.*?)```", text, re.S)
    body = fenced.group(1) if fenced else text
    for start in (m.start() for m in re.finditer(r"[\[{]", body)):
        try:
            value, _ = json.JSONDecoder().raw_decode(body[start:])
        except ValueError:
            continue
        return json.dumps(value, ensure_ascii=False)
    return None


@pandas_udf(StringType())
def _loose(texts: pd.Series) -> pd.Series:
    return texts.map(_extract)


def tolerant_json(col: Column) -> Column:
    """The first JSON object or array in a text, out of a code fence or between other words; null where there is none."""
    return _loose(col)


def strict_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with their file, line_no from 1 and, for a damaged line, its text in _damaged.

    A ledger file is read whole, as only its beginning tells the numbers of its lines; blank lines count but give no row.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("_i", "_line"))
    read = lines.filter(F.trim("_line") != "").withColumn("r", F.from_json("_line", f"{schema}, _damaged STRING", {"columnNameOfCorruptRecord": "_damaged", "mode": "PERMISSIVE"}))
    return read.select("r.*", "file", (F.col("_i") + 1).alias("line_no"))


def last_record(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last record of each key, taken verbatim."""
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("r")).select(key, "r.*")
