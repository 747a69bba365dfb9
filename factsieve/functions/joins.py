"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A table is broadcast only if it has at most so many rows when counted.
BROADCAST_ROWS = 200_000
#: A key is hot when it holds more than this share of the rows; hence at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 1 / 500


def skew_safe_join(rows: DataFrame, per_key: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``per_key`` (one row a key, with its number of rows in ``weight``) on ``key``.

    Keys whose weight exceeds HOT_SHARE of the total are at most 1 / HOT_SHARE in number whatever the data, so
    that part alone is broadcast; all others go through an ordinary shuffle join. A row that met a hot key takes
    part in the shuffle under the hash of all its columns, so no task receives a hot group; ``rows`` should carry a row id,
    as rows alike in every column stay together. Null keys match nothing.
    """
    total = per_key.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("_total"))
    limit = F.greatest(F.col("_total") * F.lit(HOT_SHARE), F.lit(1000))
    flagged = per_key.join(F.broadcast(total)).withColumn("_hot", F.col(weight) > limit).drop("_total")
    value_cols = [c for c in per_key.columns if c != key]
    pack = F.struct(*[F.col(c) for c in value_cols])
    hot = flagged.filter("_hot").select(F.col(key).alias("_hk"), pack.alias("_hv"))
    cold = flagged.filter(~F.col("_hot")).select(F.col(key).alias("_ck"), F.lit(False).alias("_chot"), pack.alias("_cv"))
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left")
    is_hot: Column = F.col("_hk").isNotNull()
    spread = F.when(is_hot, F.xxhash64(*[F.col(c) for c in rows.columns if not _is_complex(rows, c)]))
    left = left.withColumn("_jh", F.coalesce(spread, F.xxhash64(key))).withColumn("_jhot", is_hot)
    cold = cold.withColumn("_ch", F.xxhash64("_ck"))
    on = (F.col("_jh") == F.col("_ch")) & (F.col("_jhot") == F.col("_chot")) & (F.col(key) == F.col("_ck"))
    out = left.join(cold, on, "left").withColumn("_v", F.coalesce("_hv", "_cv"))
    if how == "inner":
        out = out.filter(F.col("_v").isNotNull())
    return out.select(*[F.col(c) for c in rows.columns], *[F.col(f"_v.{c}").alias(c) for c in value_cols])


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint where a count finds at most ``rows`` rows, else as it is, for a shuffle join.

    The count stops at the bound; ``df`` should be a stored table or cheap to compute.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _is_complex(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("map", "variant")
