"""Append-only batch ledgers: ids, coalescing, resume decisions and completion."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAILED = ["partial", "parse_fail", "call_fail", "unresolved"]


def batch_id(*cols: Column) -> Column:
    """Content-addressed id of a batch."""
    return F.substring(F.sha2(F.to_json(F.struct(*cols)), 256), 1, 24)


def fold(records: list[dict], state: dict | None = None) -> dict:
    """State of a batch after its records in order: ok replaces anything; a failure after a failure that has payload
    adds its payload and is partial and recovered; any other failure replaces what was. ``state`` is what went before."""
    state = dict(state or {})
    for r in records:
        payload = list(r["payload"]) if r["payload"] is not None else []
        if r["status"] == "ok" or not state or state["status"] not in FAILED or not state["payload"]:
            state = {"status": r["status"], "payload": payload, "recovered": False}
        else:
            merged = state["payload"] + [p for p in payload if p not in state["payload"]]
            state = {"status": "partial", "payload": merged, "recovered": True}
    return state


def coalesce_ledger(ledger: DataFrame, key: str = "batch_id", order: str = "line_no") -> DataFrame:
    """(key, status, payload, recovered) of each batch: the batch twin of the streaming operator.

    ``ledger`` has the key, order, status and payload ARRAY<STRING>. A fold in order, hence a kernel per batch id; a
    batch has as many records as it had attempts.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        state = fold(rows.sort_values(order).to_dict("records"))
        return pd.DataFrame([{key: rows[key].iloc[0], **state}])

    kind = ledger.schema[key].dataType.simpleString()
    return ledger.groupBy(key).applyInPandas(run, f"`{key}` {kind}, status string, payload array<string>, recovered boolean")


def last_status(ledger: DataFrame, key: str, order: str, status: str) -> DataFrame:
    """Last status of each batch and whether it was ever ok: an aggregation."""
    return ledger.groupBy(key).agg(F.max_by(status, order).alias("last_status"), F.bool_or(F.col(status) == "ok").alias("ever_ok"), F.count("*").alias("attempts"))


def resume(plan: DataFrame, ledger: DataFrame, key: str, retry_failed_only: bool = False) -> DataFrame:
    """``plan`` with decision: restore what is ok, execute what is new, retry what failed (skip the new where only failures are retried)."""
    out = plan.join(ledger.select(key, F.col("status").alias("_s")), key, "left")
    new = F.lit("skip" if retry_failed_only else "execute")
    return out.withColumn("decision", F.when(F.col("_s") == "ok", "restore").when(F.col("_s").isNull(), new).otherwise("retry")).drop("_s")


def completion(ledger: DataFrame) -> DataFrame:
    """Number of batches by status with the run's status: complete if all are ok."""
    by = ledger.groupBy("status").agg(F.count("*").alias("n"))
    total = ledger.agg(F.count("*").alias("_t"), F.count_if(F.col("status") == "ok").alias("_ok"))
    return by.join(F.broadcast(total)).select("status", "n", F.when(F.col("_t") == F.col("_ok"), "complete").otherwise("incomplete").alias("run_status"))


def within_budget(plan: DataFrame, group: str, order: str, cost: str, cap: float) -> DataFrame:
    """Calls of each run in order until their running cost exceeds the cap."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return plan.withColumn("running_cost", F.sum(cost).over(w)).filter(F.col("running_cost") <= cap)


def changed_objects(now: DataFrame, before: DataFrame, key: str, payload: str, seen: DataFrame) -> DataFrame:
    """Objects whose payload differs from the former one or is new, and whose fingerprint wasn't tried before."""
    b = before.select(key, F.col(payload).alias("_b"))
    out = now.join(b, key, "left").filter(~F.col(payload).eqNullSafe(F.col("_b"))).drop("_b")
    out = out.withColumn("fingerprint", F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col(payload).cast("string")), 256))
    return out.join(seen.select("fingerprint"), "fingerprint", "left_anti")
