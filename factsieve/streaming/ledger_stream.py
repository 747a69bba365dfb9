"""Streaming twins: ledger state per batch, and windows over event time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from factsieve.operators.ledger import fold


def coalesce_stream(ledger: DataFrame, key: str = "batch_id", order: str = "line_no") -> DataFrame:
    """Update stream of each batch's state; with all records delivered its last rows equal the batch operator's.

    State is one row a batch. Records of one micro-batch are folded in their order.
    """

    def step(keys: tuple[Any, ...], pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        current = None
        if state.exists:
            status, payload, recovered = state.get
            current = {"status": status, "payload": list(payload), "recovered": recovered}
        rows = pd.concat(list(pieces)).sort_values(order).to_dict("records")
        current = fold(rows, current)
        state.update((current["status"], current["payload"], current["recovered"]))
        yield pd.DataFrame([{key: keys[0], **current}])

    kind = ledger.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, status string, payload array<string>, recovered boolean"
    return ledger.groupBy(key).applyInPandasWithState(step, out, "status string, payload array<string>, recovered boolean", "update", GroupStateTimeout.NoTimeout)


def windowed_counts(events: DataFrame, time: str, by: str, late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Events a window and type, late ones up to the watermark included."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key: events no more than ``gap`` apart."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), by, "n")


def first_occurrences(events: DataFrame, time: str, key: list[str], late: str = "1 day") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
