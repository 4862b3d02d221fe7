"""Use per minute, and runs of equal outcomes, of an event stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def quota_windows(events: DataFrame, time: str, scope: str, amount: str, width: str = "1 minute") -> DataFrame:
    """``(scope, window_start, requests, amount)`` of each window of each scope, batch or stream."""
    windows = events.groupBy(F.window(time, width).alias("w"), F.col(scope).alias("scope")).agg(F.count("*").alias("requests"), F.round(F.sum(amount), 4).alias("amount"))
    return windows.select("scope", F.col("w.start").alias("window_start"), "requests", "amount")


def quota_windows_stream(events: DataFrame, time: str, scope: str, amount: str, late: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """The same over a stream: a window comes out once the watermark has passed it."""
    return quota_windows(events.withWatermark(time, late), time, scope, amount, width)


def _streak(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    outcome, length = state.get if state.exists else ("", 0)
    rows = pd.concat(list(batches)).sort_values(["at", "event"])
    for value in rows["outcome"]:
        length = length + 1 if value == outcome else 1
        outcome = value
    state.update((outcome, int(length)))
    yield pd.DataFrame({"scope": [key[0]], "outcome": [outcome], "streak": [int(length)]})


def streaks_stream(events: DataFrame) -> DataFrame:
    """``(scope, outcome, streak)`` after each batch of events ``(scope, at, event, outcome)``: how often the last outcome came in a row."""
    return events.groupBy("scope").applyInPandasWithState(_streak, "scope string, outcome string, streak long", "outcome string, length long", "update", GroupStateTimeout.NoTimeout)
