"""Broadcast only what has a proven size bound.

``bounded_broadcast(df, max_rows)`` adds a broadcast hint only when the
caller can prove ``df`` has at most ``max_rows`` rows (a sampler cap, a
``limit``, a fixed number of draws) and that bound times a conservative
row width stays under the broadcast budget. Otherwise the frame is left
to the planner (shuffle join, or AQE converting it at run time from real
statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_BYTES = 64                      # conservative width of a narrow id row
BROADCAST_BUDGET = 256 * 1024 * 1024


def bounded_broadcast(df: DataFrame, max_rows: int | None, row_bytes: int = ROW_BYTES,
                      budget: int = BROADCAST_BUDGET) -> DataFrame:
    if max_rows is not None and max_rows * row_bytes <= budget:
        return F.broadcast(df)
    return df
