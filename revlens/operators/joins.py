"""Broadcast hints behind a size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast by hint only when its known number of rows fits in this many bytes.
BROADCAST_BYTES = 48 << 20


def small_side(df: DataFrame, rows: int | None, row_bytes: int = 64) -> DataFrame:
    """``df`` with a broadcast hint if ``rows`` of it, counted or bounded by
    how it was made, are small; else as it is, for Spark to judge by its own
    measured sizes."""
    return F.broadcast(df) if rows is not None and rows * row_bytes <= BROADCAST_BYTES else df
