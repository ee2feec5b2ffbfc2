"""Joins whose small side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed

# A per-key table of this many rows stays far below what an executor can hold.
BROADCAST_ROWS = 500_000


def sized(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A computed table, written once to shared storage and then measured.

    Up to ``max_rows`` rows it carries a broadcast hint and the other side does
    not move; beyond that the join shuffles and AQE splits hot keys.
    """
    small = checkpointed(small)
    return F.broadcast(small) if small.count() <= max_rows else small


def attach(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join row-level data with a per-key table computed from it."""
    return big.join(sized(small, max_rows), on, how)
