"""Joining a large side to a lookup table without trusting its size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def distinct_keys(lookup: DataFrame, column: str, role: str) -> DataFrame:
    """Key column of a lookup under another name.

    A small one is made distinct and broadcast. A larger one is taken as it is stored, where each key was checked to
    occur once: an aggregate between shuffle and join would keep AQE from splitting a hot key of the large side.
    """
    small = broadcast_if_small(lookup)
    keys = small.select(F.col(column).alias(role))
    return keys if small is lookup else keys.distinct()


def broadcast_if_small(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``lookup`` for broadcast if it has at most ``max_rows`` rows.

    The check reads at most one row beyond the bound. A larger table is returned without the mark: Spark then
    shuffles both sides, and AQE splits the hot keys of the large side.
    """
    if lookup.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(lookup)
    return lookup
