"""Joins of a big row table with a small fitted table (bounds, statistics, codes).

A side is broadcast only when its row count is known to be under a limit;
beyond it the join is left to Catalyst (sort-merge with AQE skew splitting).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row limit for an explicit broadcast of a fitted table. Fitted tables have one
# row per (group, column); 2M narrow rows stay well under the broadcast size cap.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_count(df: DataFrame, limit: int) -> int:
    """Rows of ``df`` counted up to ``limit + 1`` (a ``limit`` job, not a full count)."""
    return df.limit(limit + 1).count()


def attach(big: DataFrame, small: DataFrame, on: Sequence[str] | None, how: str = "inner",
           max_rows: int = MAX_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Join ``small`` onto ``big`` on ``on`` (empty/None → one-row cross attach).

    ``small`` is broadcast if its size is proven ≤ ``max_rows`` (``known_rows`` when the
    caller knows it, e.g. one row per column; otherwise a bounded count). A keyless attach
    requires a one-row side.
    """
    on = list(on or [])
    if not on:
        n = known_rows if known_rows is not None else bounded_count(small, 1)
        if n > 1:
            raise ValueError("keyless attach needs a single-row table")
        return big.crossJoin(F.broadcast(small))
    n = known_rows if known_rows is not None else bounded_count(small, max_rows)
    if n <= max_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)
