"""Fact → dimension lookup joins with a proven broadcast bound.

A dimension side is broadcast only after a count proves it has at most
``max_rows`` rows.  The count is a plain distributed ``count()`` (column
pruned, partial aggregation); ``limit(n).count()`` is avoided on purpose, as
its global limit funnels up to partitions × n rows through one task.
Larger dimensions fall back to a shuffle (sort-merge)
join; AQE then splits skewed fact partitions (for example one customer id, or
NULL keys, holding a third of the rows) and may still switch to a broadcast
join when the measured shuffle output turns out to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ~60 bytes per narrow dimension row -> at most ~60 MB per broadcast.
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                      decisions: list | None = None) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` provably has ≤ ``max_rows`` rows, else ``df``.

    ``max_rows=None`` skips the check and leaves the choice to the planner
    (``autoBroadcastJoinThreshold`` on estimated size, then AQE at runtime).
    """
    small = max_rows is not None and has_at_most(df, max_rows)
    if decisions is not None:
        decisions.append(small)
    return F.broadcast(df) if small else df


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
    decisions: list | None = None,
) -> DataFrame:
    """Left outer equi-join of a fact to a dimension keyed on ``key``.

    ``decisions`` (optional) collects whether the dimension was broadcast.
    """
    return fact.join(bounded_broadcast(dim, max_broadcast_rows, decisions), on=key, how="left")
