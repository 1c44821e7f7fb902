"""Rows dealt to tasks by a column of few values, such as the day, so that later groups and writes need no shuffle of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = "__slot"
LEAST_ROWS = 1_000_000         # a value of fewer rows is never split


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def rows_by(df: DataFrame, by: str) -> dict:
    """Rows of each value of ``by``: bounded by the calendar where it is a day.  A partition column is counted without reading data."""
    return {r[0]: r["n"] for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}


def slot_of(by: str, spread: list[str], counts: dict, tasks: int, least_rows: int | None = None) -> Column:
    """0, or for a value of ``by`` with more than twice a task's share of the rows a hash of ``spread`` below as many slots as it fills shares."""
    share = max(2 * sum(counts.values()) // tasks, least_rows or LEAST_ROWS)
    hot = {v: -(-n // share) for v, n in counts.items() if n > share}        # fewer than half as many as tasks
    slots = F.lit(hot.pop(None)) if None in hot else F.lit(1)
    if hot:
        of = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        slots = F.when(F.col(by).isNull(), slots).otherwise(F.coalesce(F.try_element_at(of, F.col(by)), F.lit(1)))
    else:
        slots = F.when(F.col(by).isNull(), slots).otherwise(F.lit(1))
    return F.pmod(F.xxhash64(*spread), slots.cast("bigint")).cast("int")


def dealt_by(df: DataFrame, by: str, spread: list[str], counts: dict, coalesced: bool = True, least_rows: int | None = None) -> DataFrame:
    """``df`` with SLOT, rows of one value and slot in one task; groups and windows over ``by``, SLOT and more are not shuffled again.

    ``spread`` must be a function of their keys.  ``coalesced``: adaptive execution may merge small partitions.
    """
    tasks = shuffle_partitions(df)
    df = df.withColumn(SLOT, slot_of(by, spread, counts, tasks, least_rows))
    return df.repartition(by, SLOT) if coalesced else df.repartition(tasks, by, SLOT)
