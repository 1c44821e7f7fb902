"""Exact ``percentile_cont`` without funnelling every value through one task.

Spark's built-in ``percentile`` is exact but merges a map of every distinct
value in a single final task.  Here the exact answer for one or several
columns is found in three distributed passes plus one small sort, over a
long (column, value) form so every column is handled by the same jobs:

1. per column: ``count``, ``min``, ``max`` and two approximate quantiles that
   bracket the target rank (Greenwald–Khanna sketch, rank error ≤ n/accuracy,
   merged from per-partition sketches);
2. per column: two counts that verify the bracket really contains the target
   ranks; where it does not, the bracket widens to [min, max] — still exact,
   only slower;
3. the values inside the bracket are grouped by value (ties collapse, so a
   value held by a third of the rows is one row) and ranked with a running
   sum of counts, one window partition per column.  Only the bracket — about
   ``6/accuracy`` of the distinct values — is ordered in a single task.

The per-column statistics tables have one row per requested column (a
structural bound), so joining them back is a broadcast of a handful of rows.

Result: linear interpolation between the values at ranks ``floor(k)`` and
``ceil(k)`` with ``k = (n - 1) * p`` over non-NULL values, the definition of
``percentile_cont``; NULL when a column has no values.  Everything is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 10_000


def percentile_cont_frame(
    df: DataFrame, columns: str | list[str], p: float, accuracy: int = DEFAULT_ACCURACY,
    alias: str | list[str] | None = None,
) -> DataFrame:
    """One-row DataFrame with the exact ``percentile_cont(column, p)`` of each column."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    cols = [columns] if isinstance(columns, str) else list(columns)
    names = [alias] if isinstance(alias, str) else list(alias or [f"p{int(round(p * 100))}_{c}" for c in cols])

    vals = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)
    ])).alias("x")).select("x.c", "x.v").where(F.col("v").isNotNull())

    delta = 3.0 / accuracy
    q_lo, q_hi = max(0.0, p - delta), min(1.0, p + delta)
    lo_approx = F.min("v") if q_lo == 0.0 else F.percentile_approx("v", q_lo, accuracy)
    hi_approx = F.max("v") if q_hi == 1.0 else F.percentile_approx("v", q_hi, accuracy)
    k = (F.col("n") - F.lit(1)).cast("double") * F.lit(p)
    stats = vals.groupBy("c").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"),
        lo_approx.alias("lo"), hi_approx.alias("hi"),
    ).select("*", k.alias("k"), F.floor(k).alias("r0"), F.ceil(k).alias("r1"))

    check = (
        vals.join(F.broadcast(stats.select("c", "lo", "hi")), "c")
        .groupBy("c").agg(
            F.count_if(F.col("v") < F.col("lo")).alias("below"),
            F.count_if(F.col("v") <= F.col("hi")).alias("upto"),
        )
    )
    ok = (F.col("below") <= F.col("r0")) & (F.col("upto") > F.col("r1"))
    bounds = stats.join(check, "c").select(
        "c", "k", "r0", "r1",
        F.when(ok, F.col("lo")).otherwise(F.col("mn")).alias("b_lo"),
        F.when(ok, F.col("hi")).otherwise(F.col("mx")).alias("b_hi"),
        F.when(ok, F.col("below")).otherwise(F.lit(0)).alias("b_below"),
    )

    ordered = Window.partitionBy("c").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        vals.join(F.broadcast(bounds.select("c", "b_lo", "b_hi")), "c")
        .where(F.col("v").between(F.col("b_lo"), F.col("b_hi")))
        .groupBy("c", "v").agg(F.count(F.lit(1)).alias("cnt"))
        .join(F.broadcast(bounds.select("c", "b_below", "r0", "r1")), "c")
        .withColumn("start", F.col("b_below") + F.sum("cnt").over(ordered) - F.col("cnt"))
    )

    def covers(r: Column) -> Column:
        return (F.col("start") <= r) & (r < F.col("start") + F.col("cnt"))

    picked = ranked.groupBy("c").agg(
        F.max(F.when(covers(F.col("r0")), F.col("v"))).alias("v0"),
        F.max(F.when(covers(F.col("r1")), F.col("v"))).alias("v1"),
    ).join(bounds.select("c", "k", "r0"), "c").select(
        "c", (F.col("v0") + (F.col("k") - F.col("r0")) * (F.col("v1") - F.col("v0"))).alias("value"))

    # one row, one column per input column (absent column → NULL)
    return picked.agg(*[F.max(F.when(F.col("c") == i, F.col("value"))).alias(nm) for i, nm in enumerate(names)])


def percentile_cont(df: DataFrame, column: str, p: float, accuracy: int = DEFAULT_ACCURACY) -> Column:
    """Scalar-subquery Column with the exact ``percentile_cont(column, p)``."""
    return percentile_cont_frame(df, column, p, accuracy, alias="p").scalar()
