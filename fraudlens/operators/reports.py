"""Business reports (R1–R7) over the published marts.

Rates are always re-aggregated from counts (never averaged), because each
summary group splits fraud and non-fraud rows apart.  The only ordered
windows run over one row per calendar day or per category/hour — tables
bounded by the calendar and the code lists, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions import columns as C
from fraudlens.session import materialize

# --- fixed values (our choice; the reference gives no rule) -----------------
SPIKE_LOOKBACK_DAYS = 7
SPIKE_SIGMAS = 3.0
# ---------------------------------------------------------------------------


def date_spine(df: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    """R7: every calendar day between the first and last date (one row per day)."""
    return df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(date_col)
    )


def daily_totals(summary: DataFrame) -> DataFrame:
    """R7 applied: day spine ⟕ daily totals, empty days as zeros.  The totals, one row a day, are kept: the summary runs once."""
    daily = materialize(summary.groupBy("transaction_date").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("fraud_count").alias("fraud_count"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("fraud_volume").alias("fraud_volume"),
    ))
    zero = F.lit(0).cast("bigint")
    return date_spine(daily).join(daily, "transaction_date", "left").select(
        "transaction_date",
        F.coalesce("total_transactions", zero).alias("total_transactions"),
        F.coalesce("fraud_count", zero).alias("fraud_count"),
        F.coalesce("total_volume", F.lit(0).cast(C.SUM_TYPE)).alias("total_volume"),
        F.coalesce("fraud_volume", F.lit(0).cast(C.SUM_TYPE)).alias("fraud_volume"),
    )


def daily_fraud_trend(summary: DataFrame) -> DataFrame:
    """R1: daily fraud rate and a spike flag (rate above the mean + 3σ of the
    previous 7 days)."""
    d = daily_totals(summary).withColumn(
        "fraud_rate", C.safe_divide("fraud_count", "total_transactions"))
    prior = Window.orderBy("transaction_date").rowsBetween(-SPIKE_LOOKBACK_DAYS, -1)
    d = d.withColumn("prior_avg", F.avg("fraud_rate").over(prior)).withColumn(
        "prior_std", F.stddev_samp("fraud_rate").over(prior))
    return d.select(
        "transaction_date", "total_transactions", "fraud_count",
        C.round_rate("fraud_rate", 6).alias("fraud_rate"),
        C.round_rate("prior_avg", 6).alias("prior_7d_avg_rate"),
        C.round_rate("prior_std", 6).alias("prior_7d_std_rate"),
        F.coalesce(
            F.col("fraud_rate") > F.col("prior_avg") + F.lit(SPIKE_SIGMAS) * F.col("prior_std"), F.lit(False)
        ).alias("is_spike"),
    )


def category_fraud_volume(summary: DataFrame) -> DataFrame:
    """R2: merchant categories ranked by fraud volume."""
    g = summary.groupBy("merchant_category").agg(
        F.sum("fraud_volume").alias("fraud_volume"),
        F.sum("fraud_count").alias("fraud_count"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("total_transactions").alias("total_transactions"),
    )
    return g.select(
        "merchant_category", "fraud_volume", "fraud_count", "total_volume", "total_transactions",
        C.safe_divide("fraud_count", "total_transactions").alias("fraud_rate"),
        F.rank().over(Window.orderBy(F.desc("fraud_volume"))).cast("bigint").alias("volume_rank"),
    )


def elevated_fraud_by_band_country(dim_customers: DataFrame) -> DataFrame:
    """R3: customers in an elevated/high fraud segment by age band × country."""
    return (
        dim_customers.where(F.col("fraud_segment") != "NORMAL")
        .groupBy("age_band", "country")
        .agg(
            F.count(F.lit(1)).alias("flagged_customers"),
            C.count_if(F.col("fraud_segment") == "HIGH_FRAUD").alias("high_fraud_customers"),
            C.count_if(F.col("fraud_segment") == "ELEVATED_FRAUD").alias("elevated_fraud_customers"),
            F.sum("fraud_txn_count").alias("fraud_txn_count"),
            F.sum("lifetime_txn_count").alias("lifetime_txn_count"),
        )
        .withColumn("fraud_rate", C.safe_divide("fraud_txn_count", "lifetime_txn_count"))
    )


def cross_border_fraud_share(summary: DataFrame) -> DataFrame:
    """R4: share of fraud (count and volume) that is cross-border."""
    xb = F.col("is_cross_border") == F.lit(True)
    zero = F.lit(0).cast(C.SUM_TYPE)
    g = summary.agg(
        F.sum("fraud_count").alias("fraud_count"),
        F.sum(F.when(xb, F.col("fraud_count")).otherwise(F.lit(0))).alias("cross_border_fraud_count"),
        F.sum("fraud_volume").alias("fraud_volume"),
        F.sum(F.when(xb, F.col("fraud_volume")).otherwise(zero)).alias("cross_border_fraud_volume"),
    )
    return g.select(
        "fraud_count", "cross_border_fraud_count",
        C.safe_divide("cross_border_fraud_count", "fraud_count").alias("cross_border_share"),
        "fraud_volume", "cross_border_fraud_volume",
        C.safe_divide("cross_border_fraud_volume", "fraud_volume").alias("cross_border_volume_share"),
    )


def high_risk_merchants(dim_merchants: DataFrame) -> DataFrame:
    """R5: merchants whose fraud rate is above the 95th percentile."""
    return dim_merchants.where(F.col("high_fraud_rate_flag") == F.lit(True)).select(
        "merchant_id", "merchant_name", "category_code", "country", "total_txn_count",
        "fraud_txn_count", "fraud_rate", "merchant_risk_tier",
    )


def fraud_by_hour(fct: DataFrame) -> DataFrame:
    """R6: fraud by hour of day from the fact (hour is not a summary key)."""
    is_fraud = F.col("is_fraudulent") == F.lit(True)
    g = (
        fct.where(F.col("status") == "COMPLETED")
        .groupBy("hour_of_day")
        .agg(C.count_if(is_fraud).alias("fraud_count"), F.count(F.lit(1)).alias("total_transactions"))
    )
    return g.select(
        "hour_of_day", "fraud_count", "total_transactions",
        C.safe_divide("fraud_count", "total_transactions").alias("fraud_rate"),
        F.rank().over(Window.orderBy(F.desc("fraud_count"))).cast("bigint").alias("fraud_rank"),
    )
