"""Marts (M8–M11): customer/merchant dimensions, fact, daily fraud summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import columns as C
from fraudlens.operators.dealing import SLOT, dealt_by, rows_by, shuffle_partitions

AUDIT_UPDATED = "_updated_at"  # audit column of every mart (run timestamp)

FACT_COLUMNS = [
    "transaction_id", "card_id", "customer_id", "merchant_id",
    "transaction_ts", "transaction_date", "hour_of_day", "day_of_week",
    "amount", "currency", "status", "amount_bucket",
    "is_fraudulent", "fraud_type",
    "card_type", "card_is_expired", "card_is_blocked",
    "customer_country", "customer_age_band", "customer_risk_tier",
    "merchant_category", "merchant_country", "merchant_is_high_risk",
    "is_cross_border", "card_anomaly_flag", "high_risk_merchant_flag",
    "high_risk_customer_flag", "is_unusual_hour", "composite_risk_score",
]

SUMMARY_KEYS = [
    "transaction_date", "merchant_category", "customer_country", "merchant_country", "fraud_type",
    "is_cross_border", "customer_age_band", "customer_risk_tier", "card_type", "is_unusual_hour",
]


def _audit(updated_at, audit: bool) -> list:
    return [C.as_timestamp(updated_at).alias(AUDIT_UPDATED)] if audit else []


def dim_customers(profile: DataFrame, updated_at=None, audit: bool = True) -> DataFrame:
    """Type-1 customer dimension; thresholds compare the unrounded rate."""
    rate = F.col("fraud_rate")
    segment = (
        F.when(rate > C.HIGH_FRAUD_RATE, "HIGH_FRAUD")
        .when(rate > C.ELEVATED_FRAUD_RATE, "ELEVATED_FRAUD")
        .otherwise("NORMAL")
    )
    return profile.select(
        "customer_id", "country", "age_band", "risk_tier", "signup_date",
        "lifetime_txn_count", "lifetime_spend", "avg_txn_amount",
        "first_txn_date", "last_txn_date", "days_since_last_txn",
        "distinct_merchant_count", "distinct_card_count",
        "txn_count_30d", "spend_30d", "txn_count_7d",
        "fraud_txn_count", "fraud_amount",
        C.round_rate(F.coalesce(rate, F.lit(0.0))).alias("fraud_rate"),
        "cross_border_txn_count", "unusual_hour_txn_count", "max_single_txn_amount",
        segment.alias("fraud_segment"),
        *_audit(updated_at, audit),
    )


def dim_merchants(risk: DataFrame, updated_at=None, audit: bool = True) -> DataFrame:
    """Merchant dimension.  'MEDIUM' is kept although it cannot occur: a TRUE
    high-fraud flag always makes the computed flag TRUE first."""
    computed = F.col("computed_high_risk_flag") == F.lit(True)
    tier = (
        F.when(computed & (F.col("high_velocity_flag") == F.lit(True)), "CRITICAL")
        .when(computed, "HIGH")
        .when(F.col("high_fraud_rate_flag") == F.lit(True), "MEDIUM")
        .otherwise("LOW")
    )
    return risk.select(
        "merchant_id", "merchant_name", "category_code", "country", "monthly_txn_limit",
        "total_txn_count", "fraud_txn_count", "fraud_rate", "total_volume",
        "avg_txn_amount", "max_txn_amount", "cross_border_count", "avg_daily_txn_velocity",
        "inherent_high_risk", "high_fraud_rate_flag", "high_velocity_flag", "computed_high_risk_flag",
        tier.alias("merchant_risk_tier"),
        *_audit(updated_at, audit),
    )


def fct_transactions(enriched: DataFrame, updated_at=None, audit: bool = True) -> DataFrame:
    """The 29 fact columns (+ audit); merchant name and signup date are dropped."""
    return enriched.select(*FACT_COLUMNS, *_audit(updated_at, audit))


def fct_fraud_summary(fct: DataFrame, updated_at=None, audit: bool = True, by_day: bool = False) -> DataFrame:
    """Daily summary over COMPLETED rows by 10 keys (NULL keys are groups too).

    One hash aggregate with partial aggregation.  Nearly every row can be a group of its own, so the rows are dealt
    over all shuffle partitions first: the partial groups then do not stand beside the sorted joins of the
    enrichment in one task, nor in partitions merged by their bytes.  The amount spreads a hot group over tasks.
    ``by_day``: they are dealt by day instead, which is the only shuffle, and the result may be written by day as it
    stands; for a fact stored by day, whose days are counted first, so that a hot day is spread by its other keys.
    """
    is_fraud = F.col("is_fraudulent") == F.lit(True)
    fraud_n = C.count_if(is_fraud)
    n = F.count(F.lit(1))
    fraud_volume = C.sum_if(F.col("is_fraudulent"), "amount")
    volume = F.sum("amount")
    rows, groups = fct.where(F.col("status") == "COMPLETED"), SUMMARY_KEYS
    if by_day:
        read = [*SUMMARY_KEYS, "amount", "is_fraudulent", "card_anomaly_flag", "high_risk_merchant_flag", "composite_risk_score"]
        rows = dealt_by(rows.select(*read), SUMMARY_KEYS[0], SUMMARY_KEYS[1:], rows_by(fct, SUMMARY_KEYS[0]), coalesced=False)
        groups = [*SUMMARY_KEYS, SLOT]
    else:
        rows = rows.repartition(shuffle_partitions(fct), *SUMMARY_KEYS, "amount")
    return (
        rows.groupBy(*groups)
        .agg(
            n.alias("total_transactions"),
            volume.alias("total_volume"),
            F.avg("amount").alias("avg_txn_amount"),
            fraud_n.alias("fraud_count"),
            fraud_volume.alias("fraud_volume"),
            C.safe_divide(fraud_n, n).alias("fraud_rate"),
            C.safe_divide(fraud_volume, volume).alias("fraud_volume_rate"),
            C.count_if(F.col("card_anomaly_flag") == F.lit(True)).alias("card_anomaly_count"),
            C.count_if(F.col("high_risk_merchant_flag") == F.lit(True)).alias("high_risk_merchant_txn_count"),
            C.count_if(F.col("composite_risk_score") >= 3).alias("high_composite_risk_count"),
        )
        .drop(SLOT)
        .select("*", *_audit(updated_at, audit))
    )
