"""Staging layer (M1–M4): type, trim and normalise each raw table.

Pure projections: one narrow stage per table, no shuffle, filters above
them still reach the Parquet scan.  Audit timestamps are a parameter so
re-runs can be made deterministic.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import columns as C

AUDIT_LOADED = "_loaded_at"


def _audit(loaded_at: _dt.datetime | str | Column | None) -> Column:
    return C.as_timestamp(loaded_at).alias(AUDIT_LOADED)


def stg_transactions(raw: DataFrame, loaded_at=None, audit: bool = True) -> DataFrame:
    is_fraud = F.col("is_fraudulent").cast("boolean")
    cols = [
        F.col("transaction_id"),
        F.col("card_id"),
        F.col("customer_id"),
        F.col("merchant_id"),
        C.to_amount("amount").alias("amount"),
        C.clean_upper("currency").alias("currency"),
        F.col("transaction_ts").cast("timestamp").alias("transaction_ts"),
        F.col("transaction_date").cast("date").alias("transaction_date"),
        F.col("hour_of_day").cast("bigint").alias("hour_of_day"),
        C.initcap_word("day_of_week").alias("day_of_week"),
        is_fraud.alias("is_fraudulent"),
        # a fraud type on a non-fraud row is erased; blank on fraud -> 'unknown'
        F.when(is_fraud == F.lit(True),
               F.coalesce(C.blank_to_null(C.trim_ws("fraud_type")), F.lit("unknown")))
        .otherwise(F.lit(None).cast("string")).alias("fraud_type"),
        F.col("is_cross_border").cast("boolean").alias("is_cross_border"),
        C.clean_upper("status").alias("status"),
    ]
    if audit:
        cols.append(_audit(loaded_at))
    return raw.select(*cols)


def stg_customers(raw: DataFrame, loaded_at=None, audit: bool = True) -> DataFrame:
    cols = [
        F.col("customer_id"),
        C.trim_ws("first_name").alias("first_name"),
        C.trim_ws("last_name").alias("last_name"),
        C.clean_lower("email").alias("email"),
        F.col("age").cast("bigint").alias("age"),
        C.trim_ws("age_band").alias("age_band"),
        C.clean_upper("country").alias("country"),
        C.trim_ws("city").alias("city"),
        F.col("signup_date").cast("date").alias("signup_date"),
        C.clean_upper("risk_tier").alias("risk_tier"),
        F.col("is_active").cast("boolean").alias("is_active"),
    ]
    if audit:
        cols.append(_audit(loaded_at))
    return raw.select(*cols)


def stg_merchants(raw: DataFrame, loaded_at=None, audit: bool = True) -> DataFrame:
    cols = [
        F.col("merchant_id"),
        C.trim_ws("merchant_name").alias("merchant_name"),
        F.coalesce(C.blank_to_null(C.clean_upper("category_code")), F.lit("UNKNOWN")).alias("category_code"),
        C.clean_upper("country").alias("country"),
        C.trim_ws("city").alias("city"),
        F.col("is_high_risk").cast("boolean").alias("is_high_risk"),
        F.col("onboarded_date").cast("date").alias("onboarded_date"),
        F.col("monthly_txn_limit").cast("bigint").alias("monthly_txn_limit"),
    ]
    if audit:
        cols.append(_audit(loaded_at))
    return raw.select(*cols)


def stg_cards(raw: DataFrame, as_of=None, loaded_at=None, audit: bool = True) -> DataFrame:
    """``is_expired`` is recomputed against ``as_of``; the raw flag is ignored."""
    expiry = F.col("expiry_date").cast("date")
    cols = [
        F.col("card_id"),
        F.col("customer_id"),
        C.clean_upper("card_type").alias("card_type"),
        F.col("card_last4"),
        F.col("issue_date").cast("date").alias("issue_date"),
        expiry.alias("expiry_date"),
        (expiry < C.as_date(as_of)).alias("is_expired"),
        F.col("is_blocked").cast("boolean").alias("is_blocked"),
    ]
    if audit:
        cols.append(_audit(loaded_at))
    return raw.select(*cols)
