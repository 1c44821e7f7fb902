"""Explicit schemas of the four raw landing tables (no schema inference).

Ids are strings in the CSV landing files (``TXN_00000001`` ...); tables
derived from other sources may carry numeric ids, so every reader accepts an
``id_type``.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TABLES = ("transactions", "customers", "merchants", "cards")


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


def transactions_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        _f("transaction_id", T.StringType()),
        _f("card_id", id_type),
        _f("customer_id", id_type),
        _f("merchant_id", id_type),
        _f("amount", T.DoubleType()),
        _f("currency", T.StringType()),
        _f("transaction_ts", T.StringType()),
        _f("transaction_date", T.StringType()),
        _f("hour_of_day", T.LongType()),
        _f("day_of_week", T.StringType()),
        _f("is_fraudulent", T.BooleanType()),
        _f("fraud_type", T.StringType()),
        _f("is_cross_border", T.BooleanType()),
        _f("status", T.StringType()),
    ])


def customers_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        _f("customer_id", id_type),
        _f("first_name", T.StringType()),
        _f("last_name", T.StringType()),
        _f("email", T.StringType()),
        _f("age", T.LongType()),
        _f("age_band", T.StringType()),
        _f("country", T.StringType()),
        _f("city", T.StringType()),
        _f("signup_date", T.DateType()),
        _f("risk_tier", T.StringType()),
        _f("is_active", T.BooleanType()),
    ])


def merchants_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        _f("merchant_id", id_type),
        _f("merchant_name", T.StringType()),
        _f("category_code", T.StringType()),
        _f("country", T.StringType()),
        _f("city", T.StringType()),
        _f("is_high_risk", T.BooleanType()),
        _f("onboarded_date", T.DateType()),
        _f("monthly_txn_limit", T.LongType()),
    ])


def cards_schema(id_type: T.DataType = T.StringType()) -> T.StructType:
    return T.StructType([
        _f("card_id", id_type),
        _f("customer_id", id_type),
        _f("card_type", T.StringType()),
        _f("card_last4", T.StringType()),
        _f("issue_date", T.DateType()),
        _f("expiry_date", T.DateType()),
        _f("is_expired", T.BooleanType()),
        _f("is_blocked", T.BooleanType()),
    ])


RAW_SCHEMAS = {
    "transactions": transactions_schema,
    "customers": customers_schema,
    "merchants": merchants_schema,
    "cards": cards_schema,
}
