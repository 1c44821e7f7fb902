"""Registered queries M1–M11: the eleven models over the whole shared tables."""

from __future__ import annotations

from fraudlens.plans.oracle import q
from fraudlens.plans.registry import models, register


@register("m1_stg_transactions", q("SELECT * FROM stg_transactions"))
def m1_stg_transactions(spark, sf_dir):
    return models(spark, sf_dir).stg_transactions


@register("m2_stg_customers", q("SELECT * FROM stg_customers"))
def m2_stg_customers(spark, sf_dir):
    return models(spark, sf_dir).stg_customers


@register("m3_stg_merchants", q("SELECT * FROM stg_merchants"))
def m3_stg_merchants(spark, sf_dir):
    return models(spark, sf_dir).stg_merchants


@register("m4_stg_cards", q("SELECT * FROM stg_cards"))
def m4_stg_cards(spark, sf_dir):
    return models(spark, sf_dir).stg_cards


@register("m5_transactions_enriched", q("SELECT * FROM enriched"))
def m5_transactions_enriched(spark, sf_dir):
    return models(spark, sf_dir).enriched


@register("m6_customer_spend_profile", q("SELECT * FROM profile"))
def m6_customer_spend_profile(spark, sf_dir):
    return models(spark, sf_dir).customer_profile


@register("m7_merchant_risk_score", q("SELECT * FROM risk"))
def m7_merchant_risk_score(spark, sf_dir):
    return models(spark, sf_dir).merchant_risk


@register("m8_dim_customers", q("SELECT * FROM dim_customers"))
def m8_dim_customers(spark, sf_dir):
    return models(spark, sf_dir).dim_customers


@register("m9_dim_merchants", q("SELECT * FROM dim_merchants"))
def m9_dim_merchants(spark, sf_dir):
    return models(spark, sf_dir).dim_merchants


@register("m10_fct_transactions", q("SELECT * FROM fct"))
def m10_fct_transactions(spark, sf_dir):
    return models(spark, sf_dir).fct_transactions


@register("m11_fraud_summary", q("SELECT * FROM fraud_summary"))
def m11_fraud_summary(spark, sf_dir):
    return models(spark, sf_dir).fct_fraud_summary
