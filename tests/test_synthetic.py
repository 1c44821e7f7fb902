"""Distributed generator: determinism, distributions, and an end-to-end run on its CSV output."""

from pyspark.sql import functions as F

from fraudlens.operators import quality as Q
from fraudlens.plans import incremental as INC
from fraudlens.plans.models import FraudModels
from fraudlens.sources import synthetic as G
from fraudlens.sources.readers import RawSources

SIZES = dict(n_transactions=20_000, n_customers=500, n_merchants=50, n_cards=800)


def test_output_independent_of_partitioning(spark):
    a = G.generate(spark, partitions=1, **SIZES)["transactions"]
    b = G.generate(spark, partitions=7, **SIZES)["transactions"]
    r = INC.relation_diff(a, b).first()
    assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0)


def test_distributions_and_contracts(spark):
    raw = G.generate(spark, **SIZES)
    t = raw["transactions"]
    s = t.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("transaction_id").alias("ids"),
        F.avg(F.col("is_fraudulent").cast("int")).alias("fraud"),
        F.avg((F.col("status") == "COMPLETED").cast("int")).alias("completed"),
        F.min("amount").alias("lo"), F.max("amount").alias("hi"),
        F.count_if(F.col("is_fraudulent") != F.col("fraud_type").isNotNull()).alias("type_mismatch"),
        F.min("transaction_date").alias("d0"), F.max("transaction_date").alias("d1"),
        F.count_if(F.col("customer_id") == "UNKNOWN").alias("unknown"),
    ).first()
    assert s.n == s.ids == 20_000
    assert 0.015 < s.fraud < 0.025 and 0.89 < s.completed < 0.93
    assert s.lo >= 0.5 and s.hi <= 50_000 and s.type_mismatch == 0
    assert s.d0 >= "2022-01-01" and s.d1 <= "2024-12-30" and s.unknown == 0
    high = raw["merchants"].where(F.col("is_high_risk")).select("category_code").distinct().collect()
    assert {r[0] for r in high} <= set(G.HIGH_RISK_CATEGORIES)


def test_csv_sink_feeds_the_models(spark, tmp_dir):
    G.write_raw(G.generate(spark, **SIZES), tmp_dir, fmt="csv")
    raw = RawSources.from_dir(spark, tmp_dir, fmt="csv")
    m = FraudModels(raw, as_of="2024-12-31", audit=False)
    assert m.fct_transactions.count() == 20_000
    tables = {"stg_transactions": m.stg_transactions, "stg_customers": m.stg_customers,
              "stg_merchants": m.stg_merchants, "stg_cards": m.stg_cards}
    checks = [c for c in Q.DECLARED_CHECKS if c.model in tables]
    failed = [r.check_id for r in Q.run_checks(tables, checks).collect() if r.status != "pass"]
    assert failed == []
    tiers = {r[0] for r in m.dim_merchants.select("merchant_risk_tier").distinct().collect()}
    assert tiers <= {"CRITICAL", "HIGH", "LOW"}
