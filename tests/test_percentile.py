import random

import pytest
from pyspark.sql import functions as F

from fraudlens.operators.percentile import percentile_cont_frame


@pytest.mark.parametrize("n,ties", [(0, 0.0), (1, 0.0), (7, 0.5), (3000, 0.34), (3000, 0.9)])
def test_exact_percentile_matches_builtin(spark, n, ties):
    rng = random.Random(n)
    vals = [(0.25 if rng.random() < ties else rng.random(),) for _ in range(n)] + [(None,)]
    df = spark.createDataFrame(vals, "x double").repartition(5)
    for p in (0.0, 0.05, 0.5, 0.95, 1.0):
        ours = percentile_cont_frame(df, "x", p, accuracy=100).first()[0]
        ref = df.agg(F.percentile("x", p)).first()[0]
        assert (ours is None and ref is None) or abs(ours - ref) < 1e-12, (n, p, ours, ref)


def test_bracket_fallback_is_still_exact(spark):
    # tiny accuracy makes the approximate bracket loose; the verified fallback keeps it exact
    df = spark.createDataFrame([(float(i % 17),) for i in range(2000)], "x double")
    for p in (0.33, 0.95):
        ours = percentile_cont_frame(df, "x", p, accuracy=2).first()[0]
        ref = df.agg(F.percentile("x", p)).first()[0]
        assert abs(ours - ref) < 1e-12


def test_several_columns_in_one_pass(spark):
    rng = random.Random(7)
    rows = [(rng.random(), float(rng.randint(0, 5)) if i % 3 else None, None) for i in range(1500)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = percentile_cont_frame(df, ["a", "b", "c"], 0.95, accuracy=50, alias=["pa", "pb", "pc"]).first()
    for col, name in (("a", "pa"), ("b", "pb")):
        ref = df.agg(F.percentile(col, 0.95)).first()[0]
        assert abs(got[name] - ref) < 1e-12
    assert got["pc"] is None


def test_approximate_opt_in_is_close(spark):
    from fraudlens.operators.intermediate import merchant_p95
    rng = random.Random(3)
    agg = spark.createDataFrame([(rng.random() / 10, rng.random() * 50) for _ in range(4000)],
                                "fraud_rate double, avg_daily_txn_velocity double")
    exact = merchant_p95(agg).first()
    approx = merchant_p95(agg, approximate=True, accuracy=10_000).first()
    assert abs(exact.p95_fraud_rate - approx.p95_fraud_rate) < 0.002
    assert abs(exact.p95_velocity - approx.p95_velocity) < 0.5
