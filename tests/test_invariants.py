"""Invariants across the model DAG on the shared tables, and sizing rules."""

from pyspark.sql import functions as F

from fraudlens.plans.registry import models
from fraudlens.session import scale_conf

SF = "/root/testdata/sf0.001"


def test_summary_totals_equal_completed_fact_rows(spark):
    m = models(spark, SF)
    completed = m.fct_transactions.where(F.col("status") == "COMPLETED").count()
    total = m.fct_fraud_summary.agg(F.sum("total_transactions")).first()[0]
    fraud = m.fct_fraud_summary.agg(F.sum("fraud_count")).first()[0]
    assert total == completed
    assert fraud == m.fct_transactions.where("status = 'COMPLETED' and is_fraudulent").count()


def test_dimension_row_counts_equal_staging(spark):
    m = models(spark, SF)
    assert m.dim_customers.count() == m.stg_customers.count() == 150
    assert m.dim_merchants.count() == m.stg_merchants.count() == 10
    assert m.fct_transactions.count() == m.stg_transactions.count() == 6000


def test_scale_conf_sizes_partitions_to_the_data():
    tb100 = 100 * 1024 ** 4
    conf = scale_conf(tb100, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10 * 1024 ** 2, total_cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_models_as_sql_views(spark):
    m = models(spark, SF)
    names = m.register_views(prefix="t_")
    assert "t_dim_merchants" in names and "t_raw_transactions" in names
    by_sql = spark.sql("""
        SELECT merchant_category, sum(fraud_volume) AS fraud_volume
        FROM t_fct_fraud_summary GROUP BY merchant_category ORDER BY fraud_volume DESC""").collect()
    by_df = m.fct_fraud_summary.groupBy("merchant_category").agg(F.sum("fraud_volume").alias("v")).collect()
    assert {r[0]: r[1] for r in by_sql} == {r[0]: r[1] for r in by_df}
    assert spark.sql("SELECT count(*) FROM t_dim_merchants WHERE merchant_risk_tier = 'HIGH'").first()[0] == 2
