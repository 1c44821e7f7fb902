import pytest
from pyspark.sql import types as T

from fraudlens.sources.adapters import raw_from_driver_tables
from fraudlens.sources.readers import RawSources, file_sizes, read_raw_csv


def test_csv_roundtrip_failfast(spark, tmp_dir):
    raw = raw_from_driver_tables(spark, "/root/testdata/sf0.001")
    raw["merchants"].write.option("header", True).csv(f"{tmp_dir}/merchants.csv")
    back = read_raw_csv(spark, f"{tmp_dir}/merchants.csv", "merchants", id_type=T.LongType())
    assert back.count() == raw["merchants"].count() == 10
    assert back.schema["onboarded_date"].dataType == T.DateType()
    sizes = file_sizes(spark, f"{tmp_dir}/merchants.csv", fmt="csv").collect()
    assert sum(r.rows for r in sizes) == 10 and all(r.file_size > 0 for r in sizes)


def test_csv_bad_value_raises(spark, tmp_dir):
    path = f"{tmp_dir}/bad.csv"
    with open(path, "w") as f:
        f.write("merchant_id,merchant_name,category_code,country,city,is_high_risk,onboarded_date,monthly_txn_limit\n")
        f.write("MERCH_1,Shop,GROCERY,CA,Town,maybe,2020-01-01,10000\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path, "merchants").collect()


def test_raw_sources_lookup_and_views(spark):
    raw = raw_from_driver_tables(spark, "/root/testdata/sf0.001")
    assert set(raw) == {"transactions", "customers", "merchants", "cards"}
    raw.register_views()
    assert spark.sql("select count(*) from raw_cards").first()[0] == 300
    with pytest.raises(KeyError):
        RawSources({"nope": raw["cards"]})


def test_day_partition_detection(spark, tmp_dir):
    from fraudlens.sources.readers import is_partitioned_by
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "k string, transaction_date string")
    df.write.partitionBy("transaction_date").parquet(f"{tmp_dir}/by_day")
    df.write.parquet(f"{tmp_dir}/flat")
    assert is_partitioned_by(spark.read.parquet(f"{tmp_dir}/by_day"), "transaction_date")
    assert not is_partitioned_by(spark.read.parquet(f"{tmp_dir}/flat"), "transaction_date")


def test_file_sizes_match_the_file_system(spark, tmp_dir):
    import os

    from fraudlens.sources.readers import file_sizes
    spark.range(1000).repartition(3).write.parquet(f"{tmp_dir}/t")
    want = {f: os.path.getsize(f"{tmp_dir}/t/{f}") for f in os.listdir(f"{tmp_dir}/t") if f.endswith(".parquet")}
    got = file_sizes(spark, f"{tmp_dir}/t").collect()
    assert {os.path.basename(r["file_path"]): r["file_size"] for r in got} == want
    assert sum(r["rows"] for r in got) == 1000
