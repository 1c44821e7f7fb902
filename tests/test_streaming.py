"""Streaming forms: micro-batches, late rows, dedup, batch equivalence."""

import time

from fixtures import card, customer, merchant, raw_sources, txn

from fraudlens.plans import incremental as INC
from fraudlens.plans.models import FraudModels
from fraudlens.sources.schemas import transactions_schema
from fraudlens.streaming import flows as SP


def _dims(spark):
    m = FraudModels(raw_sources(spark, [], [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    return m.stg_cards, m.stg_customers, m.stg_merchants


def _land(spark, path, rows):
    spark.createDataFrame(rows, transactions_schema()).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)   # distinct modification times keep the file order


def test_fact_stream_late_rows_and_duplicates(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _land(spark, landing, [txn("A", date="2024-12-20"), txn("A", date="2024-12-20"),   # exact re-delivery
                           txn("B", date="2024-12-25", amount=1.0)])
    _land(spark, landing, [txn("B", date="2024-12-25", amount=2.0),    # changed version: replaces B
                           txn("A", date="2024-12-20"),                # re-delivery in a later batch
                           txn("C", date="2024-12-23"),                # 2 days late
                           txn("D", date="2024-12-20", hour=1)])       # 5 days late: still merged
    stream = SP.read_transactions_stream(spark, landing, max_files_per_trigger=1)
    SP.start_fact_stream(stream, *_dims(spark), f"{tmp_dir}/fct", f"{tmp_dir}/cp").awaitTermination()
    got = sorted((r.transaction_id, float(r.amount)) for r in INC.read_table(spark, f"{tmp_dir}/fct").collect())
    assert got == [("A", 10.0), ("B", 2.0), ("C", 10.0), ("D", 10.0)]


def test_summary_stream_equals_batch_summary(spark, tmp_dir):
    rows = [txn(f"T{i}", date=f"2024-12-{20 + i % 4}", fraud=(i % 5 == 0), ftype="stolen_card",
                amount=float(i + 1), status="COMPLETED" if i % 7 else "DECLINED") for i in range(40)]
    landing = f"{tmp_dir}/landing"
    _land(spark, landing, rows)
    stream = SP.read_transactions_stream(spark, landing)
    SP.start_summary_stream(stream, *_dims(spark), f"{tmp_dir}/summary", f"{tmp_dir}/cp").awaitTermination()
    m = FraudModels(raw_sources(spark, rows, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    streamed = spark.read.parquet(f"{tmp_dir}/summary")
    r = INC.relation_diff(streamed, m.fct_fraud_summary).first()
    assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0)


def test_summary_stream_running_totals_across_micro_batches(spark, tmp_dir):
    first = [txn(f"A{i}", date="2024-12-20", amount=float(i + 1), fraud=(i == 0), ftype="stolen_card")
             for i in range(6)]
    second = [txn(f"B{i}", date="2024-12-20", amount=2.0) for i in range(4)] + [txn("C", date="2024-12-21")]
    landing = f"{tmp_dir}/landing"
    _land(spark, landing, first)
    _land(spark, landing, second)
    stream = SP.read_transactions_stream(spark, landing, max_files_per_trigger=1)
    SP.start_summary_stream(stream, *_dims(spark), f"{tmp_dir}/summary", f"{tmp_dir}/cp").awaitTermination()
    m = FraudModels(raw_sources(spark, first + second, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    streamed = spark.read.parquet(f"{tmp_dir}/summary")
    r = INC.relation_diff(streamed, m.fct_fraud_summary).first()
    assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0)
    non_fraud = [x for x in streamed.collect() if x.fraud_type is None and str(x.transaction_date) == "2024-12-20"][0]
    assert non_fraud.total_transactions == 9          # 5 from the first batch + 4 from the second


def test_fact_stream_from_csv_landing(spark, tmp_dir):
    landing = f"{tmp_dir}/csv"
    rows = [txn(f"T{i}", date=f"2024-12-{20 + i % 3}", amount=float(i) + 0.5) for i in range(12)]
    spark.createDataFrame(rows, transactions_schema()).coalesce(1).write.option("header", True).csv(landing)
    stream = SP.read_transactions_stream(spark, landing, fmt="csv")
    SP.start_fact_stream(stream, *_dims(spark), f"{tmp_dir}/fct", f"{tmp_dir}/cp").awaitTermination()
    got = sorted((r.transaction_id, float(r.amount)) for r in INC.read_table(spark, f"{tmp_dir}/fct").collect())
    assert got == sorted((f"T{i}", float(i) + 0.5) for i in range(12))


def test_fact_stream_keeps_summary_exact_under_corrections(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    first = [txn("A", date="2024-12-20", amount=5.0), txn("B", date="2024-12-20", amount=7.0)]
    second = [txn("A", date="2024-12-20", amount=50.0, fraud=True, ftype="stolen_card"),   # correction of A
              txn("B", date="2024-12-20", amount=7.0)]                                     # re-delivery of B
    _land(spark, landing, first)
    _land(spark, landing, second)
    stream = SP.read_transactions_stream(spark, landing, max_files_per_trigger=1)
    SP.start_fact_stream(stream, *_dims(spark), f"{tmp_dir}/fct", f"{tmp_dir}/cp",
                         summary_path=f"{tmp_dir}/summary").awaitTermination()
    latest = [second[0], first[1]]
    m = FraudModels(raw_sources(spark, latest, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    r = INC.relation_diff(spark.read.parquet(f"{tmp_dir}/summary"), m.fct_fraud_summary).first()
    assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0)


def test_rows_of_any_age_are_kept_in_every_micro_batch(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    batches = [[txn("B", date="2024-12-25")], [txn("C", date="2024-12-26")],
               [txn("D", date="2024-12-10"), txn("E", date="2024-12-26")], [txn("F", date="2023-01-01")]]
    for rows in batches:
        _land(spark, landing, rows)
    stream = SP.read_transactions_stream(spark, landing, max_files_per_trigger=1)
    SP.start_summary_stream(stream, *_dims(spark), f"{tmp_dir}/summary", f"{tmp_dir}/cp", fact_path=f"{tmp_dir}/fct").awaitTermination()
    assert sorted(r.transaction_id for r in INC.read_table(spark, f"{tmp_dir}/fct").collect()) == list("BCDEF")
    got = {str(r.transaction_date): r.total_transactions for r in spark.read.parquet(f"{tmp_dir}/summary").collect()}
    assert got == {"2023-01-01": 1, "2024-12-10": 1, "2024-12-25": 1, "2024-12-26": 2}


def test_only_ids_that_come_again_are_compared_whole(spark):
    from fraudlens.streaming.flows import without_redeliveries
    rows = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", 1), (None, 1), (None, 1), (None, 2)], "transaction_id string, v int")
    for bound in (100, 0):
        got = sorted(tuple(r) for r in without_redeliveries(rows, bound).fillna("").collect())
        assert got == [("", 1), ("", 2), ("A", 1), ("A", 2), ("B", 1)]
    single = spark.createDataFrame([("A", 1), ("B", 1)], "transaction_id string, v int")
    assert without_redeliveries(single) is single
