"""Plan-shape and skew properties that matter at scale."""

import contextlib
import datetime as dt
import io

import pytest
from fixtures import card, customer, merchant, raw_sources, txn
from pyspark.sql import functions as F

from fraudlens.operators import dealing as D
from fraudlens.operators import marts as M
from fraudlens.operators import monthly as MM
from fraudlens.operators.lookup import bounded_broadcast
from fraudlens.plans import incremental as INC
from fraudlens.plans.models import FraudModels
from fraudlens.sources.adapters import raw_from_driver_tables


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed_rows():
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append(txn(f"T{i}", card="CARD_HOT", cust="CUST_HOT", fraud=(i % 9 == 0)))   # one hot key: 1/3
        elif i % 3 == 1:
            rows.append(txn(f"T{i}", card=None, cust=f"CUST_{i % 40}"))                      # NULL join keys
        else:
            rows.append(txn(f"T{i}", card=f"CARD_{i % 50}", cust=f"CUST_{i % 40}", merch=f"M{i % 7}"))
    return rows


def _models(spark, max_rows):
    cust = [customer("CUST_HOT", tier="HIGH")] + [customer(f"CUST_{k}") for k in range(40)]
    cards = [card("CARD_HOT", cust="CUST_HOT", blocked=True)] + [card(f"CARD_{k}", cust=f"CUST_{k % 40}") for k in range(50)]
    merch = [merchant("MERCH_1")] + [merchant(f"M{k}", high=(k == 3)) for k in range(7)]
    return FraudModels(raw_sources(spark, _skewed_rows(), cust, merch, cards), as_of="2024-12-31",
                       audit=False, max_broadcast_rows=max_rows)


def test_broadcast_only_behind_a_proven_bound(spark):
    small = spark.range(10)
    assert "broadcast" in _plan(small.join(bounded_broadcast(small, 10), "id")).lower()
    big = _models(spark, max_rows=0)                      # nothing may be broadcast
    plan = _plan(big.enriched)
    assert "SortMergeJoin" in plan and big.all_lookups_broadcast is False
    bc = _models(spark, max_rows=1_000_000)
    plan_bc = _plan(bc.enriched)
    assert "SortMergeJoin" not in plan_bc and bc.all_lookups_broadcast is True
    # no shuffle in the broadcast-only fact plan: it can be written without one
    assert "Exchange hashpartitioning" not in plan_bc and "Exchange rangepartitioning" not in plan_bc


def test_skewed_keys_give_identical_results_on_both_join_paths(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            # keep the fallback path a shuffle join even at runtime, to see the skew split
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        shuffled = _models(spark, max_rows=0)
        broadcast = _models(spark, max_rows=1_000_000)
        for name in ("fct_transactions", "fct_fraud_summary", "dim_customers", "dim_merchants"):
            r = INC.relation_diff(getattr(shuffled, name), getattr(broadcast, name)).first()
            assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0), name
        enriched = shuffled.enriched
        enriched.collect()
        final = _plan(enriched).split("== Initial Plan ==")[0]
        assert final.count("SortMergeJoin") == 3 and final.count("skew=true") == 3   # hot key split by AQE
        hot = [r for r in broadcast.dim_customers.collect() if r.customer_id == "CUST_HOT"][0]
        assert hot.lifetime_txn_count == 1000 and hot.fraud_segment == "HIGH_FRAUD"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_distinct_counts_of_the_profile_multiply_no_rows(spark):
    m = _models(spark, 1_000_000)
    profile = m.customer_profile
    assert "Expand" not in _plan(profile)
    hot = profile.where("customer_id = 'CUST_HOT'").first()
    assert (hot.distinct_merchant_count, hot.distinct_card_count, hot.lifetime_txn_count) == (1, 1, 1000)
    per = {r.customer_id: (r.distinct_merchant_count, r.distinct_card_count) for r in profile.where("customer_id = 'CUST_2'").collect()}
    rows = [r for r in _skewed_rows() if r[2] == "CUST_2"]
    assert per == {"CUST_2": (len({r[3] for r in rows}), len({r[1] for r in rows} - {None}))}


def test_a_fact_dealt_by_day_is_written_without_another_shuffle(spark, tmp_dir):
    m = _models(spark, 1_000_000)
    assert _plan(m.fct_by_day()).count("REBALANCE_PARTITIONS_BY_COL") == 1
    INC.upsert(spark, m.fct_by_day(), f"{tmp_dir}/fct", by_day=True)
    r = INC.relation_diff(INC.read_table(spark, f"{tmp_dir}/fct"), m.fct_transactions).first()
    assert (r.rows_only_in_left, r.rows_only_in_right) == (0, 0)
    shuffled = _models(spark, 0)
    assert INC.relation_diff(shuffled.fct_by_day(), m.fct_transactions).first().asDict() == {"rows_only_in_left": 0, "rows_only_in_right": 0}


def test_rows_meet_large_dimensions_on_their_one_shuffle_by_day(spark):
    rows = [txn(f"T{i}", card=None if i % 11 == 0 else f"CARD_{i % 7}", cust=None if i % 13 == 0 else f"CUST_{i % 5}", merch=f"MERCH_{i % 2}",
                date="2024-12-30" if i % 3 else f"2024-12-{1 + i % 20:02d}") for i in range(300)] 
    rows += [(*t[:7], None, *t[8:]) for t in (txn("N1"), txn("N2", card="CARD_9"))]
    cards = [card(f"CARD_{i}", blocked=i % 2 == 0) for i in range(6)] + [card("CARD_1", expiry=dt.date(2020, 1, 1)), card(None)]
    customers = [customer(f"CUST_{i}", country=f"C{i}") for i in range(4)] + [customer("CUST_2", tier="HIGH")]
    m = FraudModels(raw_sources(spark, rows, customers, [merchant("MERCH_0"), merchant("MERCH_1")], cards), as_of="2024-12-31", audit=False, max_broadcast_rows=3)
    met = m.fct_by_day(stored=True)
    plan = _plan(met)
    assert "REBALANCE" not in plan and plan.count("REPARTITION_BY_COL") == 1
    assert INC.relation_diff(met, m.fct_transactions).first().asDict() == {"rows_only_in_left": 0, "rows_only_in_right": 0}
    assert met.where("transaction_id = 'T1'").count() == 2 and met.where("transaction_id = 'N2'").count() == 1       # CARD_1 stands twice


def test_a_hot_day_is_dealt_to_several_tasks(spark):
    rows = spark.range(1000).selectExpr("if(id < 900, 'hot', concat('d', id % 9)) AS day", "id").unionByName(
        spark.range(200).selectExpr("cast(NULL AS string) AS day", "id"))
    counts = D.rows_by(rows, "day")
    assert counts["hot"] == 900 and counts[None] == 200
    dealt = D.dealt_by(rows, "day", ["id"], counts, coalesced=False, least_rows=100)
    slots = {r[0]: r[1] for r in dealt.groupBy("day").agg(F.count_distinct(D.SLOT)).collect()}
    assert slots["hot"] == 2 and slots["d1"] == 1 and slots[None] == 1               # 4 tasks: a share is twice 300
    assert dealt.groupBy("day", D.SLOT, "id").count().count() == 1200
    assert D.dealt_by(rows, "day", ["id"], counts, least_rows=1).where("day = 'hot'").select(D.SLOT).distinct().count() == 2
    assert D.dealt_by(rows, "day", ["id"], counts).select(D.SLOT).distinct().count() == 1


def test_the_summary_of_a_fact_by_day_has_one_shuffle(spark, tmp_dir):
    m = _models(spark, 1_000_000)
    INC.upsert(spark, m.fct_by_day(), tmp_dir, by_day=True)
    fct = INC.read_table(spark, tmp_dir)
    summary = M.fct_fraud_summary(fct, audit=False, by_day=True)
    assert _plan(summary).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    assert INC.relation_diff(summary, m.fct_fraud_summary).first().asDict() == {"rows_only_in_left": 0, "rows_only_in_right": 0}


def test_months_are_dealt_once(spark):
    stg = _models(spark, 1_000_000).stg_transactions
    for by_month, plain in ((MM.merchant_month(stg, by_month=True), MM.merchant_month(stg)), (MM.links_month(stg, by_month=True), MM.links_month(stg))):
        assert _plan(by_month).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
        assert by_month.dtypes == plain.dtypes
        assert INC.relation_diff(by_month, plain).first().asDict() == {"rows_only_in_left": 0, "rows_only_in_right": 0}


def test_a_first_index_checks_the_keys_it_names(spark, tmp_dir, monkeypatch):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "y"), (None, "z")], "k string, day string")
    INC.save_schema(spark, tmp_dir, rows.schema)
    INC.index_new_table(spark, rows, tmp_dir, ["k"], "day")
    assert sorted(r.day for r in spark.read.parquet(f"{tmp_dir}/{INC.INDEX_DIR}").collect()) == ["x", "y", "y"]
    assert INC.key_days(spark, rows.where("k = 'a'"), tmp_dir, ["k"], "day") == ["x"]
    for twice in (rows.unionByName(rows.limit(1)), rows.unionByName(rows.where("k IS NULL"))):
        with pytest.raises(INC.DuplicateKeyError):
            INC.index_new_table(spark, twice, tmp_dir + "/twice", ["k"], "day")
    # two keys of one hash are no repeated key, and both days are named
    entries = INC._index_entries
    monkeypatch.setattr(INC, "_index_entries", lambda *a: entries(*a).withColumn("name", F.lit(5).cast("bigint")).withColumn("bucket", F.lit(5)))
    INC.index_new_table(spark, rows.limit(3), tmp_dir + "/met", ["k"], "day")
    assert sorted(r.day for r in spark.read.parquet(f"{tmp_dir}/met/{INC.INDEX_DIR}").collect()) == ["x", "y", "y"]


def test_landing_by_day_gives_the_same_rows(spark):
    dealt, plain = (raw_from_driver_tables(spark, "/root/testdata/sf0.001", by_day)["transactions"] for by_day in (True, False))
    assert dealt.dtypes == plain.dtypes and "REBALANCE" in _plan(dealt)
    assert INC.relation_diff(dealt, plain).first().asDict() == {"rows_only_in_left": 0, "rows_only_in_right": 0}
