"""Edge cases of the models on hand-written rows (exact expected values)."""

import datetime as dt
from decimal import Decimal

from fixtures import card, customer, merchant, raw_sources, txn

from fraudlens.operators import reports as R
from fraudlens.plans.models import FraudModels

MAX = "2024-12-30"


def _models(spark, transactions, customers, merchants, cards):
    return FraudModels(raw_sources(spark, transactions, customers, merchants, cards),
                       as_of="2024-12-31", audit=False)


def test_staging_cleaning(spark):
    t = [txn(" TXN_1", currency=" usd\t", status=" completed ", fraud=True, ftype="\t "),
         txn("TXN_2", fraud=False, ftype="stolen_card"),
         txn("TXN_3", fraud=True, ftype=" stolen_card ")]
    m = _models(spark, t, [], [merchant("M", category="\t ")], [card("C", expiry=dt.date(2024, 12, 30))])
    rows = {r.transaction_id: r for r in m.stg_transactions.collect()}
    r1 = rows[" TXN_1"]
    assert (r1.currency, r1.status, r1.fraud_type, r1.day_of_week) == ("USD", "COMPLETED", "unknown", "Monday")
    assert r1.amount == Decimal("10.000000000")
    assert rows["TXN_2"].fraud_type is None            # label on non-fraud row erased
    assert rows["TXN_3"].fraud_type == "stolen_card"
    assert m.stg_merchants.first().category_code == "UNKNOWN"
    assert m.stg_cards.first().is_expired is True      # recomputed against as_of, raw flag ignored


def test_enriched_join_misses_and_three_valued_flags(spark):
    t = [txn("T_ok", card="C1", cust="U1", merch="M1", fraud=True, xb=True),
         txn("T_nocard", card="C_missing", cust="U1", merch="M1"),
         txn("T_nocust", card="C1", cust="U_missing", merch="M1"),
         txn("T_nomerch", card="C1", cust="U1", merch="M_missing"),
         txn("T_nullblock_exp", card="C2", cust="U1", merch="M1"),
         txn("T_nullblock_ok", card="C3", cust="U1", merch="M1")]
    cards = [card("C1", cust="U1", blocked=True),
             (*card("C2", cust="U1", expiry=dt.date(2020, 1, 1))[:7], None),
             (*card("C3", cust="U1")[:7], None)]
    m = _models(spark, t, [customer("U1", tier="VERY_HIGH")], [merchant("M1", high=True)], cards)
    rows = {r.transaction_id: r for r in m.enriched.collect()}
    assert rows["T_ok"].composite_risk_score == 5
    assert rows["T_ok"].card_anomaly_flag is True
    for k in ("T_nocard", "T_nocust", "T_nomerch"):
        assert rows[k].composite_risk_score is None
    assert rows["T_nullblock_exp"].card_anomaly_flag is True   # NULL OR TRUE
    assert rows["T_nullblock_ok"].card_anomaly_flag is None    # NULL OR FALSE
    assert rows["T_nocust"].high_risk_customer_flag is None
    assert len(m.fct_transactions.columns) == 29


def test_customer_profile_windows_and_segments(spark):
    d = dt.date.fromisoformat(MAX)
    def day(n):
        return (d - dt.timedelta(days=n)).isoformat()
    t = [txn("MAXROW", cust="U1", date=MAX, status="DECLINED")]          # max held by a declined row
    t += [txn(f"W{n}", cust="U1", date=day(n), amount=100.0) for n in (7, 8, 30, 31)]
    t += [txn(f"A{i}", cust="U2", fraud=(i == 0)) for i in range(10)]     # rate exactly 0.10
    t += [txn(f"B{i}", cust="U3", fraud=(i < 3)) for i in range(100)]    # rate exactly 0.03
    t += [txn(f"C{i}", cust="U4", fraud=(i < 4)) for i in range(100)]    # 0.04
    t += [txn(f"E{i}", cust="U5", fraud=(i < 2)) for i in range(10)]     # 0.20
    custs = [customer(u) for u in ("U1", "U2", "U3", "U4", "U5", "U6")]
    m = _models(spark, t, custs, [merchant("MERCH_1")], [card("CARD_1")])
    rows = {r.customer_id: r for r in m.dim_customers.collect()}
    u1 = rows["U1"]
    assert (u1.txn_count_30d, u1.txn_count_7d, u1.lifetime_txn_count) == (3, 1, 4)
    assert u1.spend_30d == Decimal("300.00")
    assert u1.last_txn_date == d - dt.timedelta(days=7) and u1.days_since_last_txn == 7
    assert [rows[u].fraud_segment for u in ("U2", "U3", "U4", "U5", "U6")] == [
        "ELEVATED_FRAUD", "NORMAL", "ELEVATED_FRAUD", "HIGH_FRAUD", "NORMAL"]
    u6 = rows["U6"]                                                      # no completed rows: NULLs
    assert u6.lifetime_txn_count is None and u6.fraud_rate == 0.0 and u6.fraud_txn_count is None


def test_merchant_tiers_and_percentile_flags(spark):
    t = []
    for i in range(19):                       # 19 ordinary merchants: 1 row/day over 10 days, 1 fraud
        for k in range(10):
            t.append(txn(f"M{i}_{k}", merch=f"M{i}", date=f"2024-12-{10 + k}", fraud=(k == 0)))
    for k in range(40):                       # hot merchant: 40 rows in 2 days, 20 frauds
        t.append(txn(f"HOT_{k}", merch="HOT", date=f"2024-12-{10 + k % 2}", fraud=(k % 2 == 0)))
    merchants = [merchant(f"M{i}") for i in range(19)]
    merchants += [merchant("HOT", category="CRYPTO_EXCHANGE", high=True),
                  merchant("NOROWS_HIGH", category="MONEY_TRANSFER", high=True),
                  merchant("NOROWS_LOW")]
    m = _models(spark, t, [customer("CUST_1")], merchants, [card("CARD_1")])
    rows = {r.merchant_id: r for r in m.dim_merchants.collect()}
    hot = rows["HOT"]
    assert hot.high_fraud_rate_flag and hot.high_velocity_flag and hot.merchant_risk_tier == "CRITICAL"
    assert hot.avg_daily_txn_velocity == 20.0 and hot.fraud_rate == 0.5
    # 19 merchants share rate 0.1 = p95 position value → strict '>' keeps them unflagged
    assert rows["M0"].high_fraud_rate_flag is False and rows["M0"].merchant_risk_tier == "LOW"
    nh, nl = rows["NOROWS_HIGH"], rows["NOROWS_LOW"]
    assert (nh.total_txn_count, nh.total_volume, nh.high_fraud_rate_flag, nh.computed_high_risk_flag) == (
        0, Decimal("0.00"), None, True)
    assert nh.merchant_risk_tier == "HIGH"
    assert nl.computed_high_risk_flag is None and nl.merchant_risk_tier == "LOW"
    assert "MEDIUM" not in {r.merchant_risk_tier for r in rows.values()}   # unreachable branch


def test_fraud_summary_groups_keep_nulls_and_rates(spark):
    t = [txn("T1", fraud=True, ftype="stolen_card", amount=30.0),
         txn("T2", amount=70.0), txn("T3", amount=100.0, card="C_missing"),
         txn("T4", status="DECLINED")]
    m = _models(spark, t, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")])
    rows = m.fct_fraud_summary.collect()
    assert sum(r.total_transactions for r in rows) == 3                   # COMPLETED only
    fraud_group = [r for r in rows if r.fraud_type == "stolen_card"][0]
    assert fraud_group.fraud_rate == 1.0 and fraud_group.fraud_volume_rate == 1.0
    assert any(r.card_type is None for r in rows)                         # join miss is a group


def test_summary_groups_stand_apart_from_the_joins(spark):
    t = [txn(f"T{i}", date=f"2024-01-0{1 + 3 * (i % 2)}", amount=float(i)) for i in range(8)]
    m = FraudModels(raw_sources(spark, t, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]), as_of="2024-12-31", audit=False)
    plan = m.fct_fraud_summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("RepartitionByExpression") < plan.index("Join")
    daily = R.daily_totals(m.fct_fraud_summary)
    # the totals are kept: neither the spine nor the join runs the summary again
    assert "merchant_category" not in daily._jdf.queryExecution().optimizedPlan().toString()
    assert [(str(r[0]), r[1]) for r in daily.orderBy("transaction_date").collect()] == [
        ("2024-01-01", 4), ("2024-01-02", 0), ("2024-01-03", 0), ("2024-01-04", 4)]
