from fixtures import card, customer, merchant, raw_sources, txn

from fraudlens.operators import quality as Q
from fraudlens.plans.models import FraudModels


def test_runner_counts_failures(spark):
    t = [txn("T1", amount=60000.0), txn("T1"), txn("T3", status="LOST"), txn("T4", merch="M_missing")]
    m = FraudModels(raw_sources(spark, t, [customer("CUST_1")], [merchant("MERCH_1")],
                                [card("CARD_1"), card("CARD_2", cust="NOBODY")]), as_of="2024-12-31", audit=False)
    tables = {"stg_transactions": m.stg_transactions, "stg_cards": m.stg_cards,
              "stg_customers": m.stg_customers, "fct_transactions": m.fct_transactions,
              "dim_merchants": m.dim_merchants}
    checks = [c for c in Q.DECLARED_CHECKS if c.model in tables and (c.parent is None or c.parent in tables)]
    res = {r.check_id: (r.failures, r.status) for r in Q.run_checks(tables, checks).collect()}
    assert res["unique:stg_transactions.transaction_id"] == (1, "fail")
    assert res["accepted_range:stg_transactions.amount"] == (1, "fail")
    assert res["accepted_values:stg_transactions.status"] == (1, "fail")
    assert res["relationships:stg_cards.customer_id->stg_customers.customer_id"] == (1, "fail")
    assert res["relationships:fct_transactions.merchant_id->dim_merchants.merchant_id"] == (1, "fail")
    assert res["not_null:stg_transactions.amount"] == (0, "pass")


def test_singular_checks_and_freshness(spark):
    t = [txn(f"T{i}", fraud=(i < 2)) for i in range(10)] + [txn("F", date="2030-01-01")]
    m = FraudModels(raw_sources(spark, t, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    assert Q.fraud_rate_above(m.fct_transactions).count() == 1            # 2/11 > 5 %
    assert [r.transaction_id for r in Q.future_transactions(m.fct_transactions, "2025-01-01 00:00:00").collect()] == ["F"]
    f = Q.freshness(m.raw["transactions"], "transactions", "transaction_ts", "2030-01-03 00:00:00").first()
    assert f.freshness_status == "warn" and f.hours_since_load == 36.0


def test_a_source_without_rows_is_stale_and_all_checks_run(spark):
    m = FraudModels(raw_sources(spark, [], [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of="2024-12-31", audit=False)
    assert Q.freshness(m.raw["transactions"], "transactions", "transaction_ts").first().freshness_status == "error"
    tables = {f"raw_{t}": m.raw[t] for t in m.raw} | {t: getattr(m, t) for t in (
        "stg_transactions", "stg_customers", "stg_merchants", "stg_cards", "fct_transactions", "fct_fraud_summary",
        "dim_customers", "dim_merchants")}
    res = {r.check_id: r.status for r in Q.run_all_checks(tables, "2025-01-01 00:00:00").collect()}
    assert len(res) == 60 and res["freshness:raw_transactions.transaction_ts"] == "fail"
    assert res["fraud_rate:fct_transactions.is_fraudulent"] == res["future_transactions:fct_transactions.transaction_ts"] == "pass"


def test_unique_failures_stand_at_their_own_check(spark):
    names = ("stg_customers", "stg_merchants", "stg_cards")
    checks = [c for c in Q.checks_of("unique") if c.model in names]
    m = FraudModels(raw_sources(spark, [], [customer("C")], [merchant("M")], [card("A"), card("A"), card("B")]), as_of="2024-12-31", audit=False)
    res = {r.model: r.failures for r in Q.run_checks({t: getattr(m, t) for t in names}, checks).collect()}
    assert res == {"stg_customers": 0, "stg_merchants": 0, "stg_cards": 1}
    for bound in (0, None):
        res = {r.model: r.failures for r in Q.run_checks({t: getattr(m, t) for t in names}, checks, bound).collect()}
        assert res == {"stg_customers": 0, "stg_merchants": 0, "stg_cards": 1}
