"""Files in the reference generator's CSV format (pandas ``to_csv``) load unchanged."""

import pandas as pd

from fraudlens.plans.models import FraudModels
from fraudlens.sources.readers import RawSources


def test_pandas_written_single_csv_files(spark, tmp_dir):
    pd.DataFrame([
        dict(customer_id="CUST_000001", first_name="Ann", last_name="Lee", email="ann@example.com", age=34,
             age_band="26-40", country="CA", city="Town", signup_date="2019-05-03", risk_tier="HIGH", is_active=True),
    ]).to_csv(f"{tmp_dir}/customers.csv", index=False)
    pd.DataFrame([
        dict(merchant_id="MERCH_00001", merchant_name="Shop Ltd", category_code="CRYPTO_EXCHANGE", country="US",
             city="Ville", is_high_risk=True, onboarded_date="2020-01-01", monthly_txn_limit=50000),
    ]).to_csv(f"{tmp_dir}/merchants.csv", index=False)
    pd.DataFrame([
        dict(card_id="CARD_0000001", customer_id="CUST_000001", card_type="VISA_CREDIT", card_last4="4821",
             issue_date="2021-02-03", expiry_date="2024-02-03", is_expired=True, is_blocked=False),
    ]).to_csv(f"{tmp_dir}/cards.csv", index=False)
    pd.DataFrame([
        dict(transaction_id="TXN_00000001", card_id="CARD_0000001", customer_id="CUST_000001",
             merchant_id="MERCH_00001", amount=123.45, currency="CAD", transaction_ts="2024-12-30 03:15:00",
             transaction_date="2024-12-30", hour_of_day=3, day_of_week="Monday", is_fraudulent=True,
             fraud_type="stolen_card", is_cross_border=True, status="COMPLETED"),
        dict(transaction_id="TXN_00000002", card_id="CARD_0000001", customer_id="CUST_000001",
             merchant_id="MERCH_00001", amount=5.5, currency="CAD", transaction_ts="2024-12-29 14:00:00",
             transaction_date="2024-12-29", hour_of_day=14, day_of_week="Sunday", is_fraudulent=False,
             fraud_type=None, is_cross_border=False, status="DECLINED"),
    ]).to_csv(f"{tmp_dir}/transactions.csv", index=False)

    m = FraudModels(RawSources.from_dir(spark, tmp_dir, fmt="csv"), as_of="2024-12-31", audit=False)
    fct = {r.transaction_id: r for r in m.fct_transactions.collect()}
    t1 = fct["TXN_00000001"]
    assert t1.fraud_type == "stolen_card" and t1.is_unusual_hour and t1.card_is_expired
    assert t1.composite_risk_score == 4 and t1.amount_bucket == "small ($50–$200)"
    assert fct["TXN_00000002"].fraud_type is None
    assert m.dim_merchants.first().merchant_risk_tier == "HIGH"
    assert m.dim_customers.first().lifetime_txn_count == 1
