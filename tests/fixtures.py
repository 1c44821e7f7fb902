"""Hand-written raw tables (string ids, as in the CSV landing files)."""

from __future__ import annotations

import datetime as dt

from fraudlens.sources.readers import RawSources
from fraudlens.sources.schemas import cards_schema, customers_schema, merchants_schema, transactions_schema

D = dt.date


def txn(tid, card="CARD_1", cust="CUST_1", merch="MERCH_1", amount=10.0, date="2024-12-30", hour=12,
        fraud=False, ftype=None, xb=False, status="COMPLETED", currency="usd"):
    ts = f"{date} {hour:02d}:00:00"
    return (tid, card, cust, merch, amount, currency, ts, date, hour, "monday", fraud, ftype, xb, status)


def customer(cid, tier="LOW", country="CA", band="26-40"):
    return (cid, "Ann", "Lee", "A@X.COM", 30, band, country, "Town", D(2019, 1, 1), tier, True)


def merchant(mid, category="GROCERY", high=False, country="CA"):
    return (mid, "Shop", category, country, "Town", high, D(2019, 1, 1), 10000)


def card(cid, cust="CUST_1", blocked=False, expiry=D(2030, 1, 1)):
    return (cid, cust, "visa_credit", "1234", D(2020, 1, 1), expiry, False, blocked)


def raw_sources(spark, transactions, customers=(), merchants=(), cards=()):
    return RawSources({
        "transactions": spark.createDataFrame(list(transactions), transactions_schema()),
        "customers": spark.createDataFrame(list(customers), customers_schema()),
        "merchants": spark.createDataFrame(list(merchants), merchants_schema()),
        "cards": spark.createDataFrame(list(cards), cards_schema()),
    })
