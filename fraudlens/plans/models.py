"""The model DAG as lazy DataFrames.

::

    raw.transactions → stg_transactions ┬→ enriched → fct_transactions → fct_fraud_summary
                                        ├→ customer_profile → dim_customers
                                        └→ merchant_risk    → dim_merchants
    raw.cards → stg_cards → enriched
    raw.customers → stg_customers → enriched, customer_profile
    raw.merchants → stg_merchants → enriched, merchant_risk

Every attribute is a lazy DataFrame built on first access; nothing executes
until a caller writes or collects.  ``as_of`` replaces the wall clock in the
card expiry rule and the incremental lookback, so reruns are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame

from fraudlens.operators import intermediate as I
from fraudlens.operators import marts as M
from fraudlens.operators import staging as S
from fraudlens.operators.lookup import DEFAULT_BROADCAST_MAX_ROWS
from fraudlens.sources.readers import RawSources


class FraudModels:
    def __init__(
        self,
        raw: RawSources,
        as_of: _dt.date | str | None = None,
        run_ts: _dt.datetime | str | None = None,
        audit: bool = True,
        max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
    ):
        self.raw = raw
        self.as_of = as_of
        self.run_ts = run_ts
        self.audit = audit
        self.max_broadcast_rows = max_broadcast_rows
        self.broadcast_decisions: list[bool] = []

    # staging ---------------------------------------------------------------
    @cached_property
    def stg_transactions(self) -> DataFrame:
        return S.stg_transactions(self.raw["transactions"], self.run_ts, self.audit)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return S.stg_customers(self.raw["customers"], self.run_ts, self.audit)

    @cached_property
    def stg_merchants(self) -> DataFrame:
        return S.stg_merchants(self.raw["merchants"], self.run_ts, self.audit)

    @cached_property
    def stg_cards(self) -> DataFrame:
        return S.stg_cards(self.raw["cards"], self.as_of, self.run_ts, self.audit)

    # intermediate ----------------------------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        return I.int_transactions_enriched(
            self.stg_transactions, self.stg_cards, self.stg_customers, self.stg_merchants,
            self.max_broadcast_rows, self.broadcast_decisions,
        )

    def fct_by_day(self, stored: bool = False) -> DataFrame:
        """The fact dealt by day, to be written without a further shuffle; ``stored``: the transactions stand in columnar files."""
        enriched = I.int_transactions_enriched(
            self.stg_transactions, self.stg_cards, self.stg_customers, self.stg_merchants,
            self.max_broadcast_rows, rebalance_by="transaction_date", stored=stored)
        return M.fct_transactions(enriched, self.run_ts, self.audit)

    @property
    def all_lookups_broadcast(self) -> bool:
        """True when every dimension of the enrichment was proven small and
        broadcast, i.e. the fact plan has no shuffle."""
        _ = self.enriched
        return bool(self.broadcast_decisions) and all(self.broadcast_decisions)

    @cached_property
    def customer_profile(self) -> DataFrame:
        return I.int_customer_spend_profile(self.stg_transactions, self.stg_customers)

    @cached_property
    def merchant_risk(self) -> DataFrame:
        return I.int_merchant_risk_score(self.stg_transactions, self.stg_merchants)

    # marts -----------------------------------------------------------------
    @cached_property
    def fct_transactions(self) -> DataFrame:
        return M.fct_transactions(self.enriched, self.run_ts, self.audit)

    @cached_property
    def fct_fraud_summary(self) -> DataFrame:
        return M.fct_fraud_summary(self.fct_transactions, self.run_ts, self.audit)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return M.dim_customers(self.customer_profile, self.run_ts, self.audit)

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return M.dim_merchants(self.merchant_risk, self.run_ts, self.audit)

    # SQL access ---------------------------------------------------------------
    MODEL_NAMES = (
        "stg_transactions", "stg_customers", "stg_merchants", "stg_cards",
        "enriched", "customer_profile", "merchant_risk",
        "fct_transactions", "fct_fraud_summary", "dim_customers", "dim_merchants",
    )

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every model (and the raw tables) as temp views for ``spark.sql``.

        Views are lazy: a SQL query over them is planned together with the
        model logic, so filters and column pruning still reach the scans.
        """
        self.raw.register_views(prefix=f"{prefix}raw_")
        names = [f"{prefix}raw_{t}" for t in self.raw]
        for name in self.MODEL_NAMES:
            getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")
            names.append(f"{prefix}{name}")
        return names
