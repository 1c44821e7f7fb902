"""Registered queries: one Spark callable and (where expressible) one SQL oracle each.

Every callable takes ``(spark, sf_dir)``, derives the raw tables from the
shared parquet files at ``sf_dir`` and returns a lazy DataFrame over the whole
tables.  ``as_of`` is pinned to the last order date of the data so results do
not depend on the wall clock; audit timestamps are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fraudlens.plans import oracle as O
from fraudlens.plans.models import FraudModels
from fraudlens.sources.adapters import AS_OF, raw_from_driver_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str) -> FraudModels:
    return FraudModels(raw_from_driver_tables(spark, sf_dir), as_of=AS_OF, audit=False)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # importing the modules registers their queries
    from fraudlens.plans import queries_models, queries_ops, queries_streaming  # noqa: F401


__all__ = ["register", "models", "queries", "oracle_sql", "O", "AS_OF"]
