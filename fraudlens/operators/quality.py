"""Data-quality checks (Q1–Q8) and a runner.

Each check is a function ``(df, ...) → DataFrame of failing rows``; an empty
result means pass.  The runner turns a declarative list of checks into one
summary table ``(check_id, model, column_name, test, failures, status)``:

* row-level checks (``not_null``, ``accepted_values``, ``accepted_range``) of
  one table are fused into a single aggregate — one scan per table whatever
  the number of checks;
* all ``unique`` checks share one aggregation by (check, hash of value) with map-side
  partial counts (a hot duplicated value costs one row per map task), and only values whose hash comes again are compared;
* ``relationships`` is a left-anti join from child to the parent keys, with
  the parent broadcast only under a proven row bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import columns as C
from fraudlens.operators.lookup import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast
from fraudlens.session import materialize

# --- fixed values: the texts of the business assertions ----------------------
FRAUD_RATE_REASON = "Fraud rate exceeds 5% threshold — investigate pipeline or source data"
FUTURE_REASON = "Transaction timestamp is in the future"
# ---------------------------------------------------------------------------
SUMMARY_COLUMNS = ["check_id", "model", "column_name", "test", "failures", "status"]


# ------------------------------------------------------------ single checks
def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULLs ignored)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def not_null_pred(column: str):
    return F.col(column).isNull()


def accepted_values_pred(column: str, values: list):
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def accepted_range_pred(column: str, lo, hi):
    # NULL passes: NOT (NULL >= lo AND NULL <= hi) is NULL, which is not a failure
    return ~((F.col(column) >= F.lit(lo)) & (F.col(column) <= F.lit(hi)))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(not_null_pred(column))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(accepted_values_pred(column, values))


def accepted_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    return df.where(accepted_range_pred(column, lo, hi))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str,
    max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (dangling foreign keys)."""
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(bounded_broadcast(keys, max_broadcast_rows), column, "left_anti")


def fraud_rate_above(fct: DataFrame, threshold: float = C.MAX_FRAUD_RATE) -> DataFrame:
    """Q6: one row if the fraud rate of COMPLETED rows exceeds ``threshold``."""
    is_fraud = F.col("is_fraudulent") == F.lit(True)
    return (
        fct.where(F.col("status") == "COMPLETED")
        .agg(C.safe_divide(C.count_if(is_fraud), F.count(F.lit(1))).alias("overall_fraud_rate"))
        .where(F.col("overall_fraud_rate") > threshold)
        .select("overall_fraud_rate",
                F.lit(FRAUD_RATE_REASON).alias("failure_reason"))
    )


def future_transactions(fct: DataFrame, as_of_ts=None) -> DataFrame:
    """Q7: rows stamped after ``as_of_ts`` (default: now)."""
    return fct.where(F.col("transaction_ts") > C.as_timestamp(as_of_ts)).select(
        "transaction_id", "transaction_ts",
        F.lit(FUTURE_REASON).alias("failure_reason"),
    )


def freshness(
    df: DataFrame, table: str, loaded_at_field: str, as_of_ts=None,
    warn_hours: float = C.FRESHNESS_WARN_H, error_hours: float = C.FRESHNESS_ERROR_H,
) -> DataFrame:
    """Q8/S9: one row with the newest ``loaded_at_field`` and pass/warn/error; a source without rows is an error."""
    now = C.as_timestamp(as_of_ts)
    latest = F.max(F.col(loaded_at_field).cast("timestamp"))
    hours = (F.unix_timestamp(now) - F.unix_timestamp(latest)) / F.lit(3600.0)
    return df.agg(latest.alias("max_loaded_at"), hours.alias("h")).select(
        F.lit(table).alias("source_table"),
        F.col("max_loaded_at"),
        now.alias("checked_at"),
        C.round_rate("h", 3).alias("hours_since_load"),
        F.when(F.col("h").isNull() | (F.col("h") > error_hours), "error").when(F.col("h") > warn_hours, "warn")
        .otherwise("pass").alias("freshness_status"),
    )


# ------------------------------------------------------------ declarative runner
@dataclass(frozen=True)
class Check:
    test: str                      # unique | not_null | accepted_values | accepted_range | relationships
    model: str
    column: str
    values: tuple = ()
    lo: object = None
    hi: object = None
    parent: str | None = None
    parent_column: str | None = None

    @property
    def check_id(self) -> str:
        if self.test == "relationships":
            return f"relationships:{self.model}.{self.column}->{self.parent}.{self.parent_column}"
        return f"{self.test}:{self.model}.{self.column}"


def repeated_values(tables: dict[str, DataFrame], checks: list[Check], max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """(i, failures) of each ``unique`` check i that fails.

    One shuffle of hashes for the keys of all tables finds those that may occur again; only they are compared whole.
    """
    values = reduce(DataFrame.unionAll, [
        tables[c.model].select(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("v")).where("v IS NOT NULL")
        for i, c in enumerate(checks)]).withColumn("name", F.xxhash64("v"))
    again = materialize(values.groupBy("i", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("i", "name"))
    if max_broadcast_rows is None or again.count() <= max_broadcast_rows:
        values = values.join(F.broadcast(again) if max_broadcast_rows is not None else again, ["i", "name"], "left_semi")
    return (values.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .groupBy("i").agg(F.count(F.lit(1)).alias("failures")))


ROW_TESTS = ("not_null", "accepted_values", "accepted_range")


def _row_pred(chk: Check):
    if chk.test == "not_null":
        return not_null_pred(chk.column)
    if chk.test == "accepted_values":
        return accepted_values_pred(chk.column, list(chk.values))
    return accepted_range_pred(chk.column, chk.lo, chk.hi)


def _summary(check_id, model, column, test, failures):
    return [
        F.lit(check_id).alias("check_id"), F.lit(model).alias("model"),
        F.lit(column).alias("column_name"), F.lit(test).alias("test"),
        failures.cast("bigint").alias("failures"),
    ]


def _with_status(df: DataFrame) -> DataFrame:
    return df.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def run_checks(
    tables: dict[str, DataFrame], checks: list[Check],
    max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for chk in checks:
        if chk.test in ROW_TESTS:
            by_model.setdefault(chk.model, []).append(chk)
    for model, chks in by_model.items():
        wide = tables[model].agg(*[F.count_if(_row_pred(c)).alias(f"f{i}") for i, c in enumerate(chks)])
        rows = F.array(*[
            F.struct(*_summary(c.check_id, c.model, c.column, c.test, F.col(f"f{i}")))
            for i, c in enumerate(chks)
        ])
        parts.append(wide.select(F.explode(rows).alias("r")).select("r.*"))
    keys = [c for c in checks if c.test == "unique"]
    if keys:
        found = repeated_values(tables, keys, max_broadcast_rows).agg(*[
            F.coalesce(F.max(F.when(F.col("i") == i, F.col("failures"))), F.lit(0)).alias(f"f{i}") for i in range(len(keys))])
        rows = F.array(*[
            F.struct(*_summary(c.check_id, c.model, c.column, c.test, F.col(f"f{i}"))) for i, c in enumerate(keys)])
        parts.append(found.select(F.explode(rows).alias("r")).select("r.*"))
    for chk in checks:
        if chk.test != "relationships":
            continue
        failures = relationships(
            tables[chk.model], chk.column, tables[chk.parent], chk.parent_column, max_broadcast_rows
        ).agg(F.count(F.lit(1)).alias("n"))
        parts.append(failures.select(*_summary(chk.check_id, chk.model, chk.column, chk.test, F.col("n"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _with_status(out).select(*SUMMARY_COLUMNS)


def run_all_checks(tables: dict[str, DataFrame], as_of_ts=None) -> DataFrame:
    """The declared checks, then fraud rate (Q6), future rows (Q7) and freshness of the raw transactions (Q8).

    A freshness of ``warn`` keeps its status with 0 failures; ``error`` counts as one.
    """
    fct, n = tables["fct_transactions"], F.count(F.lit(1))
    singular = [
        ("fraud_rate", "fct_transactions", "is_fraudulent", fraud_rate_above(fct).agg(n.alias("n"))),
        ("future_transactions", "fct_transactions", "transaction_ts", future_transactions(fct, as_of_ts).agg(n.alias("n"))),
    ]
    out = run_checks(tables, DECLARED_CHECKS)
    for test, model, column, failures in singular:
        rows = failures.select(*_summary(f"{test}:{model}.{column}", model, column, test, F.col("n")))
        out = out.unionByName(_with_status(rows).select(*SUMMARY_COLUMNS))
    fresh = freshness(tables["raw_transactions"], "transactions", "transaction_ts", as_of_ts)
    status = F.col("freshness_status")
    rows = fresh.select(*_summary("freshness:raw_transactions.transaction_ts", "raw_transactions", "transaction_ts",
                                  "freshness", (status == "error").cast("bigint")),
                        F.when(status == "error", "fail").otherwise(status).alias("status"))
    return out.unionByName(rows.select(*SUMMARY_COLUMNS))


# ------------------------------------------------------------ the declared checks
STATUS = tuple(C.STATUSES)
_checks: list[Check] = []


def _declare(model: str, column: str, *tests, **kw) -> None:
    for t in tests:
        _checks.append(Check(t, model, column, **kw))


# sources (raw landing tables)
_declare("raw_transactions", "transaction_id", "unique", "not_null")
_declare("raw_transactions", "card_id", "not_null")
_declare("raw_transactions", "merchant_id", "not_null")
_declare("raw_transactions", "amount", "not_null")
_declare("raw_transactions", "amount", "accepted_range", lo=C.AMOUNT_RANGE[0], hi=C.AMOUNT_RANGE[1])
_declare("raw_transactions", "is_fraudulent", "not_null")
_declare("raw_transactions", "status", "accepted_values", values=STATUS)
_declare("raw_customers", "customer_id", "unique", "not_null")
_declare("raw_customers", "risk_tier", "accepted_values", values=tuple(C.RISK_TIERS))
_declare("raw_merchants", "merchant_id", "unique", "not_null")
_declare("raw_merchants", "category_code", "accepted_values", values=tuple(C.MERCHANT_CATEGORIES))
_declare("raw_cards", "card_id", "unique", "not_null")
_declare("raw_cards", "customer_id", "not_null")
_declare("raw_cards", "customer_id", "relationships", parent="raw_customers", parent_column="customer_id")
# staging
_declare("stg_transactions", "transaction_id", "unique", "not_null")
for _c in ("card_id", "customer_id", "merchant_id", "amount"):
    _declare("stg_transactions", _c, "not_null")
_declare("stg_transactions", "amount", "accepted_range", lo=C.AMOUNT_RANGE[0], hi=C.AMOUNT_RANGE[1])
for _c in ("currency", "transaction_ts", "is_fraudulent"):
    _declare("stg_transactions", _c, "not_null")
_declare("stg_transactions", "status", "accepted_values", values=STATUS)
_declare("stg_customers", "customer_id", "unique", "not_null")
_declare("stg_customers", "risk_tier", "accepted_values", values=tuple(C.RISK_TIERS))
_declare("stg_customers", "country", "not_null")
_declare("stg_merchants", "merchant_id", "unique", "not_null")
_declare("stg_merchants", "category_code", "not_null")
_declare("stg_cards", "card_id", "unique", "not_null")
_declare("stg_cards", "customer_id", "not_null")
_declare("stg_cards", "customer_id", "relationships", parent="stg_customers", parent_column="customer_id")
# marts
_declare("fct_transactions", "transaction_id", "unique", "not_null")
_declare("fct_transactions", "customer_id", "not_null")
_declare("fct_transactions", "merchant_id", "not_null")
_declare("fct_transactions", "merchant_id", "relationships", parent="dim_merchants", parent_column="merchant_id")
_declare("fct_transactions", "amount", "not_null")
_declare("fct_transactions", "amount", "accepted_range", lo=C.AMOUNT_RANGE[0], hi=C.AMOUNT_RANGE[1])
_declare("fct_transactions", "status", "accepted_values", values=STATUS)
_declare("fct_transactions", "composite_risk_score", "accepted_range", lo=C.SCORE_RANGE[0], hi=C.SCORE_RANGE[1])
_declare("dim_customers", "customer_id", "unique", "not_null")
_declare("dim_customers", "fraud_segment", "accepted_values", values=tuple(C.FRAUD_SEGMENTS))
_declare("dim_merchants", "merchant_id", "unique", "not_null")
_declare("dim_merchants", "merchant_risk_tier", "accepted_values", values=tuple(C.MERCHANT_TIERS))
_declare("fct_fraud_summary", "transaction_date", "not_null")
_declare("fct_fraud_summary", "fraud_rate", "accepted_range", lo=0, hi=1)

DECLARED_CHECKS: list[Check] = list(_checks)


def checks_of(test: str) -> list[Check]:
    return [c for c in DECLARED_CHECKS if c.test == test]
