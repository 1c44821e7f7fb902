"""Intermediate layer (M5–M7): enrichment, customer profile, merchant risk.

Plan shape at scale
-------------------
* M5 is three left lookups from the fact to dimensions (broadcast when the
  dimension is provably small, else sort-merge with AQE skew splitting).
  For a write by day, large dimensions are looked up once for each (day, card, customer), and
  the rows meet what was found by day: they are shuffled once, not once for each dimension and the write.
* M6/M7 are one ``groupBy`` each over the COMPLETED fact rows, with map-side
  partial aggregation, so a hot customer/merchant key costs one row per map
  task.  The two exact distinct counts of M6 are two aggregations of their own
  over (customer, merchant | card), which spreads a hot customer across tasks: no
  Expand multiplies the rows.  The columns of M6 are staged once for all of them.
* The "latest date in the data" anchor is a scalar subquery computed once and
  shared (no cross join, no driver round trip).
* The merchant 95th percentiles come from :mod:`fraudlens.operators.percentile`
  (exact, distributed) over the per-merchant aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlens.functions import columns as C
from fraudlens.operators.dealing import SLOT, dealt_by, rows_by
from fraudlens.operators.lookup import DEFAULT_BROADCAST_MAX_ROWS, bounded_broadcast
from fraudlens.operators.percentile import percentile_cont_frame
from fraudlens.session import materialize, staged

COMPLETED = "COMPLETED"


def completed(stg_txn: DataFrame) -> DataFrame:
    return stg_txn.where(F.col("status") == COMPLETED)


def latest_txn_date(stg_txn: DataFrame) -> Column:
    """Scalar subquery: max(transaction_date) over all statuses."""
    return stg_txn.agg(F.max("transaction_date")).scalar()


# --------------------------------------------------------------------- M5
def _looked_up_by_day(t: DataFrame, cards: DataFrame, customers: DataFrame, day: str, least_rows: int | None = None) -> DataFrame:
    """``t`` with the columns of both dimensions, as two left joins give them, dealt by ``day``."""
    ids = ["card_id", "customer_id"]
    found = t.select(day, *ids).distinct().join(cards, "card_id", "left").join(customers, "customer_id", "left")
    added = [c for c in found.columns if c not in (day, *ids)]
    kind = found.select(F.struct(*added).alias("v")).schema["v"].dataType
    rows = t.withColumn("__found", F.lit(None).cast(kind))
    others = [F.lit(None).cast(t.schema[c].dataType).alias(c) for c in t.columns if c not in (day, *ids)]
    met = dealt_by(rows.withColumn("__row", F.lit(True)).unionByName(
        found.select(day, *ids, *others, F.struct(*added).alias("__found"), F.lit(False).alias("__row"))), day, ids, rows_by(t, day), least_rows=least_rows)
    # what was found for the ids of a row: several where a dimension holds an id several times, one of NULLs where it does not
    every = F.collect_list("__found").over(Window.partitionBy(day, SLOT, "customer_id", "card_id"))
    one = met.withColumn("__every", every).where("__row").withColumn("__one", F.explode("__every"))
    return one.select(*t.columns, *[F.col("__one")[c].alias(c) for c in added])


def int_transactions_enriched(
    stg_txn: DataFrame,
    stg_cards: DataFrame,
    stg_customers: DataFrame,
    stg_merchants: DataFrame,
    max_broadcast_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
    decisions: list | None = None,
    rebalance_by: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """``rebalance_by``: deal the rows by this column, for a write without a shuffle of its own, before
    the columns that a broadcast or an expression can add afterwards.  ``stored``: the rows are read from
    files and cost little to read again, so that large dimensions may be looked up before the rows are dealt."""
    cards = stg_cards.select(
        "card_id", "card_type",
        F.col("is_expired").alias("card_is_expired"),
        F.col("is_blocked").alias("card_is_blocked"),
    )
    customers = stg_customers.select(
        "customer_id",
        F.col("country").alias("customer_country"),
        F.col("age_band").alias("customer_age_band"),
        F.col("risk_tier").alias("customer_risk_tier"),
        F.col("signup_date").alias("customer_signup_date"),
    )
    merchants = stg_merchants.select(
        "merchant_id", "merchant_name",
        F.col("category_code").alias("merchant_category"),
        F.col("country").alias("merchant_country"),
        F.col("is_high_risk").alias("merchant_is_high_risk"),
    )
    t = stg_txn.drop("_loaded_at")
    decisions = [] if decisions is None else decisions
    cards, customers, merchants = (bounded_broadcast(dim, max_broadcast_rows, decisions) for dim in (cards, customers, merchants))
    small_cards, small_customers, small_merchants = decisions[-3:]
    if rebalance_by and stored and small_merchants and not (small_cards and small_customers):
        joined, rebalance_by = _looked_up_by_day(t, cards, customers, rebalance_by), None
    else:
        joined = t.join(cards, "card_id", "left").join(customers, "customer_id", "left")
    if rebalance_by and small_merchants:
        joined = joined.hint("rebalance", rebalance_by)
    joined = joined.join(merchants, "merchant_id", "left")
    if rebalance_by and not small_merchants:
        joined = joined.hint("rebalance", rebalance_by)

    high_risk_customer = F.col("customer_risk_tier").isin(C.HIGH_RISK_TIERS)
    # NULL-propagating sum: any lookup miss makes the score NULL
    score = (
        C.flag_as_int(F.col("is_fraudulent"))
        + C.flag_as_int(F.col("is_cross_border"))
        + C.flag_as_int(F.col("card_is_blocked"))
        + C.flag_as_int(F.col("merchant_is_high_risk"))
        + C.flag_as_int(high_risk_customer)
    )
    return joined.select(
        "transaction_id", "transaction_ts", "transaction_date", "hour_of_day", "day_of_week",
        "amount", "currency", "status",
        "is_fraudulent", "fraud_type",
        "card_id", "card_type", "card_is_expired", "card_is_blocked",
        "customer_id", "customer_country", "customer_age_band", "customer_risk_tier", "customer_signup_date",
        "merchant_id", "merchant_name", "merchant_category", "merchant_country", "merchant_is_high_risk",
        "is_cross_border",
        ((F.col("card_is_blocked") == F.lit(True)) | (F.col("card_is_expired") == F.lit(True))).alias("card_anomaly_flag"),
        F.col("merchant_is_high_risk").alias("high_risk_merchant_flag"),
        high_risk_customer.alias("high_risk_customer_flag"),
        C.is_unusual_hour("hour_of_day").alias("is_unusual_hour"),
        C.amount_bucket("amount").alias("amount_bucket"),
        score.alias("composite_risk_score"),
    )


# --------------------------------------------------------------------- M6
SPEND_COLUMNS = ["customer_id", "merchant_id", "card_id", "amount", "transaction_date", "hour_of_day", "is_fraudulent", "is_cross_border", "status"]


def customer_spend_agg(stg_txn: DataFrame, ref_date: Column | None = None) -> DataFrame:
    """Per-customer aggregate over COMPLETED rows (unrounded); customers match NULL-safely, as groups do."""
    ref = latest_txn_date(stg_txn) if ref_date is None else ref_date
    day = F.col("transaction_date")
    in_30d = day >= F.date_sub(ref, C.WINDOW_30D)
    in_7d = day >= F.date_sub(ref, C.WINDOW_7D)
    is_fraud = F.col("is_fraudulent") == F.lit(True)
    life = (
        completed(stg_txn)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("lifetime_txn_count"),
            F.sum("amount").alias("lifetime_spend"),
            F.avg("amount").alias("avg_txn_amount"),
            F.min(day).alias("first_txn_date"),
            F.max(day).alias("last_txn_date"),
            C.count_if(in_30d).alias("txn_count_30d"),
            C.sum_if(in_30d, "amount").alias("spend_30d"),
            C.count_if(in_7d).alias("txn_count_7d"),
            C.count_if(is_fraud).alias("fraud_txn_count"),
            C.sum_if(F.col("is_fraudulent"), "amount").alias("fraud_amount"),
            C.count_if(F.col("is_cross_border") == F.lit(True)).alias("cross_border_txn_count"),
            C.count_if(C.is_unusual_hour("hour_of_day")).alias("unusual_hour_txn_count"),
            F.max("amount").alias("max_single_txn_amount"),
        )
    )
    for column, name in (("merchant_id", "distinct_merchant_count"), ("card_id", "distinct_card_count")):
        links = completed(stg_txn).select(F.col("customer_id").alias("_customer_id"), column).distinct()
        part = links.groupBy("_customer_id").agg(F.count(column).alias(name))
        life = life.join(part, life["customer_id"].eqNullSafe(part["_customer_id"]), "left").drop("_customer_id")
    return life


def int_customer_spend_profile(stg_txn: DataFrame | None, stg_customers: DataFrame, agg: DataFrame | None = None,
                               ref: Column | None = None, stage: bool = True) -> DataFrame:
    """Customers ⟕ spend aggregate; customers without COMPLETED rows keep NULLs.

    ``agg`` and ``ref``: the aggregate and the reference date, where they are known already.  With ``stage`` the
    columns read are written once, so that the transactions are derived a single time.
    """
    if agg is None and stage:
        stg_txn = staged(stg_txn.select(*SPEND_COLUMNS), "spend")
    ref = latest_txn_date(stg_txn) if ref is None else ref
    agg = customer_spend_agg(stg_txn, ref) if agg is None else agg
    cu = stg_customers.select("customer_id", "country", "age_band", "risk_tier", "signup_date")
    return cu.join(agg, "customer_id", "left").select(
        "customer_id", "country", "age_band", "risk_tier", "signup_date",
        "lifetime_txn_count",
        C.round_money("lifetime_spend").alias("lifetime_spend"),
        C.round_money("avg_txn_amount").alias("avg_txn_amount"),
        "first_txn_date", "last_txn_date",
        "distinct_merchant_count", "distinct_card_count",
        "txn_count_30d",
        C.round_money("spend_30d").alias("spend_30d"),
        "txn_count_7d", "fraud_txn_count",
        C.round_money("fraud_amount").alias("fraud_amount"),
        C.safe_divide("fraud_txn_count", "lifetime_txn_count").alias("fraud_rate"),
        "cross_border_txn_count", "unusual_hour_txn_count",
        C.round_money("max_single_txn_amount").alias("max_single_txn_amount"),
        F.datediff(ref, F.col("last_txn_date")).cast("bigint").alias("days_since_last_txn"),
    )


# --------------------------------------------------------------------- M7
def merchant_agg(stg_txn: DataFrame) -> DataFrame:
    """Per-merchant aggregate over COMPLETED rows (unrounded)."""
    day = F.col("transaction_date")
    fraud_n = C.count_if(F.col("is_fraudulent") == F.lit(True))
    n = F.count(F.lit(1))
    return (
        completed(stg_txn)
        .groupBy("merchant_id")
        .agg(
            n.alias("total_txn_count"),
            fraud_n.alias("fraud_txn_count"),
            C.safe_divide(fraud_n, n).alias("fraud_rate"),
            F.sum("amount").alias("total_volume"),
            F.avg("amount").alias("avg_txn_amount"),
            F.max("amount").alias("max_txn_amount"),
            C.count_if(F.col("is_cross_border") == F.lit(True)).alias("cross_border_count"),
            C.safe_divide(n, F.datediff(F.max(day), F.min(day)) + F.lit(1)).alias("avg_daily_txn_velocity"),
        )
    )


def merchant_p95(agg: DataFrame, p: float = C.P95, approximate: bool = False,
                 accuracy: int = 10_000) -> DataFrame:
    """One row: ``percentile_cont`` of fraud rate and velocity.

    Exact by default.  ``approximate=True`` is the opt-in single-pass sketch
    (``percentile_approx``, rank error ≤ n/accuracy, no interpolation) for
    very large merchant populations where exact thresholds are not required.
    """
    if approximate:
        return agg.agg(
            F.percentile_approx("fraud_rate", p, accuracy).alias("p95_fraud_rate"),
            F.percentile_approx("avg_daily_txn_velocity", p, accuracy).alias("p95_velocity"),
        )
    return percentile_cont_frame(agg, ["fraud_rate", "avg_daily_txn_velocity"], p,
                                 alias=["p95_fraud_rate", "p95_velocity"])


def int_merchant_risk_score(
    stg_txn: DataFrame | None, stg_merchants: DataFrame, p: float = C.P95, checkpoint: bool = True,
    approximate_percentiles: bool = False, agg: DataFrame | None = None,
) -> DataFrame:
    """Merchants ⟕ per-merchant aggregate, flagged against exact 95th percentiles.

    The aggregate has one row per merchant; with ``checkpoint`` it is
    materialised once (reliable checkpoint) so the fact is scanned a single
    time although the percentile passes and the final join all read it.
    """
    agg = merchant_agg(stg_txn) if agg is None else agg
    if checkpoint:
        agg = materialize(agg)
    p95 = merchant_p95(agg, p, approximate_percentiles).select(F.struct("p95_fraud_rate", "p95_velocity")).scalar()
    p95_rate, p95_velocity = p95.getField("p95_fraud_rate"), p95.getField("p95_velocity")
    m = stg_merchants.select(
        "merchant_id", "merchant_name", "category_code", "country",
        F.col("is_high_risk").alias("inherent_high_risk"), "monthly_txn_limit",
    )
    zero_money = F.lit(0).cast(C.AMOUNT_TYPE)
    high_fraud = F.col("fraud_rate") > p95_rate
    return m.join(agg, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "category_code", "country", "inherent_high_risk", "monthly_txn_limit",
        F.coalesce("total_txn_count", F.lit(0)).alias("total_txn_count"),
        F.coalesce("fraud_txn_count", F.lit(0)).alias("fraud_txn_count"),
        C.round_rate(F.coalesce("fraud_rate", F.lit(0.0))).alias("fraud_rate"),
        C.round_money(F.coalesce("total_volume", zero_money)).alias("total_volume"),
        C.round_money(F.coalesce("avg_txn_amount", zero_money)).alias("avg_txn_amount"),
        C.round_money(F.coalesce("max_txn_amount", zero_money)).alias("max_txn_amount"),
        F.coalesce("cross_border_count", F.lit(0)).alias("cross_border_count"),
        C.round_rate(F.coalesce("avg_daily_txn_velocity", F.lit(0.0)), 2).alias("avg_daily_txn_velocity"),
        high_fraud.alias("high_fraud_rate_flag"),
        (F.col("avg_daily_txn_velocity") > p95_velocity).alias("high_velocity_flag"),
        ((F.col("inherent_high_risk") == F.lit(True)) | high_fraud).alias("computed_high_risk_flag"),
    )
