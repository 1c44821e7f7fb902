"""Derive the four raw landing tables from the shared TPC-H-style test tables.

The shared tables are orders/lineitem shaped; payments, cards and fraud
labels are derived from them by integer arithmetic that any SQL engine
computes identically, so the same derivation can be written as plain SQL for
an independent oracle.  Deliberate dirt (padding, mixed case, blank codes,
dangling card ids, merchants and customers without transactions) exercises the
cleaning rules of the staging layer; no row of the tables is left out.

Scale notes: ``nation`` is the fixed 25-row TPC-H table, so broadcasting it
is bounded by definition.  ``customer`` and ``supplier`` grow with the scale
factor and are joined without hints: Catalyst broadcasts them only below
``spark.sql.autoBroadcastJoinThreshold`` (and AQE only when the measured
shuffle output is small); otherwise they are sort-merge joined.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.sources.readers import RawSources

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# --- fixed values of the derivation ----------------------------------------
AS_OF = "2001-08-01"  # largest order date of the shared tables at every scale
RISK_TIER_RAW = [(11, "low"), (16, "MEDIUM"), (19, "HIGH")]
RISK_TIER_RAW_TOP = "VERY_HIGH "
CATEGORY_RAW = [
    "grocery", "TRAVEL", " RESTAURANT", "ENTERTAINMENT", "RETAIL", "FUEL",
    "HEALTHCARE", "UTILITIES", "ONLINE_GAMING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER", "  ",
]
HIGH_RISK_CATEGORY_SLOTS = [8, 9, 10]
MONTHLY_LIMITS = [10000, 50000, 100000, 500000]
CARD_TYPE_RAW = ["visa_credit", "VISA_DEBIT", "MASTERCARD_CREDIT", "MASTERCARD_DEBIT", " AMEX_CREDIT"]
FRAUD_TYPE_RAW = ["  ", "card_not_present", "velocity_abuse", "account_takeover", "stolen_card", " synthetic_identity "]
AMOUNT_MULTIPLIERS = ["1.0000", "0.1000", "0.0100", "0.0010"]
STATUS_RAW = [(91, " completed "), (97, "DECLINED")]
STATUS_RAW_TOP = "Reversed"
# ---------------------------------------------------------------------------


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def _ladder(key: Column, steps: list[tuple[int, str]], top: str) -> Column:
    expr = None
    for bound, label in steps:
        expr = F.when(key < bound, label) if expr is None else expr.when(key < bound, label)
    return expr.otherwise(top)


def adapt_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    age = F.lit(18) + k % 63
    return (
        customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.concat(F.col("c_mktsegment"), F.lit("\u00a0\t")).alias("last_name"),
            F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM")).alias("email"),
            age.alias("age"),
            _ladder(age, [(26, "18-25"), (41, "26-40"), (61, "41-60")], "61+").alias("age_band"),
            F.concat(F.lit("\u3000 "), F.lower("n_name")).alias("country"),
            F.lower("n_name").alias("city"),
            F.date_add(F.lit("1990-01-01").cast("date"), (k % 1000).cast("int")).alias("signup_date"),
            _ladder(k % 20, RISK_TIER_RAW, RISK_TIER_RAW_TOP).alias("risk_tier"),
            (k % 25 != 0).alias("is_active"),
        )
    )


def adapt_merchants(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return (
        supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            k.alias("merchant_id"),
            F.col("s_name").alias("merchant_name"),
            _pick(CATEGORY_RAW, k % 12).alias("category_code"),
            F.col("n_name").alias("country"),
            F.lower("n_name").alias("city"),
            (k % 12).isin(HIGH_RISK_CATEGORY_SLOTS).alias("is_high_risk"),
            F.date_add(F.lit("2000-01-01").cast("date"), (k % 500).cast("int")).alias("onboarded_date"),
            _pick(MONTHLY_LIMITS, k % 4).cast("bigint").alias("monthly_txn_limit"),
        )
    )


def adapt_cards(customer: DataFrame) -> DataFrame:
    """Two cards per customer (slot 0/1)."""
    card_id = F.col("c_custkey") * 2 + F.col("slot")
    expiry = F.date_add(F.lit("2000-01-01").cast("date"), ((card_id * 37) % 1000).cast("int"))
    return (
        customer.select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("slot"))
        .select(
            card_id.alias("card_id"),
            F.col("c_custkey").alias("customer_id"),
            _pick(CARD_TYPE_RAW, card_id % 5).alias("card_type"),
            F.lpad((card_id % 10000).cast("string"), 4, "0").alias("card_last4"),
            F.date_sub(expiry, 3 * 365).alias("issue_date"),
            expiry.alias("expiry_date"),
            (expiry < F.lit(AS_OF).cast("date")).alias("is_expired"),
            (card_id % 33 == 0).alias("is_blocked"),
        )
    )


def adapt_transactions(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    by_day: bool = False,
) -> DataFrame:
    """``by_day``: rows are dealt by day, to be written without a further shuffle, before the columns that expressions add."""
    # every row stays; some merchants and customers hand theirs to their predecessor and have none
    supp_of, cust_of = F.col("l_suppkey"), F.col("o_custkey")
    li = lineitem.select(
        "l_orderkey", "l_partkey", supp_of.alias("line_suppkey"), "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    od = orders.select("o_orderkey", F.when(cust_of % 50 == 49, cust_of - 1).otherwise(cust_of).alias("o_custkey"),
                       F.col("o_orderdate").cast("date").alias("day"))
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"),
                       F.col("n_regionkey").alias("cn_region"))
    sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_regionkey").alias("sn_region"))
    cust = customer.select(F.col("c_custkey"), F.col("c_nationkey"))
    supp = supplier.select(F.col("s_suppkey"), F.col("s_nationkey"))

    merchant_of = F.col("line_suppkey")
    joined = (
        # orders meet their customer first: where customers are shuffled, no row of lineitem is
        li.join(od.join(cust, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("l_suppkey", F.when(merchant_of % 10 == 9, merchant_of - 1).otherwise(merchant_of))
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "l_partkey", "line_suppkey", "l_suppkey", "l_linenumber", "price", "o_custkey", "day", "c_nationkey", "s_nationkey")
    )
    joined = (
        (joined.hint("rebalance", "day") if by_day else joined)
        .join(F.broadcast(cn), F.col("c_nationkey") == F.col("cn_key"))
        .join(F.broadcast(sn), F.col("s_nationkey") == F.col("sn_key"))
    )
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    hour = (ok * 7 + ln * 5 + pk) % 24
    multiplier = _pick([Decimal(m) for m in AMOUNT_MULTIPLIERS], ln % 4)
    day = F.col("day")
    card = F.col("o_custkey") * 2 + ln % 2
    return joined.select(
        F.concat_ws("-", ok.cast("string"), ln.cast("string"), pk.cast("string"), F.col("line_suppkey").cast("string"),
                    (F.col("price") * 100).cast("bigint").cast("string")).alias("transaction_id"),
        F.when(card % 100 == 7, -card).otherwise(card).alias("card_id"),      # negative ids have no card
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("merchant_id"),
        (F.col("price") * multiplier).cast("decimal(18,9)").alias("amount"),
        F.concat(F.lit(" "), F.lower(F.substring("cn_name", 1, 3))).alias("currency"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
                 F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00")).alias("transaction_ts"),
        F.date_format(day, "yyyy-MM-dd").alias("transaction_date"),
        hour.cast("bigint").alias("hour_of_day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        ((ok * 31 + pk * 17 + ln) % 50 == 0).alias("is_fraudulent"),
        _pick(FRAUD_TYPE_RAW, pk % 6).alias("fraud_type"),
        (F.col("cn_region") != F.col("sn_region")).alias("is_cross_border"),
        _ladder(ok % 100, STATUS_RAW, STATUS_RAW_TOP).alias("status"),
    )


def raw_from_driver_tables(spark: SparkSession, sf_dir: str, by_day: bool = False) -> RawSources:
    """The four raw tables, derived lazily from the shared parquet files; ``by_day``: transactions dealt by day."""
    t = {name: read_driver_table(spark, sf_dir, name)
         for name in ("nation", "customer", "supplier", "orders", "lineitem")}
    return RawSources({
        "transactions": adapt_transactions(t["lineitem"], t["orders"], t["customer"], t["supplier"], t["nation"], by_day),
        "customers": adapt_customers(t["customer"], t["nation"]),
        "merchants": adapt_merchants(t["supplier"], t["nation"]),
        "cards": adapt_cards(t["customer"]),
    })
