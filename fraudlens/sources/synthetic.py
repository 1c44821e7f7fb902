"""Synthetic raw data as a distributed Spark job (G1–G10).

Every random draw is a pure function of (seed, draw tag, row id) through
``xxhash64``, so the output does not depend on the number of partitions or
on task retries (``rand(seed)`` would), and any executor can regenerate any
slice.  Rows come from ``spark.range`` — nothing is built on the driver.

Distributions follow the reference generator: weighted country, category,
risk tier, status; uniform card type, limit, card, merchant, fraud type;
log-normal amounts (Box–Muller on two hash uniforms) scaled up for fraud and
clipped; uniform timestamps over 2022-01-01 … 2024-12-31 (end exclusive);
card expiry 2–5 years after issue.  Transactions are denormalised with
customer and country lookups (left joins with the size-checked broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.operators.lookup import lookup_join
from fraudlens.sources.readers import RawSources

# --- fixed values (must equal the reference generator's) --------------------
N_CUSTOMERS, N_MERCHANTS, N_CARDS, N_TRANSACTIONS = 50_000, 5_000, 80_000, 5_000_000
FRAUD_RATE = 0.02
START_TS, END_TS = "2022-01-01 00:00:00", "2024-12-31 00:00:00"
COUNTRIES = [("CA", 0.35), ("US", 0.30), ("GB", 0.10), ("IN", 0.08), ("AU", 0.05),
             ("DE", 0.04), ("FR", 0.03), ("SG", 0.03), ("NG", 0.02)]
MERCHANT_CATEGORIES = [("GROCERY", 0.18), ("TRAVEL", 0.12), ("RESTAURANT", 0.14), ("ENTERTAINMENT", 0.08),
                       ("RETAIL", 0.16), ("FUEL", 0.07), ("HEALTHCARE", 0.06), ("UTILITIES", 0.05),
                       ("ONLINE_GAMING", 0.06), ("CRYPTO_EXCHANGE", 0.04), ("MONEY_TRANSFER", 0.04)]
HIGH_RISK_CATEGORIES = ["ONLINE_GAMING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER"]
FRAUD_TYPES = ["card_not_present", "velocity_abuse", "account_takeover", "stolen_card", "synthetic_identity"]
RISK_TIERS = [("LOW", 0.55), ("MEDIUM", 0.25), ("HIGH", 0.15), ("VERY_HIGH", 0.05)]
CARD_TYPES = ["VISA_CREDIT", "VISA_DEBIT", "MASTERCARD_CREDIT", "MASTERCARD_DEBIT", "AMEX_CREDIT"]
MONTHLY_LIMITS = [10_000, 50_000, 100_000, 500_000]
CURRENCIES = {"CA": "CAD", "US": "USD", "GB": "GBP", "IN": "INR", "AU": "AUD", "DE": "EUR",
              "FR": "EUR", "SG": "SGD", "NG": "NGN"}
STATUSES = [("COMPLETED", 0.91), ("DECLINED", 0.06), ("REVERSED", 0.03)]
ACTIVE_SHARE, BLOCKED_SHARE = 0.92, 0.03
AMOUNT_LOG_MEAN, AMOUNT_LOG_SIGMA = 3.5, 1.2
FRAUD_AMOUNT_FACTOR = (1.5, 4.0)
AMOUNT_CLIP = (0.50, 50_000.00)
# ---------------------------------------------------------------------------

# Filler vocabularies (ours; only their shape matters, they are never aggregated).
FIRST_NAMES = ["Ada", "Bo", "Cyd", "Dee", "Eli", "Fay", "Gus", "Hal", "Ida", "Jo", "Kai", "Lu"]
LAST_NAMES = ["Ames", "Byrd", "Cole", "Dunn", "Egan", "Fox", "Gale", "Hart", "Ives", "Jude"]
CITIES = ["Northfield", "Eastport", "Westbury", "Southgate", "Lakeside", "Hillcrest", "Riverton"]
COMPANY_WORDS = ["Acme", "Globex", "Initech", "Umbra", "Vertex", "Nimbus", "Orbit", "Quanta"]


def uniform(seed: int, tag: str, row_id: Column) -> Column:
    """Deterministic U[0,1) from 53 hash bits of (seed, tag, id)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(tag), row_id), 11).cast("double") / F.lit(2.0 ** 53)


def weighted_choice(u: Column, weighted: list[tuple[str, float]]) -> Column:
    expr, acc = None, 0.0
    for value, w in weighted[:-1]:
        acc += w
        expr = F.when(u < acc, value) if expr is None else expr.when(u < acc, value)
    return expr.otherwise(weighted[-1][0])


def uniform_choice(u: Column, values: list) -> Column:
    idx = F.least(F.floor(u * len(values)), F.lit(len(values) - 1)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def uniform_int(u: Column, lo: int, hi: int) -> Column:
    """Integer uniform on [lo, hi] inclusive."""
    return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("bigint")


def random_date(u: Column, start: str, end: str) -> Column:
    days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date"))
    return F.date_add(F.lit(start).cast("date"), F.floor(u * days).cast("int"))


def _age_band(age: Column) -> Column:
    return F.when(age < 26, "18-25").when(age < 41, "26-40").when(age < 61, "41-60").otherwise("61+")


def customers(spark: SparkSession, n: int = N_CUSTOMERS, seed: int = 42, partitions: int | None = None) -> DataFrame:
    i = F.col("id")
    age = uniform_int(uniform(seed, "age", i), 18, 80)
    first, last = uniform_choice(uniform(seed, "first", i), FIRST_NAMES), uniform_choice(uniform(seed, "last", i), LAST_NAMES)
    return spark.range(1, n + 1, numPartitions=partitions).select(
        F.format_string("CUST_%06d", i).alias("customer_id"),
        first.alias("first_name"), last.alias("last_name"),
        F.lower(F.concat(first, F.lit("."), last, F.lit(i), F.lit("@example.com"))).alias("email"),
        age.alias("age"), _age_band(age).alias("age_band"),
        weighted_choice(uniform(seed, "country", i), COUNTRIES).alias("country"),
        uniform_choice(uniform(seed, "city", i), CITIES).alias("city"),
        random_date(uniform(seed, "signup", i), "2018-01-01", "2022-01-01").alias("signup_date"),
        weighted_choice(uniform(seed, "tier", i), RISK_TIERS).alias("risk_tier"),
        (uniform(seed, "active", i) < ACTIVE_SHARE).alias("is_active"),
    )


def merchants(spark: SparkSession, n: int = N_MERCHANTS, seed: int = 42, partitions: int | None = None) -> DataFrame:
    i = F.col("id")
    category = weighted_choice(uniform(seed, "category", i), MERCHANT_CATEGORIES)
    return spark.range(1, n + 1, numPartitions=partitions).select(
        F.format_string("MERCH_%05d", i).alias("merchant_id"),
        F.concat_ws(" ", uniform_choice(uniform(seed, "co1", i), COMPANY_WORDS),
                    uniform_choice(uniform(seed, "co2", i), LAST_NAMES), F.lit("Ltd")).alias("merchant_name"),
        category.alias("category_code"),
        weighted_choice(uniform(seed, "mcountry", i), COUNTRIES).alias("country"),
        uniform_choice(uniform(seed, "mcity", i), CITIES).alias("city"),
        category.isin(HIGH_RISK_CATEGORIES).alias("is_high_risk"),
        random_date(uniform(seed, "onboard", i), "2018-01-01", "2022-01-01").alias("onboarded_date"),
        uniform_choice(uniform(seed, "limit", i), MONTHLY_LIMITS).cast("bigint").alias("monthly_txn_limit"),
    )


def cards(spark: SparkSession, n: int = N_CARDS, n_customers: int = N_CUSTOMERS, seed: int = 42,
          partitions: int | None = None) -> DataFrame:
    i = F.col("id")
    issue = random_date(uniform(seed, "issue", i), "2018-01-01", "2024-06-01")
    expiry = F.date_add(issue, (uniform_int(uniform(seed, "years", i), 2, 5) * 365).cast("int"))
    return spark.range(1, n + 1, numPartitions=partitions).select(
        F.format_string("CARD_%07d", i).alias("card_id"),
        F.format_string("CUST_%06d", uniform_int(uniform(seed, "owner", i), 1, n_customers)).alias("customer_id"),
        uniform_choice(uniform(seed, "ctype", i), CARD_TYPES).alias("card_type"),
        uniform_int(uniform(seed, "last4", i), 1000, 9999).cast("string").alias("card_last4"),
        issue.alias("issue_date"),
        expiry.alias("expiry_date"),
        (expiry < F.lit("2024-12-31").cast("date")).alias("is_expired"),
        (uniform(seed, "blocked", i) < BLOCKED_SHARE).alias("is_blocked"),
    )


def transactions(
    spark: SparkSession, cards_df: DataFrame, customers_df: DataFrame, merchants_df: DataFrame,
    n: int = N_TRANSACTIONS, n_cards: int = N_CARDS, n_merchants: int = N_MERCHANTS, seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    i = F.col("id")
    fraud = uniform(seed, "fraud", i) < FRAUD_RATE
    # Box–Muller: standard normal from two independent uniforms
    u1 = F.greatest(uniform(seed, "amt1", i), F.lit(1e-300))
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * uniform(seed, "amt2", i))
    base = F.round(F.exp(F.lit(AMOUNT_LOG_MEAN) + F.lit(AMOUNT_LOG_SIGMA) * z), 2)
    lo, hi = FRAUD_AMOUNT_FACTOR
    scaled = F.when(fraud, base * (F.lit(lo) + F.lit(hi - lo) * uniform(seed, "famt", i))).otherwise(base)
    amount = F.least(F.greatest(scaled, F.lit(AMOUNT_CLIP[0])), F.lit(AMOUNT_CLIP[1]))
    span = F.unix_timestamp(F.lit(END_TS)) - F.unix_timestamp(F.lit(START_TS))
    ts = F.timestamp_seconds(F.unix_timestamp(F.lit(START_TS)) + F.floor(uniform(seed, "ts", i) * span))

    base_rows = spark.range(1, n + 1, numPartitions=partitions).select(
        F.format_string("TXN_%08d", i).alias("transaction_id"),
        F.format_string("CARD_%07d", uniform_int(uniform(seed, "card", i), 1, n_cards)).alias("card_id"),
        F.format_string("MERCH_%05d", uniform_int(uniform(seed, "merchant", i), 1, n_merchants)).alias("merchant_id"),
        amount.alias("amount"),
        ts.alias("ts"),
        fraud.alias("is_fraudulent"),
        F.when(fraud, uniform_choice(uniform(seed, "ftype", i), FRAUD_TYPES)).alias("fraud_type"),
        weighted_choice(uniform(seed, "status", i), STATUSES).alias("status"),
    )
    owner = cards_df.select("card_id", F.col("customer_id").alias("card_customer"))
    cust_country = customers_df.select(F.col("customer_id").alias("card_customer"), F.col("country").alias("c_country"))
    merch_country = merchants_df.select("merchant_id", F.col("country").alias("m_country"))
    joined = lookup_join(base_rows, owner, "card_id")
    joined = lookup_join(joined, cust_country, "card_customer")
    joined = lookup_join(joined, merch_country, "merchant_id")
    c_country = F.coalesce("c_country", F.lit("CA"))
    m_country = F.coalesce("m_country", F.lit("CA"))
    currency = F.coalesce(F.create_map(*[F.lit(x) for kv in CURRENCIES.items() for x in kv])[c_country], F.lit("USD"))
    return joined.select(
        "transaction_id", "card_id",
        F.coalesce("card_customer", F.lit("UNKNOWN")).alias("customer_id"),
        "merchant_id", "amount",
        currency.alias("currency"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        F.hour("ts").cast("bigint").alias("hour_of_day"),
        F.date_format("ts", "EEEE").alias("day_of_week"),
        "is_fraudulent", "fraud_type",
        (c_country != m_country).alias("is_cross_border"),
        "status",
    )


def generate(
    spark: SparkSession, n_transactions: int = N_TRANSACTIONS, n_customers: int = N_CUSTOMERS,
    n_merchants: int = N_MERCHANTS, n_cards: int = N_CARDS, seed: int = 42, partitions: int | None = None,
) -> RawSources:
    cu = customers(spark, n_customers, seed)
    me = merchants(spark, n_merchants, seed)
    ca = cards(spark, n_cards, n_customers, seed)
    tx = transactions(spark, ca, cu, me, n_transactions, n_cards, n_merchants, seed, partitions)
    return RawSources({"transactions": tx, "customers": cu, "merchants": me, "cards": ca})


def write_raw(raw: RawSources, out_dir: str, fmt: str = "csv") -> dict[str, str]:
    """S10/S11: one folder per table (header in every CSV part file)."""
    paths = {}
    for name, df in raw.items():
        path = f"{out_dir}/{name}.{fmt}" if fmt == "csv" else f"{out_dir}/{name}"
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
        paths[name] = path
    return paths
