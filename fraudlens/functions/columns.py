"""Column expressions used by every layer (casts, cleaning, ratios, buckets).

All helpers return built-in Catalyst expressions, so they stay inside
whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's) -----------------------------
# Monetary type of staged amounts and of sums of them.
AMOUNT_TYPE = "decimal(18,9)"
SUM_TYPE = "decimal(28,9)"
# Statuses, tiers and categories as written by the reference.
STATUSES = ["COMPLETED", "DECLINED", "REVERSED"]
RISK_TIERS = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
HIGH_RISK_TIERS = ["HIGH", "VERY_HIGH"]
MERCHANT_CATEGORIES = [
    "GROCERY", "TRAVEL", "RESTAURANT", "ENTERTAINMENT", "RETAIL", "FUEL",
    "HEALTHCARE", "UTILITIES", "ONLINE_GAMING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER",
]
HIGH_RISK_CATEGORIES = ["ONLINE_GAMING", "CRYPTO_EXCHANGE", "MONEY_TRANSFER"]
CARD_TYPES = ["VISA_CREDIT", "VISA_DEBIT", "MASTERCARD_CREDIT", "MASTERCARD_DEBIT", "AMEX_CREDIT"]
FRAUD_TYPES = ["card_not_present", "velocity_abuse", "account_takeover", "stolen_card", "synthetic_identity"]
FRAUD_SEGMENTS = ["HIGH_FRAUD", "ELEVATED_FRAUD", "NORMAL"]
MERCHANT_TIERS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
# Amount buckets: upper bounds (exclusive) and labels; the labels hold U+2013.
AMOUNT_BUCKETS = [
    (50, "micro (<$50)"),
    (200, "small ($50–$200)"),
    (1000, "medium ($200–$1k)"),
    (5000, "large ($1k–$5k)"),
]
AMOUNT_BUCKET_TOP = "very_large (>$5k)"
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
UNUSUAL_HOURS = (0, 5)            # inclusive, 00:00-05:59
WINDOW_30D, WINDOW_7D = 30, 7     # trailing windows, inclusive of both ends
HIGH_FRAUD_RATE, ELEVATED_FRAUD_RATE = 0.10, 0.03
P95 = 0.95
LOOKBACK_DAYS = 3                 # late-data lookback of the incremental fact
MAX_FRAUD_RATE = 0.05             # business assertion on completed rows
FRESHNESS_WARN_H, FRESHNESS_ERROR_H = 24, 48
AMOUNT_RANGE = (0, 50000)
SCORE_RANGE = (0, 5)
# the Unicode White_Space characters: controls, blanks, no-break and wide spaces, separators
WHITESPACE = (" \t\n\u000b\f\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
              "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs too), not only blanks."""
    return F.trim(col(c), F.lit(WHITESPACE))


def clean_upper(c: str | Column) -> Column:
    return F.upper(trim_ws(c))


def clean_lower(c: str | Column) -> Column:
    return F.lower(trim_ws(c))


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))


def to_amount(c: str | Column) -> Column:
    """NULL where the amount does not fit: the row stays and fails the not_null check instead of ending the build."""
    return col(c).try_cast(AMOUNT_TYPE)


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """NULL instead of an error/inf when the denominator is 0 or NULL."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def count_if(pred: Column) -> Column:
    """Rows where ``pred`` is TRUE; NULL predicates do not count; 0 not NULL."""
    return F.count_if(pred)


def sum_if(pred: Column, value: str | Column, value_type: str = AMOUNT_TYPE) -> Column:
    """``sum(case when pred then value else 0 end)`` with a typed zero.

    The typed zero keeps the sum at ``decimal(28,9)``; a bare integer 0 would
    widen it.
    """
    return F.sum(F.when(pred, col(value)).otherwise(F.lit(0).cast(value_type)))


def round_money(c: str | Column, scale: int = 2) -> Column:
    """Half-up rounding on the decimal value (never on a double)."""
    return F.round(col(c), scale)


def round_rate(c: str | Column, scale: int = 4) -> Column:
    """Round a double ratio half-up through a 9-digit decimal, return double."""
    return F.round(col(c).cast("decimal(18,9)"), scale).cast("double")


def as_date(value: _dt.date | str | Column | None) -> Column:
    """``as_of`` parameter as a date column; ``None`` means today."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def as_timestamp(value: _dt.datetime | _dt.date | str | Column | None) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def amount_bucket(c: str | Column) -> Column:
    """Dashboard bucket; exactly 5000 and NULL land in the top bucket."""
    amount = col(c)
    expr = None
    for bound, label in AMOUNT_BUCKETS:
        expr = F.when(amount < bound, label) if expr is None else expr.when(amount < bound, label)
    return expr.otherwise(AMOUNT_BUCKET_TOP)


def is_unusual_hour(c: str | Column) -> Column:
    lo, hi = UNUSUAL_HOURS
    return col(c).between(lo, hi)


def flag_as_int(c: Column) -> Column:
    return c.cast("bigint")


def initcap_word(c: str | Column) -> Column:
    """``initcap`` of the trimmed word; names of days are looked up, as ``initcap`` searches each string for word breaks."""
    low = F.lower(trim_ws(c))
    expr = F
    for name in DAY_NAMES:
        expr = expr.when(low == F.lit(name.lower()), F.lit(name))
    return expr.otherwise(F.initcap(low))
