"""Scalar column helpers (casts, cleaning, ratios, buckets)."""

from fraudlens.functions.columns import *  # noqa: F401,F403
from fraudlens.functions.columns import (  # noqa: F401
    amount_bucket,
    as_date,
    as_timestamp,
    blank_to_null,
    clean_lower,
    clean_upper,
    count_if,
    initcap_word,
    is_unusual_hour,
    round_money,
    round_rate,
    safe_divide,
    sum_if,
    to_amount,
    trim_ws,
)
