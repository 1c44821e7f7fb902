"""Registered operator-level queries: joins, percentile, quality, reports, incremental."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import columns as C
from fraudlens.operators import intermediate as I
from fraudlens.operators import marts as M
from fraudlens.operators import monthly as MM
from fraudlens.operators import quality as Q
from fraudlens.operators import reports as R
from fraudlens.plans import incremental as INC
from fraudlens.plans import runs
from fraudlens.plans.models import FraudModels
from fraudlens.plans.oracle import cif, q, rrate, sdiv
from fraudlens.plans.registry import AS_OF, models, register
from fraudlens.session import materialize, scratch_path, staged
from fraudlens.sources.readers import RawSources, file_sizes

FUTURE_AT = f"{AS_OF} 12:00:00"
FRESHNESS_AT = "2001-08-03 12:00:00"

# --------------------------------------------------------------------- W1 / J5
@register("w1_p95_thresholds", q(f"SELECT {rrate('p95_fraud_rate', 9)} AS p95_fraud_rate, "
                                 f"{rrate('p95_velocity', 9)} AS p95_velocity FROM p95"))
def w1_p95_thresholds(spark, sf_dir):
    agg = materialize(I.merchant_agg(models(spark, sf_dir).stg_transactions))
    return I.merchant_p95(agg).select(
        C.round_rate("p95_fraud_rate", 9).alias("p95_fraud_rate"),
        C.round_rate("p95_velocity", 9).alias("p95_velocity"),
    )


@register("j5_dangling_card_fk", q(
    "SELECT t.transaction_id, t.card_id FROM stg_transactions t WHERE t.card_id IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM stg_cards c WHERE c.card_id = t.card_id)"))
def j5_dangling_card_fk(spark, sf_dir):
    m = models(spark, sf_dir)
    return Q.relationships(m.stg_transactions, "card_id", m.stg_cards, "card_id").select("transaction_id", "card_id")


# --------------------------------------------------------------------- quality
_CTE = {
    "fct_transactions": "fct", "fct_fraud_summary": "fraud_summary",
}


def _tables(m, models_read):
    """Inputs of the checks; what several checks read is staged once, so that each check reads its columns."""
    if "transactions" in m.raw and len([t for t in models_read if t not in ("raw_customers", "raw_merchants", "raw_cards")]) > 1:
        m = FraudModels(RawSources({**dict(m.raw.items()), "transactions": staged(m.raw["transactions"], "raw")}),
                        as_of=AS_OF, audit=False)
    fct = m.fct_transactions
    if {"fct_transactions", "fct_fraud_summary"} & set(models_read):
        fct = staged(fct, "fct")
    made = {
        "dim_customers": lambda: m.dim_customers, "dim_merchants": lambda: materialize(m.dim_merchants),
        "fct_transactions": lambda: fct, "fct_fraud_summary": lambda: staged(M.fct_fraud_summary(fct, audit=False), "summary"),
    }
    return {t: made[t]() for t in made if t in models_read} | {
        "raw_transactions": m.raw["transactions"], "raw_customers": m.raw["customers"],
        "raw_merchants": m.raw["merchants"], "raw_cards": m.raw["cards"],
        "stg_transactions": m.stg_transactions, "stg_customers": m.stg_customers,
        "stg_merchants": m.stg_merchants, "stg_cards": m.stg_cards,
    }


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)


def _check_sql(c: Q.Check) -> str:
    t = _CTE.get(c.model, c.model)
    head = (f"SELECT {_lit(c.check_id)} AS check_id, {_lit(c.model)} AS model, "
            f"{_lit(c.column)} AS column_name, {_lit(c.test)} AS test, ")
    col = c.column
    if c.test == "not_null":
        n = f"(SELECT {cif(f'{col} IS NULL')} FROM {t})"
    elif c.test == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.values)
        n = f"(SELECT {cif(f'{col} IS NOT NULL AND {col} NOT IN ({vals})')} FROM {t})"
    elif c.test == "accepted_range":
        n = f"(SELECT {cif(f'NOT ({col} >= {c.lo} AND {col} <= {c.hi})')} FROM {t})"
    elif c.test == "unique":
        n = (f"(SELECT count(*) FROM (SELECT {col} FROM {t} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1))")
    else:
        p = _CTE.get(c.parent, c.parent)
        n = (f"(SELECT count(*) FROM {t} ch WHERE ch.{col} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {p} pa WHERE pa.{c.parent_column} = ch.{col}))")
    return (head + f"CAST({n} AS BIGINT) AS failures, "
            f"CASE WHEN {n} = 0 THEN 'pass' ELSE 'fail' END AS status")


def _checks_sql(checks) -> str:
    return q("\nUNION ALL\n".join(_check_sql(c) for c in checks))


def _register_checks(name: str, checks) -> None:
    def fn(spark, sf_dir):
        read = {t for c in checks for t in (c.model, c.parent) if t}
        return Q.run_checks(_tables(models(spark, sf_dir), read), checks)
    fn.__name__ = name
    register(name, _checks_sql(checks))(fn)


_register_checks("q0_all_schema_checks", Q.DECLARED_CHECKS)
_register_checks("q1_unique", Q.checks_of("unique"))
_register_checks("q2_not_null", Q.checks_of("not_null"))
_register_checks("q3_accepted_values", Q.checks_of("accepted_values"))
_register_checks("q4_relationships", Q.checks_of("relationships"))
_register_checks("q5_accepted_range", Q.checks_of("accepted_range"))


@register("q6_fraud_rate_threshold", q(
    f"SELECT * FROM (SELECT {sdiv(cif('is_fraudulent = true'), 'count(*)')} AS overall_fraud_rate, "
    f"'{Q.FRAUD_RATE_REASON}' AS failure_reason "
    "FROM fct WHERE status = 'COMPLETED') WHERE overall_fraud_rate > 0.05"))
def q6_fraud_rate_threshold(spark, sf_dir):
    return Q.fraud_rate_above(models(spark, sf_dir).fct_transactions)


@register("q7_future_transactions", q(
    f"SELECT transaction_id, transaction_ts, '{Q.FUTURE_REASON}' AS failure_reason "
    f"FROM fct WHERE transaction_ts > TIMESTAMP '{FUTURE_AT}'"))
def q7_future_transactions(spark, sf_dir):
    return Q.future_transactions(models(spark, sf_dir).fct_transactions, FUTURE_AT)


_FRESH_H = f"(date_diff('second', max(CAST(transaction_ts AS TIMESTAMP)), TIMESTAMP '{FRESHNESS_AT}') / 3600.0)"


@register("q8_source_freshness", q(
    f"SELECT 'transactions' AS source_table, max(CAST(transaction_ts AS TIMESTAMP)) AS max_loaded_at, "
    f"TIMESTAMP '{FRESHNESS_AT}' AS checked_at, {rrate(_FRESH_H, 3)} AS hours_since_load, "
    f"CASE WHEN {_FRESH_H} IS NULL OR {_FRESH_H} > 48 THEN 'error' WHEN {_FRESH_H} > 24 THEN 'warn' ELSE 'pass' END AS freshness_status "
    "FROM raw_transactions"))
def q8_source_freshness(spark, sf_dir):
    raw = models(spark, sf_dir).raw["transactions"]
    return Q.freshness(raw, "transactions", "transaction_ts", FRESHNESS_AT)


def _singular_sql() -> str:
    def row(test, model, column, n, status):
        return (f"SELECT '{test}:{model}.{column}' AS check_id, '{model}' AS model, '{column}' AS column_name, "
                f"'{test}' AS test, CAST({n} AS BIGINT) AS failures, {status} AS status")

    rate = f"(SELECT {sdiv(cif('is_fraudulent = true'), 'count(*)')} FROM fct WHERE status = 'COMPLETED')"
    high = f"coalesce(CAST({rate} > 0.05 AS INTEGER), 0)"
    ahead = f"(SELECT count(*) FROM fct WHERE transaction_ts > TIMESTAMP '{FRESHNESS_AT}')"
    hours = f"(SELECT {_FRESH_H} FROM raw_transactions)"
    stale = f"CAST({hours} IS NULL OR {hours} > 48 AS INTEGER)"
    return "\nUNION ALL\n".join([
        row("fraud_rate", "fct_transactions", "is_fraudulent", high, f"if({high} = 0, 'pass', 'fail')"),
        row("future_transactions", "fct_transactions", "transaction_ts", ahead, f"if({ahead} = 0, 'pass', 'fail')"),
        row("freshness", "raw_transactions", "transaction_ts", stale,
            f"CASE WHEN {stale} = 1 THEN 'fail' WHEN {hours} > 24 THEN 'warn' ELSE 'pass' END")])


@register("q9_all_checks", q("\nUNION ALL\n".join([*map(_check_sql, Q.DECLARED_CHECKS), _singular_sql()])))
def q9_all_checks(spark, sf_dir):
    read = {t for c in Q.DECLARED_CHECKS for t in (c.model, c.parent) if t}
    return Q.run_all_checks(_tables(models(spark, sf_dir), read), FRESHNESS_AT)


# --------------------------------------------------------------------- reports
_DAILY = """
spine AS (
  SELECT CAST(unnest(generate_series(min(transaction_date), max(transaction_date), INTERVAL 1 DAY)) AS DATE)
         AS transaction_date FROM fraud_summary
),
daily AS (
  SELECT transaction_date, sum(total_transactions) AS total_transactions, sum(fraud_count) AS fraud_count,
         sum(total_volume) AS total_volume, sum(fraud_volume) AS fraud_volume
  FROM fraud_summary GROUP BY transaction_date
),
daily_totals AS (
  SELECT s.transaction_date,
         CAST(coalesce(d.total_transactions, 0) AS BIGINT) AS total_transactions,
         CAST(coalesce(d.fraud_count, 0) AS BIGINT) AS fraud_count,
         CAST(coalesce(d.total_volume, 0) AS DECIMAL(38,9)) AS total_volume,
         CAST(coalesce(d.fraud_volume, 0) AS DECIMAL(38,9)) AS fraud_volume
  FROM spine s LEFT JOIN daily d ON s.transaction_date = d.transaction_date
)"""


@register("r7_date_spine", q("SELECT * FROM daily_totals", _DAILY))
def r7_date_spine(spark, sf_dir):
    return R.daily_totals(models(spark, sf_dir).fct_fraud_summary)


@register("r1_daily_fraud_trend", q(f"""
SELECT transaction_date, total_transactions, fraud_count,
       {rrate('rate', 6)} AS fraud_rate, {rrate('prior_avg', 6)} AS prior_7d_avg_rate,
       {rrate('prior_std', 6)} AS prior_7d_std_rate,
       coalesce(rate > prior_avg + 3.0 * prior_std, false) AS is_spike
FROM (
  SELECT *, avg(rate) OVER w AS prior_avg, stddev_samp(rate) OVER w AS prior_std
  FROM (SELECT *, {sdiv('fraud_count', 'total_transactions')} AS rate FROM daily_totals)
  WINDOW w AS (ORDER BY transaction_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)""", _DAILY))
def r1_daily_fraud_trend(spark, sf_dir):
    return R.daily_fraud_trend(models(spark, sf_dir).fct_fraud_summary)


@register("r2_category_fraud_volume", q(f"""
SELECT merchant_category, fraud_volume, fraud_count, total_volume, total_transactions,
       {sdiv('fraud_count', 'total_transactions')} AS fraud_rate,
       rank() OVER (ORDER BY fraud_volume DESC) AS volume_rank
FROM (
  SELECT merchant_category, CAST(sum(fraud_volume) AS DECIMAL(38,9)) AS fraud_volume,
         CAST(sum(fraud_count) AS BIGINT) AS fraud_count, CAST(sum(total_volume) AS DECIMAL(38,9)) AS total_volume,
         CAST(sum(total_transactions) AS BIGINT) AS total_transactions
  FROM fraud_summary GROUP BY merchant_category
)"""))
def r2_category_fraud_volume(spark, sf_dir):
    return R.category_fraud_volume(models(spark, sf_dir).fct_fraud_summary)


@register("r3_elevated_fraud_by_band_country", q(f"""
SELECT age_band, country, count(*) AS flagged_customers,
       {cif("fraud_segment = 'HIGH_FRAUD'")} AS high_fraud_customers,
       {cif("fraud_segment = 'ELEVATED_FRAUD'")} AS elevated_fraud_customers,
       CAST(sum(fraud_txn_count) AS BIGINT) AS fraud_txn_count,
       CAST(sum(lifetime_txn_count) AS BIGINT) AS lifetime_txn_count,
       {sdiv('sum(fraud_txn_count)', 'sum(lifetime_txn_count)')} AS fraud_rate
FROM dim_customers WHERE fraud_segment <> 'NORMAL' GROUP BY age_band, country"""))
def r3_elevated_fraud_by_band_country(spark, sf_dir):
    return R.elevated_fraud_by_band_country(models(spark, sf_dir).dim_customers)


@register("r4_cross_border_fraud_share", q(f"""
SELECT fraud_count, cross_border_fraud_count,
       {sdiv('cross_border_fraud_count', 'fraud_count')} AS cross_border_share,
       fraud_volume, cross_border_fraud_volume,
       {sdiv('cross_border_fraud_volume', 'fraud_volume')} AS cross_border_volume_share
FROM (
  SELECT CAST(sum(fraud_count) AS BIGINT) AS fraud_count,
         CAST(sum(CASE WHEN is_cross_border = true THEN fraud_count ELSE 0 END) AS BIGINT) AS cross_border_fraud_count,
         CAST(sum(fraud_volume) AS DECIMAL(38,9)) AS fraud_volume,
         CAST(sum(CASE WHEN is_cross_border = true THEN fraud_volume ELSE CAST(0 AS DECIMAL(28,9)) END)
              AS DECIMAL(38,9)) AS cross_border_fraud_volume
  FROM fraud_summary
)"""))
def r4_cross_border_fraud_share(spark, sf_dir):
    return R.cross_border_fraud_share(models(spark, sf_dir).fct_fraud_summary)


@register("r5_high_risk_merchants", q(
    "SELECT merchant_id, merchant_name, category_code, country, total_txn_count, fraud_txn_count, fraud_rate, "
    "merchant_risk_tier FROM dim_merchants WHERE high_fraud_rate_flag = true"))
def r5_high_risk_merchants(spark, sf_dir):
    return R.high_risk_merchants(models(spark, sf_dir).dim_merchants)


@register("r6_fraud_by_hour", q(f"""
SELECT hour_of_day, fraud_count, total_transactions, {sdiv('fraud_count', 'total_transactions')} AS fraud_rate,
       rank() OVER (ORDER BY fraud_count DESC) AS fraud_rank
FROM (SELECT hour_of_day, {cif('is_fraudulent = true')} AS fraud_count, count(*) AS total_transactions
      FROM fct WHERE status = 'COMPLETED' GROUP BY hour_of_day)"""))
def r6_fraud_by_hour(spark, sf_dir):
    return R.fraud_by_hour(models(spark, sf_dir).fct_transactions)


# --------------------------------------------------------------------- incremental
_STALE = f"""
stale AS (
  SELECT * REPLACE (CASE WHEN transaction_date >= DATE '{AS_OF}' - 3 THEN 'PENDING' ELSE status END AS status)
  FROM fct WHERE transaction_date < DATE '{AS_OF}' - 1
),
batch AS (SELECT * FROM fct WHERE transaction_date >= DATE '{AS_OF}' - 3)"""


def _stale_snapshot(fct):
    """Yesterday's table: the last day missing, the lookback days still PENDING."""
    day = F.col("transaction_date")
    return fct.where(day < F.date_sub(F.lit(AS_OF).cast("date"), 1)).withColumn(
        "status", F.when(day >= F.date_sub(F.lit(AS_OF).cast("date"), C.LOOKBACK_DAYS), F.lit("PENDING"))
        .otherwise(F.col("status")))


@register("i2_lookback_batch", q(f"SELECT * FROM fct WHERE transaction_date >= DATE '{AS_OF}' - 3"))
def i2_lookback_batch(spark, sf_dir):
    return INC.lookback_batch(models(spark, sf_dir).fct_transactions, AS_OF)


@register("u1_merge_upsert", q(
    "SELECT * FROM stale WHERE transaction_id NOT IN (SELECT transaction_id FROM batch) "
    "UNION ALL SELECT * FROM batch", _STALE))
def u1_merge_upsert(spark, sf_dir):
    fct = models(spark, sf_dir).fct_transactions
    return INC.merge_by_key(_stale_snapshot(fct), INC.lookback_batch(fct, AS_OF), "transaction_id")


_TWICE = _STALE + f""",
second AS (
  SELECT * REPLACE (DATE '{AS_OF}' - 5 AS transaction_date, 'REVERSED' AS status)
  FROM fct WHERE transaction_date BETWEEN DATE '{AS_OF}' - 12 AND DATE '{AS_OF}' - 10
  UNION ALL
  SELECT * REPLACE (transaction_id || '-new' AS transaction_id) FROM fct WHERE transaction_date = DATE '{AS_OF}' - 20
),
merged AS (
  SELECT * FROM stale WHERE transaction_id NOT IN (SELECT transaction_id FROM batch) UNION ALL SELECT * FROM batch)"""


@register("i3_upsert_twice", q(
    "SELECT * FROM merged WHERE transaction_id NOT IN (SELECT transaction_id FROM second) "
    "UNION ALL SELECT * FROM second", _TWICE))
def i3_upsert_twice(spark, sf_dir):
    """Yesterday's table, then the lookback batch, then rows that moved to another day, changed or are new."""
    m = models(spark, sf_dir)
    path = scratch_path(spark, f"upsert-{uuid.uuid4().hex}")
    day, as_of = F.col("transaction_date"), F.lit(AS_OF).cast("date")
    # the table is written as it is derived; only the days of the later batches are staged
    INC.upsert(spark, _stale_snapshot(m.fct_by_day()), path, by_day=True)
    fct = staged(m.fct_transactions.where(day >= F.date_sub(as_of, 20)), "recent")
    moved = fct.where(day.between(F.date_sub(as_of, 12), F.date_sub(as_of, 10))).withColumns(
        {"transaction_date": F.date_sub(as_of, 5), "status": F.lit("REVERSED")})
    new = fct.where(day == F.date_sub(as_of, 20)).withColumn("transaction_id", F.concat("transaction_id", F.lit("-new")))
    for batch in (INC.lookback_batch(fct, AS_OF), moved.unionByName(new)):
        INC.upsert(spark, batch, path)
    return INC.read_table(spark, path).select(*M.FACT_COLUMNS)


def _first_runs(spark, sf_dir):
    """The daily run on an empty folder, and once more."""
    base = scratch_path(spark, f"daily-{uuid.uuid4().hex}")
    runs.land_raw(spark, sf_dir, f"{base}/raw")
    for _ in range(2):
        runs.incremental_run(spark, f"{base}/raw", f"{base}/marts", as_of=AS_OF)
    return f"{base}/marts"


@register("i1_first_then_incremental", q("SELECT * FROM fct"))
def i1_first_then_incremental(spark, sf_dir):
    return INC.read_table(spark, f"{_first_runs(spark, sf_dir)}/{runs.FACT}").select(*M.FACT_COLUMNS)


@register("i7_daily_run_dimensions", q("SELECT * FROM dim_merchants"))
def i7_daily_run_dimensions(spark, sf_dir):
    written = spark.read.parquet(f"{_first_runs(spark, sf_dir)}/{runs.DIM_MERCHANTS}")
    return written.drop(*[c for c in written.columns if c.startswith("_")])


@register("u2_relation_diff", q(
    "SELECT (SELECT count(*) FROM (SELECT * FROM stale EXCEPT ALL SELECT * FROM fct)) AS rows_only_in_left, "
    "(SELECT count(*) FROM (SELECT * FROM fct EXCEPT ALL SELECT * FROM stale)) AS rows_only_in_right", _STALE))
def u2_relation_diff(spark, sf_dir):
    fct = staged(models(spark, sf_dir).fct_transactions, "fct")
    return INC.relation_diff(_stale_snapshot(fct), fct, by="transaction_date")


_VALUES = [c for c in M.FACT_COLUMNS if c != "transaction_id"]
_BOTH = "FROM stale a JOIN fct b USING (transaction_id)"
_CHANGED = "(SELECT count(*) " + _BOTH + " WHERE {})"


@register("u2_compare_by_key", q("\nUNION ALL\n".join([
    f"SELECT '{kind}' AS kind, CAST(NULL AS VARCHAR) AS column_name, CAST({n} AS BIGINT) AS rows" for kind, n in (
        ("only_left", "(SELECT count(*) FROM stale WHERE transaction_id NOT IN (SELECT transaction_id FROM fct))"),
        ("only_right", "(SELECT count(*) FROM fct WHERE transaction_id NOT IN (SELECT transaction_id FROM stale))"),
        ("repeated_left", "(SELECT count(*) FROM (SELECT 1 FROM stale GROUP BY transaction_id HAVING count(*) > 1))"),
        ("repeated_right", "(SELECT count(*) FROM (SELECT 1 FROM fct GROUP BY transaction_id HAVING count(*) > 1))"),
        ("changed", _CHANGED.format(" OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _VALUES))))] + [
    f"SELECT 'changed' AS kind, '{c}' AS column_name, " + _CHANGED.format(f"a.{c} IS DISTINCT FROM b.{c}") + " AS rows" for c in _VALUES]), _STALE))
def u2_compare_by_key(spark, sf_dir):
    """Yesterday's table against today's: missing days by key, and the column that the lookback corrects."""
    fct = staged(models(spark, sf_dir).fct_transactions, "fct")
    return INC.compare_tables(_stale_snapshot(fct), fct, "transaction_id", by="transaction_date", every_row=True)


@register("i8_key_index_moves", q("SELECT * FROM fct"))
def i8_key_index_moves(spark, sf_dir):
    """Rows of ten days move to one day and back: the last batch finds them through stale and live entries of the key index."""
    path = scratch_path(spark, f"moves-{uuid.uuid4().hex}")
    day, as_of = F.col("transaction_date"), F.lit(AS_OF).cast("date")
    # the table is written as it is derived, and the rows to move are staged from its days
    INC.upsert(spark, models(spark, sf_dir).fct_by_day(), path, by_day=True)
    some = staged(INC.read_table(spark, path).where(day.between(F.date_sub(as_of, 40), F.date_sub(as_of, 30))), "some")
    for batch in (some.withColumn("transaction_date", F.date_sub(as_of, 60)), some.withColumn("transaction_date", F.date_sub(as_of, 61)), some):
        INC.upsert(spark, batch, path)
    return INC.read_table(spark, path).select(*M.FACT_COLUMNS)


@register("a9_profile_from_months", q("SELECT * FROM profile"))
def a9_profile_from_months(spark, sf_dir):
    """M6 from mergeable months: sums of partial aggregates, distinct counts over links, the last 31 days for the windows."""
    m = models(spark, sf_dir)
    stg = materialize(m.stg_transactions)
    ref = I.latest_txn_date(stg)
    totals = MM.customer_totals(MM.customer_month(stg), MM.links_month(stg), stg, ref)
    return I.int_customer_spend_profile(stg, m.stg_customers, totals, ref)


def _three_increments(spark, sf_dir):
    """Three daily runs over a landing folder that grows, in which the second run finds a corrected month."""
    m, base = models(spark, sf_dir), scratch_path(spark, f"months-{uuid.uuid4().hex}")
    raw, day = materialize(m.raw["transactions"]), F.col("transaction_date")
    for name in ("customers", "merchants", "cards"):
        m.raw[name].write.parquet(f"{base}/raw/{name}")
    wrong = F.when(F.substring(day, 1, 7) == "1995-03", F.lit("DECLINED")).otherwise(F.col("status"))
    steps = (raw.where(day < "1997").withColumn("status", wrong),
             raw.where(((day >= "1997") & (day < "2000")) | (F.substring(day, 1, 7) == "1995-03")), raw.where((day >= "2000") | day.isNull()))
    for step in steps:
        (step.hint("rebalance", "transaction_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("transaction_date").parquet(f"{base}/raw/transactions"))
        sources = RawSources.from_dir(spark, f"{base}/raw", fmt="parquet")
        runs.write_dimensions(spark, FraudModels(sources, as_of=AS_OF, audit=False), f"{base}/raw", f"{base}/marts", "parquet")
    return f"{base}/marts"


@register("i9_state_after_increments", q("SELECT * FROM dim_customers"))
def i9_state_after_increments(spark, sf_dir):
    return spark.read.parquet(f"{_three_increments(spark, sf_dir)}/{runs.DIM_CUSTOMERS}")


# --------------------------------------------------------------------- S12
_INPUTS = ("lineitem", "orders", "customer", "supplier", "nation")


# every shared table is one file at the oracle's scale; sizes are tested against the file system
@register("s12_input_files", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source_table, CAST(1 AS BIGINT) AS files, count(*) AS rows FROM {t}" for t in _INPUTS))
def s12_input_files(spark, sf_dir):
    parts = [file_sizes(spark, f"{sf_dir}/{t}.parquet").select(F.lit(t).alias("source_table"), "rows") for t in _INPUTS]
    return reduce(DataFrame.unionByName, parts).groupBy("source_table").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
