from decimal import Decimal

from pyspark.sql import functions as F

from fraudlens.functions import columns as C


def test_amount_buckets_bounds(spark):
    vals = ["49.99", "50", "199.99", "200", "999.99", "1000", "4999.99", "5000", None]
    df = spark.createDataFrame([(None if v is None else Decimal(v),) for v in vals], "a decimal(18,9)")
    got = [r[0] for r in df.select(C.amount_bucket("a")).collect()]
    assert got == [
        "micro (<$50)", "small ($50–$200)", "small ($50–$200)", "medium ($200–$1k)",
        "medium ($200–$1k)", "large ($1k–$5k)", "large ($1k–$5k)", "very_large (>$5k)", "very_large (>$5k)",
    ]
    assert "–" in got[1]  # en dash, byte for byte


def test_unusual_hours_inclusive(spark):
    df = spark.createDataFrame([(0,), (5,), (6,), (23,)], "h long")
    assert [r[0] for r in df.select(C.is_unusual_hour("h")).collect()] == [True, True, False, False]


def test_trim_strips_tabs_and_newlines(spark):
    df = spark.createDataFrame([("\t x y \n",), ("   ",), (None,), (" MiXeD ",)], "s string")
    got = [tuple(r) for r in df.select(C.trim_ws("s"), C.clean_upper("s"), C.clean_lower("s")).collect()]
    assert got == [("x y", "X Y", "x y"), ("", "", ""), (None, None, None), ("MiXeD", "MIXED", "mixed")]


def test_safe_divide_and_rounding(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2), (1, 8)], "a long, b long")
    got = [tuple(r) for r in df.select(C.safe_divide("a", "b"), C.round_rate(C.safe_divide("a", "b"), 2)).collect()]
    assert got[0][0] == 1 / 3 and got[0][1] == 0.33
    assert got[1] == (None, None) and got[2] == (None, None)
    assert got[3][1] == 0.13  # 0.125 rounds half up


def test_sum_if_keeps_decimal_28_9(spark):
    df = spark.createDataFrame([(True, Decimal("1.5")), (False, Decimal("2"))], "p boolean, a decimal(18,9)")
    out = df.agg(C.sum_if(F.col("p"), "a").alias("s"))
    assert out.schema["s"].dataType.simpleString() == "decimal(28,9)"
    assert out.first()[0] == Decimal("1.500000000")


def test_amounts_out_of_range_become_null_and_wide_spaces_are_trimmed(spark):
    df = spark.createDataFrame([(1e9, "\u3000 a\u00a0b \u00a0\t"), (12.3456, "x"), (-0.005, None)], "d double, s string")
    got = df.select(C.to_amount("d").alias("a"), C.trim_ws("s").alias("s")).collect()
    assert [r.a if r.a is None else float(r.a) for r in got] == [None, 12.3456, -0.005]
    assert [r.s for r in got] == ["a\u00a0b", "x", None]


def test_initcap_word_looks_up_days_and_treats_other_words_alike(spark):
    words = ["monday", " FRIDAY\u00a0", "sunDAY", "new york", "o'neil", "\u01c6ep", "mondays", "", "\t", None]
    df = spark.createDataFrame([(w,) for w in words], "w string").select(
        C.initcap_word("w").alias("got"), F.initcap(F.lower(C.trim_ws("w"))).alias("want"))
    assert [r.got for r in df.collect()] == [r.want for r in df.collect()]
    plan = spark.range(1).select(C.initcap_word(F.col("id").cast("string")).alias("d"))._jdf.queryExecution().analyzed().toString()
    assert all(f"THEN {d}" in plan for d in C.DAY_NAMES)
