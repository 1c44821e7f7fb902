"""Upsert properties on temporary Parquet tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import card, customer, merchant, raw_sources, txn

from fraudlens.plans import incremental as INC
from fraudlens.plans import queries_ops, registry
from fraudlens.plans.models import FraudModels


def _fact(spark, rows, as_of="2024-12-31"):
    m = FraudModels(raw_sources(spark, rows, [customer("CUST_1")], [merchant("MERCH_1")], [card("CARD_1")]),
                    as_of=as_of, audit=False)
    return m.fct_transactions


def _diff(a, b):
    r = INC.relation_diff(a, b).first()
    return r.rows_only_in_left, r.rows_only_in_right


def test_first_run_then_idempotent_rerun(spark, tmp_dir):
    fct = _fact(spark, [txn(f"T{i}", date=f"2024-12-{20 + i % 5}") for i in range(20)])
    assert INC.upsert(spark, fct, tmp_dir)["mode"] == "full"
    assert _diff(INC.read_table(spark, tmp_dir), fct) == (0, 0)
    out = INC.upsert(spark, fct, tmp_dir)
    assert out["mode"] == "merge"
    assert _diff(INC.read_table(spark, tmp_dir), fct) == (0, 0)


def test_late_update_new_key_and_moved_key(spark, tmp_dir):
    base = [txn("A", date="2024-12-20"), txn("B", date="2024-12-28", amount=5.0),
            txn("C", date="2024-12-25"), txn("D", date="2024-12-28")]
    INC.upsert(spark, _fact(spark, base), tmp_dir)
    batch = _fact(spark, [txn("B", date="2024-12-28", amount=99.0, status="REVERSED"),   # changed same day
                          txn("C", date="2024-12-29"),                                   # key moved, day emptied
                          txn("E", date="2024-12-30")])                                  # new key
    out = INC.upsert(spark, batch, tmp_dir)
    assert "2024-12-25" in out["touched_partitions"] and out["emptied_partitions"] == ["2024-12-25"]
    got = {r.transaction_id: r for r in INC.read_table(spark, tmp_dir).collect()}
    assert sorted(got) == ["A", "B", "C", "D", "E"]
    assert float(got["B"].amount) == 99.0 and got["B"].status == "REVERSED"
    assert got["C"].transaction_date == dt.date(2024, 12, 29)
    assert got["A"].transaction_date == dt.date(2024, 12, 20)                            # untouched


def test_lookback_ignores_rows_older_than_three_days(spark):
    fct = _fact(spark, [txn("old", date="2024-12-27"), txn("edge", date="2024-12-28"), txn("new", date="2024-12-31")])
    got = sorted(r.transaction_id for r in INC.lookback_batch(fct, "2024-12-31").collect())
    assert got == ["edge", "new"]


def test_duplicate_key_in_batch_is_rejected(spark, tmp_dir):
    fct = _fact(spark, [txn("X", date="2024-12-28"), txn("X", date="2024-12-29")])
    with pytest.raises(INC.DuplicateKeyError):
        INC.upsert(spark, fct, tmp_dir)


def test_schema_sync_added_and_dropped_columns(spark, tmp_dir):
    fct = _fact(spark, [txn("A", date="2024-12-20"), txn("B", date="2024-12-29")])
    INC.upsert(spark, fct, tmp_dir)
    batch = _fact(spark, [txn("C", date="2024-12-30")]).withColumn("risk_note", F.lit("x")).drop("currency")
    INC.upsert(spark, batch, tmp_dir)
    table = INC.read_table(spark, tmp_dir)
    assert "risk_note" in table.columns and "currency" not in table.columns
    got = {r.transaction_id: r.risk_note for r in table.collect()}
    assert got == {"A": None, "B": None, "C": "x"}


def test_full_build_equals_daily_increments(spark, tmp_dir):
    rows = [txn(f"T{i}", date=f"2024-12-{10 + i % 8}", amount=float(i + 1)) for i in range(40)]
    full = _fact(spark, rows)
    days = sorted({r[7] for r in rows})
    for d in days:                                   # daily run with a 3-day lookback
        INC.upsert(spark, INC.lookback_batch(full.where(F.col("transaction_date") <= d), d), tmp_dir)
    assert _diff(INC.read_table(spark, tmp_dir), full) == (0, 0)


def test_merge_by_key_replaces_whole_rows(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k long, v string, w long")
    b = spark.createDataFrame([(2, "z"), (3, "q")], "k long, v string")
    got = sorted(tuple(r) for r in INC.merge_by_key(a, b, "k").collect())
    assert got == [(1, "x"), (2, "z"), (3, "q")]


def test_incremental_run_refreshes_summary_and_clears_emptied_days(spark, tmp_dir):
    from fraudlens.plans import runs
    dims = dict(customers=[customer("CUST_1")], merchants=[merchant("MERCH_1")], cards=[card("CARD_1")])
    day1 = [txn("A", date="2024-12-26"), txn("B", date="2024-12-28")]
    runs.write_raw_parquet(spark, raw_sources(spark, day1, **dims), f"{tmp_dir}/raw")
    runs.build_all(spark, f"{tmp_dir}/raw", f"{tmp_dir}/marts", as_of="2024-12-31")
    # a correction moves B to another day (its old day becomes empty), and C arrives late
    day2 = [txn("A", date="2024-12-26"), txn("B", date="2024-12-29"), txn("C", date="2024-12-30")]
    runs.write_raw_parquet(spark, raw_sources(spark, day2, **dims), f"{tmp_dir}/raw")
    stats = runs.incremental_run(spark, f"{tmp_dir}/raw", f"{tmp_dir}/marts", as_of="2024-12-31")
    assert stats["emptied_partitions"] == ["2024-12-28"]
    summary = spark.read.parquet(f"{tmp_dir}/marts/fct_fraud_summary")
    got = sorted((str(r.transaction_date), r.total_transactions) for r in summary.collect())
    assert got == [("2024-12-26", 1), ("2024-12-29", 1), ("2024-12-30", 1)]


def test_rows_without_a_day_are_merged_too(spark, tmp_dir):
    a = spark.createDataFrame([("K1", None, 1), ("K2", "2024-12-30", 2)], "transaction_id string, transaction_date string, v int") \
        .selectExpr("transaction_id", "cast(transaction_date as date) as transaction_date", "v",
                    "'C' as customer_id", "false as is_fraudulent")
    INC.upsert(spark, a, tmp_dir)
    b = a.where("transaction_id = 'K1'").selectExpr("transaction_id", "transaction_date", "10 as v", "customer_id", "is_fraudulent")
    INC.upsert(spark, b, tmp_dir)
    got = sorted((r.transaction_id, r.v) for r in INC.read_table(spark, tmp_dir).collect())
    assert got == [("K1", 10), ("K2", 2)]


def test_full_rebuild_replaces_every_day(spark, tmp_dir):
    from fraudlens.plans import runs
    dims = dict(customers=[customer("CUST_1")], merchants=[merchant("MERCH_1")], cards=[card("CARD_1")])
    runs.write_raw_parquet(spark, raw_sources(spark, [txn("A", date="2024-12-20"), txn("B", date="2024-12-21")],
                                              **dims), f"{tmp_dir}/raw")
    runs.build_all(spark, f"{tmp_dir}/raw", f"{tmp_dir}/marts", as_of="2024-12-31")
    runs.write_raw_parquet(spark, raw_sources(spark, [txn("A", date="2024-12-20"), txn("B", date="2024-12-22")],
                                              **dims), f"{tmp_dir}/raw")
    runs.build_all(spark, f"{tmp_dir}/raw", f"{tmp_dir}/marts", as_of="2024-12-31")
    fct = INC.read_table(spark, f"{tmp_dir}/marts/fct_transactions")
    assert sorted((r.transaction_id, str(r.transaction_date)) for r in fct.collect()) == [
        ("A", "2024-12-20"), ("B", "2024-12-22")]
    days = sorted(str(r[0]) for r in spark.read.parquet(f"{tmp_dir}/marts/fct_fraud_summary")
                  .select("transaction_date").distinct().collect())
    assert days == ["2024-12-20", "2024-12-22"]


def test_first_incremental_run_builds_the_whole_fact_and_later_ones_refresh_the_dimensions(spark, tmp_dir):
    from fraudlens.plans import runs
    dims = dict(customers=[customer("CUST_1")], merchants=[merchant("MERCH_1")], cards=[card("CARD_1")])
    raw, marts = f"{tmp_dir}/raw", f"{tmp_dir}/marts"
    rows = [txn(f"T{i}", date=f"2024-12-{10 + i}") for i in range(20)]
    runs.write_raw_parquet(spark, raw_sources(spark, rows, **dims), raw)
    assert runs.incremental_run(spark, raw, marts, as_of="2024-12-31")["mode"] == "full"
    assert INC.read_table(spark, f"{marts}/fct_transactions").count() == 20
    assert spark.read.parquet(f"{marts}/fct_fraud_summary").agg(F.sum("total_transactions")).first()[0] == 20
    rows += [txn("late", date="2024-12-30", fraud=True, ftype="stolen_card")]
    runs.write_raw_parquet(spark, raw_sources(spark, rows, **dims), raw)
    assert runs.incremental_run(spark, raw, marts, as_of="2024-12-31")["mode"] == "merge"
    runs.build_all(spark, raw, f"{tmp_dir}/full", as_of="2024-12-31")
    for dim in ("dim_customers", "dim_merchants"):
        a, b = (spark.read.parquet(f"{d}/{dim}") for d in (marts, f"{tmp_dir}/full"))
        cols = [c for c in a.columns if not c.startswith("_")]
        assert _diff(a.select(cols), b.select(cols)) == (0, 0)


def test_a_changed_column_type_is_refused_before_writing(spark, tmp_dir):
    fct = _fact(spark, [txn("A", date="2024-12-20"), txn("B", date="2024-12-29")])
    INC.upsert(spark, fct, tmp_dir)
    with pytest.raises(INC.TypeChangeError, match="hour_of_day"):
        INC.upsert(spark, _fact(spark, [txn("C", date="2024-12-30")]).withColumn("hour_of_day", F.col("hour_of_day").cast("string")), tmp_dir)
    assert _diff(INC.read_table(spark, tmp_dir), fct) == (0, 0)


def test_relation_diff_counts_rows_as_bags(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "z")], "k int, v string")
    assert _diff(a, b) == (3, 1) and _diff(a, a) == (0, 0) and _diff(a.limit(0), b) == (0, 2)


def test_a_batch_opens_only_the_days_of_its_keys(spark, tmp_dir):
    INC.upsert(spark, _fact(spark, [txn(f"T{i}", date=f"2024-11-{1 + i % 28:02d}") for i in range(280)]), tmp_dir)
    out = INC.upsert(spark, _fact(spark, [txn("T3", date="2024-12-01"), txn("new", date="2024-12-01")]), tmp_dir)
    assert out["opened_partitions"] == ["2024-11-04", "2024-12-01"] == out["touched_partitions"]
    # the index still names the day that T3 has left: it is opened, found to hold no key of the batch, and not rewritten
    out = INC.upsert(spark, _fact(spark, [txn("T3", date="2024-12-02")]), tmp_dir)
    assert out["opened_partitions"] == ["2024-11-04", "2024-12-01", "2024-12-02"]
    assert out["touched_partitions"] == ["2024-12-01", "2024-12-02"]
    INC.rebuild_key_index(spark, tmp_dir)
    out = INC.upsert(spark, _fact(spark, [txn("T3", date="2024-12-03")]), tmp_dir)
    assert out["opened_partitions"] == ["2024-12-02", "2024-12-03"]
    rows = [(r.transaction_id, str(r.transaction_date)) for r in INC.read_table(spark, tmp_dir).collect()]
    assert len(rows) == 281 and ("T3", "2024-12-03") in rows


def test_equal_hashes_of_other_keys_open_a_day_in_vain(spark, tmp_dir, monkeypatch):
    def few_names(rows, keys, partition_col):
        name = F.pmod(F.xxhash64(*keys), F.lit(3))
        return rows.select(name.alias("name"), F.col(partition_col).alias("day"), F.pmod(name, F.lit(2)).cast("int").alias("bucket"))

    monkeypatch.setattr(INC, "_index_entries", few_names)
    first = [txn(f"T{i}", date=f"2024-12-{1 + i % 20:02d}") for i in range(60)]
    INC.upsert(spark, _fact(spark, first), tmp_dir)
    out = INC.upsert(spark, _fact(spark, [txn("T5", date="2024-12-25", amount=3.0)]), tmp_dir)
    assert len(out["opened_partitions"]) > 3 and out["touched_partitions"] == ["2024-12-06", "2024-12-25"]
    assert INC.read_table(spark, tmp_dir).count() == 60


def test_a_table_without_an_index_gets_one(spark, tmp_dir):
    fct = _fact(spark, [txn("A", date="2024-12-20"), txn("B", date="2024-12-21")])
    INC.write_partitioned(fct, tmp_dir)
    INC.save_schema(spark, tmp_dir, fct.schema)
    assert INC.upsert(spark, _fact(spark, [txn("A", date="2024-12-22")]), tmp_dir)["emptied_partitions"] == ["2024-12-20"]
    assert sorted((r.transaction_id, str(r.transaction_date)) for r in INC.read_table(spark, tmp_dir).collect()) == [
        ("A", "2024-12-22"), ("B", "2024-12-21")]


@pytest.mark.parametrize("lost", [[], ["2024-12-20"], ["2024-12-20", "2024-12-22", "2024-12-23"]])
def test_a_crash_inside_the_swap_loses_no_row(spark, tmp_dir, monkeypatch, lost):
    base = [txn("A", date="2024-12-20"), txn("B", date="2024-12-20"), txn("C", date="2024-12-21"), txn("D", date="2024-12-22")]
    INC.upsert(spark, _fact(spark, base), tmp_dir)
    batch = _fact(spark, [txn("A", date="2024-12-23"), txn("D", date="2024-12-23")])

    def crash(spark, path):
        INC._drop_partition_dirs(spark, path, "transaction_date", lost)     # days gone, their new files not there yet
        raise RuntimeError("driver lost")

    swap, calls = INC.finish_swap, []
    monkeypatch.setattr(INC, "finish_swap", lambda s, p: calls.append(1) or (swap(s, p) if len(calls) == 1 else crash(s, p)))
    with pytest.raises(RuntimeError):
        INC.upsert(spark, batch, tmp_dir)
    expected = [("A", "2024-12-23"), ("B", "2024-12-20"), ("C", "2024-12-21"), ("D", "2024-12-23")]

    def rows():
        return sorted((r.transaction_id, str(r.transaction_date)) for r in INC.read_table(spark, tmp_dir).collect())

    assert rows() == expected                      # readers see the whole swap already
    monkeypatch.setattr(INC, "finish_swap", swap)
    INC.upsert(spark, _fact(spark, [txn("E", date="2024-12-24")]), tmp_dir)
    assert rows() == [*expected, ("E", "2024-12-24")]
    assert INC._open_swap(spark, tmp_dir) is None


def test_a_rewrite_without_a_journal_does_not_count(spark, tmp_dir, monkeypatch):
    INC.upsert(spark, _fact(spark, [txn("A", date="2024-12-20")]), tmp_dir)
    write = INC.write_partitioned

    def crash(df, path, *args):
        write(df, path, *args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(INC, "write_partitioned", crash)
    with pytest.raises(RuntimeError):
        INC.upsert(spark, _fact(spark, [txn("A", date="2024-12-20", amount=7.0)]), tmp_dir)
    monkeypatch.setattr(INC, "write_partitioned", write)
    assert [float(r.amount) for r in INC.read_table(spark, tmp_dir).collect()] == [10.0]
    INC.upsert(spark, _fact(spark, [txn("B", date="2024-12-21")]), tmp_dir)
    assert INC.read_table(spark, tmp_dir).count() == 2


def test_compare_by_key(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (4, None, 4.0), (5, "d", 5.0), (5, "d", 5.0), (None, "n", 0.0)],
                              "k int, s string, v double")
    b = spark.createDataFrame([(1, "x", 1.0, True), (2, "y", 2.0, True), (4, "q", 5.0, True), (5, "d", 5.0, True), (6, "new", 6.0, True),
                               (None, "n", 0.0, True)], "k int, s string, v double, extra boolean")
    got = {(r.kind, r.column_name): r.rows for r in INC.compare_tables(a, b, "k", buckets=8).collect()}
    assert got == {("only_left", None): 1, ("only_right", None): 1, ("repeated_left", None): 1, ("repeated_right", None): 0,
                   ("changed", None): 2, ("changed", "s"): 1, ("changed", "v"): 2, ("column_right", "extra"): None}
    same = {(r.kind, r.column_name): r.rows for r in INC.compare_tables(a, a, "k").collect()}
    assert set(same.values()) == {0}
    assert INC.differing_buckets(*(INC._bucketed(x, ["k"], ["k", "s", "v"], 64) for x in (a, a.repartition(3))), ["k", "s", "v"]) == []


def test_comparison_by_day_counts_as_the_comparison_of_all_rows(spark):
    schema = "k int, day string, s string, v double, w double"
    left = [(1, "a", "x", 1.0, None), (2, "a", "y", 2.0, 2.0), (3, "b", "z", None, 3.0), (4, "b", "p", 4.0, 4.0), (4, "c", "p", 4.0, 4.0),
            (5, "c", "q", 5.0, 5.0), (6, "c", "r", 6.0, 6.0), (6, "c", "r", 6.0, 6.0), (None, None, "n", 0.0, 0.0), (8, "c", "t", 8.0, 8.0)]
    right = [(1, "a", "x", 1.0, None), (2, "a", "y", 2.0, 2.0), (3, "b", "z", 3.0, None), (4, "c", "p", 4.0, 4.0),
             (5, "c", "q", 5.0, 5.0), (6, "c", "r", 6.0, 6.0), (6, "c", "r", 6.0, 6.0), (None, None, "n", 0.0, 1.0), (7, "d", "u", 7.0, 7.0), (8, "c", "t", 8.0, 8.0)]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    def counts(**how):
        return {(r.kind, r.column_name): r.rows for r in INC.compare_tables(a, b, "k", **how).collect()}

    assert counts(buckets=1, by="day") == {
        ("only_left", None): 0, ("only_right", None): 1, ("repeated_left", None): 2, ("repeated_right", None): 1, ("changed", None): 2,
        ("changed", "day"): 0, ("changed", "s"): 0, ("changed", "v"): 1, ("changed", "w"): 2}
    for buckets in (1, 3, 4096):
        assert counts(buckets=buckets, by="day") == counts(buckets=buckets)
    for by in (None, "day"):
        assert tuple(INC.relation_diff(a, b, by).first()) == (3, 3)
    both = a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1)))
    assert set(INC.differing_values(both, "day", a.columns)) == {"b", "d", None}


def test_every_row_of_repeated_keys_is_compared(spark):
    schema = "k int, day string, s string, v double"
    left = [(1, "a", "x", 1.0), (2, "a", "y", None), (3, "b", "z", 3.0), (3, "b", "w", 3.0), (4, "c", "p", 4.0), (5, "c", "q", 5.0), (5, "c", "q", 5.0),
            (None, None, "n", 0.0), (6, "d", "r", 6.0), (6, "e", "r", 6.0), (8, "f", "only", 8.0), (8, "f", "only", 8.0)]
    right = [(1, "a", "x", 1.0), (2, "a", "y", 2.0), (3, "b", "z", 3.0), (3, "b", "w", 3.0), (4, "d", "p", 4.0), (5, "c", "q", 5.0), (5, "c", None, 5.0),
             (None, None, "n", 0.0), (None, None, "n", 0.0), (6, "e", "r", 6.0), (7, "d", "new", 7.0), (9, "g", "two", 1.0), (9, "g", "two", 2.0)]
    values, kinds = ("day", "s", "v"), ("only_left", "only_right", "repeated_left", "repeated_right", "changed")
    count = {(kind, None): 0 for kind in kinds} | {("changed", c): 0 for c in values}
    for side, one, other in (("left", left, right), ("right", right, left)):
        keys = [r[0] for r in one]
        count[f"only_{side}", None] = sum(k not in {r[0] for r in other} for k in keys)
        count[f"repeated_{side}", None] = sum(keys.count(k) > 1 for k in set(keys))
    for x in left:
        for y in (y for y in right if x[0] == y[0]):
            count["changed", None] += x != y
            for i, c in enumerate(values, 1):
                count["changed", c] += x[i] != y[i]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)

    def counts(x, y, **how):
        return {(r.kind, r.column_name): r.rows for r in INC.compare_tables(x, y, "k", every_row=True, **how).collect()}

    for buckets, by, most in ((1, "day", 100), (4096, "day", 1), (4096, None, 100)):
        assert counts(a, b, buckets=buckets, by=by, max_broadcast_rows=most) == count
    # equal tables: keys 3, 5, 6 and 8 are repeated on both sides, and rows of 3 and 6 differ among themselves
    same = counts(a, a, by="day")
    assert (same["repeated_left", None], same["repeated_right", None], same["changed", None], same["changed", "s"], same["changed", "day"]) == (4, 4, 4, 2, 2)
    once = counts(a.where("k < 3"), b.where("k < 3"), by="day")
    assert (once["repeated_left", None], once["changed", None], once["changed", "v"]) == (0, 1, 1)


def test_whole_rows_are_compared_only_on_days_that_differ(spark):
    a = spark.range(40).selectExpr("id AS k", "cast(id % 4 AS string) AS day", "id AS v")
    b = a.withColumn("v", F.when(F.col("k") == 6, -1).otherwise(F.col("v")))
    assert INC.differing_values(a.withColumn("__side", F.lit(1)).unionByName(b.withColumn("__side", F.lit(-1))), "day", a.columns) == ["2"]
    assert INC.relation_diff(a, b, "day").first().asDict() == {"rows_only_in_left": 1, "rows_only_in_right": 1}


def test_a_first_batch_with_repeated_keys_leaves_no_table(spark, tmp_dir):
    path = f"{tmp_dir}/fct"
    with pytest.raises(INC.DuplicateKeyError):
        INC.upsert(spark, _fact(spark, [txn("A"), txn("A", amount=7.0)]), path)
    assert not INC.table_exists(spark, path) and INC._is_vacant(spark, path)
    INC.upsert(spark, _fact(spark, [txn("A"), txn("B")]), path)
    assert sorted(r.transaction_id for r in INC.read_table(spark, path).collect()) == ["A", "B"]


@pytest.mark.parametrize("name, count", [("i3_upsert_twice", 5), ("i8_key_index_moves", 3)])
def test_only_the_days_of_later_batches_are_staged(spark, monkeypatch, name, count):
    days = [*["2001-04-02"] * 20, *["2001-06-27"] * 3, "2001-07-12", "2001-07-21", "2001-07-21", "2001-07-30", "2001-08-01"]
    m = FraudModels(raw_sources(spark, [txn(f"T{i}", date=d) for i, d in enumerate(days)], [customer("CUST_1")], [merchant("MERCH_1")],
                                [card("CARD_1")]), as_of="2001-08-01", audit=False)
    sizes, stage = [], queries_ops.staged

    def spy(df, label):
        out = stage(df, label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(queries_ops, "staged", spy)
    monkeypatch.setattr(queries_ops, "models", lambda spark, sf_dir: m)
    got = registry.queries()[name](spark, "")
    # i3: a row of 12 July comes again under a new key, two of the 21st move to the 27th
    new = 1 if name == "i3_upsert_twice" else 0
    assert got.count() == len(days) + new and sizes == [count]
    moved = got.where("transaction_date = DATE'2001-07-27' AND status = 'REVERSED'").count()
    assert moved == (2 if name == "i3_upsert_twice" else 0)
