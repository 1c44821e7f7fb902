"""Registered streaming queries (I5, I6): file stream → micro-batch upserts.

The raw transactions derived from the shared tables are landed as files in
the shared checkpoint area and replayed as a stream with ``availableNow``;
the returned DataFrame reads the table the stream maintained.  The first pair
replays the whole input in one micro-batch; the ``late`` pair in four, newest
days first, so that each later micro-batch holds only older rows, and the second also
re-delivers rows of the first.  All must equal the batch fact and summary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fraudlens.operators import marts as M
from fraudlens.plans import incremental as INC
from fraudlens.plans.oracle import q
from fraudlens.plans.registry import models, register
from fraudlens.session import scratch_path
from fraudlens.streaming import flows as SP


CUTS = ["9999-12-31", "2000-01-01", "1998-01-01", "1996-01-01", "0000-01-01"]
AGAIN = "2001-06-01"       # rows from here on are delivered a second time


def _replay(spark, sf_dir, start, name, newest_first):
    """Land the raw transactions and run ``start`` to the end of the stream, once or after every landing."""
    m = models(spark, sf_dir)
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    raw, day = m.raw["transactions"], F.col("transaction_date")
    parts = [raw]
    if newest_first:
        parts = [raw.where((day < upper) & (day >= lower)) for upper, lower in zip(CUTS, CUTS[1:])]
        parts[1] = parts[1].unionByName(raw.where(day >= AGAIN))
    for part in parts:
        part.write.mode("append").option("compression", "zstd").parquet(f"{base}/landing")
        stream = SP.read_transactions_stream(spark, f"{base}/landing", schema=raw.schema)
        start(stream, m.stg_cards, m.stg_customers, m.stg_merchants,
              f"{base}/{name}", f"{base}/_checkpoint_{name}").awaitTermination()
    return f"{base}/{name}"


def _fact(spark, sf_dir, newest_first=False):
    path = _replay(spark, sf_dir, SP.start_fact_stream, "fct", newest_first)
    return INC.read_table(spark, path).select(*M.FACT_COLUMNS)


def _summary(spark, sf_dir, newest_first=False):
    return spark.read.parquet(_replay(spark, sf_dir, SP.start_summary_stream, "summary", newest_first))


@register("i5_stream_fact_upsert", q("SELECT * FROM fct"))
def i5_stream_fact_upsert(spark, sf_dir):
    return _fact(spark, sf_dir)


@register("i5_stream_fact_late_rows", q("SELECT * FROM fct"))
def i5_stream_fact_late_rows(spark, sf_dir):
    return _fact(spark, sf_dir, newest_first=True)


@register("i6_stream_fraud_summary", q("SELECT * FROM fraud_summary"))
def i6_stream_fraud_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@register("i6_stream_summary_late_rows", q("SELECT * FROM fraud_summary"))
def i6_stream_summary_late_rows(spark, sf_dir):
    return _summary(spark, sf_dir, newest_first=True)
