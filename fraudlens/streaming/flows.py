"""Structured Streaming forms of the incremental fact (I5) and daily summary (I6).

Both read raw transaction files as a stream (explicit schema, no inference) and
upsert each micro-batch into the day-partitioned fact by key (``foreachBatch``).
The table itself is the state: there is no watermark, so no row is ever too late.

* I5 ``start_fact_stream``: exact re-deliveries (whole identical rows) inside a
  micro-batch are dropped; a re-delivery in a later one replaces the stored row
  by itself, and a *changed* version of a transaction replaces it, as MERGE does.
  Two different versions of one key inside one micro-batch are rejected like a
  batch with a repeated key.  Rows of any age are merged into their day.  The
  upsert is idempotent, so a micro-batch replayed after a failure leaves the
  same table (exactly-once effect with the checkpointed source offsets).
* I6 ``start_summary_stream``: the same stream, keeping the fact beside the
  summary; after each micro-batch the touched days of the summary are recomputed
  from the fact, so every transaction counts once in its latest version.

Micro-batch hand-off: a micro-batch belongs to the stream's session clone.  Each
non-empty one is written once to a staging folder in the shared checkpoint area
(a narrow write) and read back through the application's own session, where the
enrichment and the upsert run with adaptive execution; the staged copy is removed
afterwards.

Checkpoint locations must live in shared, durable storage (by default a
folder under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudlens.operators import intermediate as I
from fraudlens.operators import marts as M
from fraudlens.operators import staging as S
from fraudlens.operators.lookup import DEFAULT_BROADCAST_MAX_ROWS
from fraudlens.plans import incremental as INC
from fraudlens.session import materialize, scratch_path
from fraudlens.sources.schemas import transactions_schema


def _handoff(spark: SparkSession, batch: DataFrame, epoch_id: int, process) -> None:
    """Stage a micro-batch and process it through ``spark`` (AQE on)."""
    if batch.isEmpty():
        return
    path = scratch_path(spark, f"microbatch-{epoch_id}-{uuid.uuid4().hex}")
    batch.write.mode("overwrite").option("compression", "zstd").parquet(path)
    try:
        process(spark.read.parquet(path))
    finally:
        INC._delete_paths(spark, [path], required=False)


def without_redeliveries(batch: DataFrame, max_broadcast_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``batch.dropDuplicates()``: equal rows have equal ids, so only rows whose id comes again are compared whole."""
    names = materialize(INC.repeated_key_hashes(batch, "transaction_id"))
    repeated = names.count()
    if repeated == 0:
        return batch
    if repeated > max_broadcast_rows:
        return batch.dropDuplicates()
    named = batch.withColumn("name", F.xxhash64("transaction_id"))
    again = named.join(F.broadcast(names), "name", "left_semi").drop("name").dropDuplicates()
    return named.join(F.broadcast(names), "name", "left_anti").drop("name").unionByName(again)


def read_transactions_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", id_type: T.DataType = T.StringType(),
    max_files_per_trigger: int | None = None, schema: T.StructType | None = None,
) -> DataFrame:
    schema = schema or transactions_schema(id_type)
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def start_fact_stream(
    raw_stream: DataFrame, stg_cards: DataFrame, stg_customers: DataFrame, stg_merchants: DataFrame,
    target_path: str, checkpoint_location: str, available_now: bool = True,
    trigger_interval: str = "1 minute", summary_path: str | None = None,
) -> StreamingQuery:
    """I5; with ``summary_path`` the touched days of the summary are also
    recomputed from the fact after every micro-batch, so the summary counts
    each transaction once in its latest version (exact under corrections)."""
    spark = stg_cards.sparkSession          # the application's session (AQE on)

    def upsert_batch(raw_batch: DataFrame) -> None:
        batch = without_redeliveries(S.stg_transactions(raw_batch, audit=False))
        by_day = not INC.table_exists(spark, target_path)        # the first micro-batch is written as it is dealt here
        fct = M.fct_transactions(I.int_transactions_enriched(
            batch, stg_cards, stg_customers, stg_merchants, rebalance_by="transaction_date" if by_day else None, stored=True), audit=False)
        stats = INC.upsert(spark, fct, target_path, by_day=by_day)
        if summary_path is not None:
            from fraudlens.plans.runs import refresh_summary
            refresh_summary(spark, target_path, summary_path, stats, audit=False)

    def process(batch: DataFrame, epoch_id: int) -> None:
        _handoff(spark, batch, epoch_id, upsert_batch)

    writer = raw_stream.writeStream.foreachBatch(process) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    return writer.start()


def start_summary_stream(
    raw_stream: DataFrame, stg_cards: DataFrame, stg_customers: DataFrame, stg_merchants: DataFrame,
    target_path: str, checkpoint_location: str, available_now: bool = True,
    trigger_interval: str = "1 minute", fact_path: str | None = None,
) -> StreamingQuery:
    """I6: the summary at ``target_path``, recomputed for the days each micro-batch touches from
    the fact at ``fact_path`` (default: a folder beside it)."""
    return start_fact_stream(
        raw_stream, stg_cards, stg_customers, stg_merchants, fact_path or f"{target_path.rstrip('/')}_fact",
        checkpoint_location, available_now, trigger_interval, summary_path=target_path)
