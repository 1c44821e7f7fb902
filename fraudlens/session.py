"""Session construction and cluster-safe scratch locations.

Library code never creates its own session; callers pass one in.  This
module only offers a builder for scripts/tests and a helper that resolves
the shared checkpoint folder from the running session.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this library relies on.  AQE re-plans joins at
# runtime (converts sort-merge joins to broadcast joins when the measured
# shuffle output is small, splits skewed partitions of a left-outer join and
# coalesces tiny shuffle partitions), so it is always on.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # reliable checkpoints (materialize) are removed once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "fraudlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster the master and resources come from ``spark-submit``; pass
    ``master`` only for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # file listing of day-partitioned tables: a few tasks per local core,
        # not the cluster default of 10,000 tiny listing tasks
        cores = (master[master.find("[") + 1:-1] if "[" in master else "1").split(",")[0]
        n = (os.cpu_count() or 8) if cores in ("*", "") else int(cores)
        conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(4 * n)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only on a local master.

    Order: a folder the application set with ``setCheckpointDir`` (kept as it
    is), then ``spark.checkpoint.dir``, which on a cluster names a shared,
    fault-tolerant folder (HDFS/S3/ABFS).  With neither set, a local run gets a
    fresh temporary folder; any other master raises, because a machine-local
    folder there would lose data with the machine.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return conf_dir or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fraudlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path inside the shared checkpoint folder for staged writes."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used for small derived tables that several later passes read (for
    example the per-merchant aggregate feeding the exact percentiles), so the
    large input behind them is scanned once.  Survives executor loss, unlike a
    local checkpoint or a cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes the shuffle files of a finished query while this is set.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries run inside leave no shuffle files: for those that end in a table of their own."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def staged(df, name: str):
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage like :func:`materialize`, for tables as long as the input: columnar and compressed, later
    passes read only the columns they use, and the shuffle files behind it go when it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"staged-{name}-{uuid.uuid4().hex}")
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized to the data, for ``build_session(extra_conf=...)`` or spark-submit.

    * initial shuffle partitions ≈ input / target size (at least 2 per core),
      AQE then coalesces small ones and splits skewed ones to the same
      advisory size, so a 100 TB build starts with ~400k partitions of ~256 MB
      rather than the default 200 of ~500 GB;
    * scan splits of half the target (Parquet expands when decoded);
    * the broadcast threshold stays small: dimensions are broadcast through
      the explicit, counted bound in ``operators/lookup.py``, never by a stale
      size estimate;
    * streaming state in RocksDB (off-heap, spills to local disk, checkpointed
      to the shared folder) for key spaces larger than executor memory.
    """
    shuffle = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target_partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(min(10_000, max(32, 2 * total_cores))),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
