"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens import session
from fraudlens.session import ensure_checkpoint_dir, scratch_path, shuffles_removed

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    On a cluster the package is installed on the executors or shipped with
    ``--py-files``; a folder that does not exist there is ignored.
    """
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a table may have, by its counted size, to be broadcast.
BROADCAST_ROWS = 1_000_000


def materialize(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared checkpoint folder, for small tables that several later jobs read."""
    with shuffles_removed(df.sparkSession):
        return session.materialize(df)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A materialised table, broadcast where its counted size allows it."""
    return F.broadcast(df) if df.count() <= rows else df


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back; ``compression`` as Parquet's writer names it.

    Cuts lineage like a checkpoint, but columnar and compressed: for
    intermediate tables that carry text or are read by several later jobs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    with shuffles_removed(spark):
        (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables whose last reader has written its result; none of them may be read again."""
    for df in tables:
        folders = {os.path.dirname(f) for f in df.inputFiles()}
        if any("/llm-" not in f for f in folders):
            raise ValueError(f"not staged: {sorted(folders)}")
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Bits of a bitmap of hashes (16 MB), and of one row of it.
BITMAP_BITS, BITMAP_ROW = 27, 1 << 15


def bitmap_of(hashes: DataFrame, name: str) -> bytes:
    """A bit for the last BITMAP_BITS bits of each 64-bit hash in column ``name``: a filter of fixed size that lets no member go."""
    bit = F.col(name).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = (hashes.select(bit.alias("bit")).groupBy(F.shiftright("bit", BITMAP_ROW.bit_length() - 1).alias("row"))
            .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP_ROW).alias("bits")))
    out = bytearray(1 << (BITMAP_BITS - 3))
    with shuffles_removed(hashes.sparkSession):
        for r in rows.collect():                          # BITMAP_BITS fixes their number
            out[r["row"] * (BITMAP_ROW // 8):(r["row"] + 1) * (BITMAP_ROW // 8)] = r["bits"]
    return bytes(out)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be members."""
    bit = (hashes.view(np.uint64) & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; any other character stays as it is."""
    return (F.when(F.octet_length(col) == F.char_length(col), F.lower(col))
            .otherwise(F.translate(col, ASCII_UPPER, ASCII_LOWER)))


__all__ = ["ASCII_LOWER", "ASCII_UPPER", "ascii_lower", "bitmap_of", "bounded", "discard", "ensure_checkpoint_dir", "importable", "in_bitmap",
           "materialize", "scratch_path", "shuffles_removed", "staged", "table"]
