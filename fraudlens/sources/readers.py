"""Raw landing readers (CSV / Parquet) and the declared-source lookup.

* ``read_raw_csv``      – header CSV with an explicit schema, FAILFAST: a bad
                          value raises instead of turning silently into NULL.
* ``read_raw_parquet``  – same contract for Parquet landing data.
* ``RawSources``        – the ``source('raw', name)`` lookup: a name → DataFrame
                          mapping that can also register temp views for SQL.
* ``file_sizes``        – rows and bytes per file of a written table, taken from
                          the hidden ``_metadata`` column (no driver listing).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.sources.schemas import RAW_SCHEMAS, RAW_TABLES


def read_raw_csv(
    spark: SparkSession,
    path: str,
    table: str,
    id_type: T.DataType = T.StringType(),
) -> DataFrame:
    schema = RAW_SCHEMAS[table](id_type)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_raw_parquet(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if table is not None:
        expected = [f.name for f in RAW_SCHEMAS[table]().fields]
        missing = [c for c in expected if c not in df.columns]
        if missing:
            raise ValueError(f"raw.{table} at {path} lacks columns {missing}")
        df = df.select(*expected)
    return df


class RawSources(Mapping):
    """``source('raw', t)``: resolves a raw table name to its DataFrame."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        unknown = set(tables) - set(RAW_TABLES)
        if unknown:
            raise KeyError(f"unknown raw tables {sorted(unknown)}")
        self._tables = dict(tables)

    @classmethod
    def from_dir(
        cls,
        spark: SparkSession,
        base: str,
        fmt: str = "csv",
        id_type: T.DataType = T.StringType(),
    ) -> "RawSources":
        if fmt == "csv":
            return cls({t: read_raw_csv(spark, f"{base}/{t}.csv", t, id_type) for t in RAW_TABLES})
        return cls({t: read_raw_parquet(spark, f"{base}/{t}", t) for t in RAW_TABLES})

    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def register_views(self, prefix: str = "raw_") -> None:
        for name, df in self._tables.items():
            df.createOrReplaceTempView(f"{prefix}{name}")


def file_sizes(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One row per data file: path, size in bytes / MB and row count."""
    df = spark.read.format(fmt).load(path) if fmt != "csv" else spark.read.option("header", True).csv(path)
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("size_mb", F.round(F.col("file_size") / F.lit(1024 * 1024), 3))
    )


def is_partitioned_by(df: DataFrame, column: str) -> bool:
    """True if the files behind ``df`` sit in ``column=value`` folders.

    Reads the path of a single row (``limit(1)`` scans one split), so it is
    cheap whatever the table size.
    """
    row = df.select(F.col("_metadata.file_path").alias("p")).limit(1).first()
    return row is not None and f"/{column}=" in row["p"]
