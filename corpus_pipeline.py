"""The corpus pipeline: classify, dedup lines, drop near copies, decontaminate, tokenize.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet in the shared checkpoint
folder and rereads as the next stage's documents.  All but the last
return the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from fraudlens.llm.common import importable, materialize, staged, table

#: Rows may be dropped through a broadcast while the table that names them is no longer than this.
BROADCAST_ROWS = 1_000_000
#: SQL cannot fit the classifier or encode tokens: the stages are tested against brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents but those named by (doc_id, row), ``row`` being the hash of the text."""
    dropped = materialize(dropped.select("doc_id", "row").distinct())
    small = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    same = docs["doc_id"].eqNullSafe(small["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == small["row"])
    return docs.join(small, same, "left_anti")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; those without words go."""
    importable(spark)
    return quality.classify(docs).where("_keep").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones match; one that has lost all its words goes."""
    cleaned = line_dedup.dedup_lines(docs)
    left = (F.size("_removed") == 0) | F.col("text").rlike(r"[^ \t\n\r\x0b\x0c]")
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; of repeated rows one.

    Rows that share the smallest id of their group with different texts all stay, and so does a row with a NULL id:
    neither has a smaller id beside it.
    """
    importable(spark)
    groups = staged(ngram_join.near_components(docs), "groups")
    kept = _without(docs, groups.where("component_id <> doc_id"))
    repeated = materialize(groups.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    if repeated.isEmpty():
        return kept
    named = docs.withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))))
    again = named.join(repeated, named["doc_id"].eqNullSafe(repeated["doc_id"]) & (named["row"] == repeated["row"]), "left_semi")
    once = _without(again.dropDuplicates(["doc_id", "row"]).select(*docs.columns), groups.where("component_id <> doc_id"))
    return _without(kept, repeated).unionByName(once)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    importable(spark)
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (little-endian unsigned 32-bit) and digests of them and of their decoded text."""
    importable(spark)
    spec = bpe.tokenizer_spec(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.decode(bpe.encode(docs, spec), spec).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_copies),
    ("decontamination", decontaminate_benchmark),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the ``documents`` table at ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
