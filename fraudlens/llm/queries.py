"""Registered queries of the corpus operators: ``op<N>_<name>`` and ``pipeline``.

Each query is thin: it applies an operator with production parameters to its
whole table and derives the digest columns its contract asks for.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import (bpe, decontaminate, exact_dedup, filter_audit, html, line_dedup, ngram_join, pii, quality,
                           suffix_dedup, token_alignment, url_filter, warc)
from fraudlens.llm.common import importable, table
from fraudlens.llm.oracle import ORACLE

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.col("_n_lines").cast("bigint").alias("n_lines"),
                          F.size("_removed").cast("bigint").alias("n_removed"),
                          F.array_join(F.col("_removed").cast("array<string>"), ",").alias("removed"),
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op3_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    spec = bpe.tokenizer_spec(spark, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), spec), spec)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, F.lit(k).__eq__)).cast("bigint").alias(f"n_{k}") for k in pii.PATTERNS]
    base = F.filter("spans", lambda x: x["kind"] != "term")
    return found.select("doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", F.col("_votes").alias("votes"), F.col("_score").alias("score"), F.col("_keep").alias("keep"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), a or public_tokenizers.path("byte_bpe_50k.json"),
                                 b or public_tokenizers.path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def _ready(fn: QueryFn) -> QueryFn:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, QueryFn]:
    return {f.__name__: _ready(f) for f in (
        op1_line_dedup, op2_decontamination, op3_bpe, op4_ngram_join, op5_warc, op6_quality_classifier, op7_html_extraction, op8_pii,
        op9_exact_dedup, op10_url_filters, op11_suffix_dedup, op12_token_alignment,
        op13_filter_audit, pipeline)}


def oracle_sql() -> dict[str, str]:
    return ORACLE | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
