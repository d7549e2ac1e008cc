"""One registered query for every operator, over whole tables with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    chunk_reuse,
    exact_dedup,
    imatch,
    line_dedup,
    merkle,
    packing,
    ppm,
    quality_classifier,
    quality_rules,
    ranked_search,
    simhash,
    url_filters,
    warc,
)
from shelfmark.llm.common import scratch, table, whole_text
from shelfmark.llm.encoding import path
from shelfmark.llm.oracles import ORACLES  # noqa: F401


def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    judged, stats, failed, kept = quality_rules.judged(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    counts = [F.col(f"{stats}.{name}") for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, F.col(failed).alias("base_failed"), F.col(kept).alias("kept"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), path("byte_bpe_50k.json"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = scratch(spark, "warc")
    warc.write_pages(table(spark, folder, "pages"), archives)
    return warc.read_pages(spark, archives)


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_kept", "text")


URL_RULES = [
    url_filters.host_rule("allow", "com", "/"),
    url_filters.host_rule("block", "example.com", "/en/"),
    url_filters.host_rule("allow", "www.example.com", "/en/"),
    url_filters.host_rule("block", "net", "/es/"),
    url_filters.host_rule("block", "net", "/fr/"),
    *(
        url_filters.pattern_rule("block", pattern)
        for pattern in ("||spam-farm.", "||cheap-pills.", "||casino-win.", "||free-bets.", "||adult-x.", "||ads-track.")
    ),
]


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.filtered(table(spark, folder, "pages"), URL_RULES).drop("n_candidates")


def op6_compression_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classified(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return ppm.scored(table(spark, folder, "documents"))


def op8_chunk_reuse(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_reuse.encoded(table(spark, folder, "documents"), path("word_bpe_49k.json"))


def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.fingerprinted(table(spark, folder, "documents"))


def op10_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, folder, "documents"))


def op11_bitmap_merkle(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.proven(table(spark, folder, "documents"), tampered)


def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    digest = {"text_sha256": F.sha2(whole_text(), 256)}
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"), digest)
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OPERATORS = (
    op1_robust_outliers,
    op2_best_fit_packing,
    op3_warc,
    op4_line_dedup,
    op5_url_filters,
    op6_compression_classifier,
    op7_ppm,
    op8_chunk_reuse,
    op9_imatch,
    op10_simhash_bktree,
    op11_bitmap_merkle,
    op12_exact_dedup,
    op13_ranked_search,
)
REGISTRY = {operator.__name__: operator for operator in OPERATORS}
