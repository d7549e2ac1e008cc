"""The corpus pipeline: five stages over ``documents``, each written and read again as the next one's input.

Quality classifier, quality rules, line deduplication, SimHash near-deduplication, packing.
All but the last return the columns of documents. A document of which line deduplication leaves no
line stays, with an empty text; near-deduplication then keeps one of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import line_dedup, packing, quality_classifier, quality_rules, simhash
from shelfmark.llm.common import fresh, narrow_batches, stored, table
from shelfmark.llm.encoding import path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores as good at least as likely as the threshold."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "score")
    scored = docs.withColumn(name, quality_classifier.score(F.col("text"), model))
    return scored.where(F.col(name) >= quality_classifier.THRESHOLD).select(*docs.columns)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the cutoff of their language and source."""
    narrow_batches(spark)
    judged, _, _, kept = quality_rules.judged(docs)
    return judged.where(F.col(kept)).select(*docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, of every group of like lines one line; ``n_chars`` counts what is left."""
    narrow_batches(spark)
    rewritten = line_dedup.deduplicated(docs)
    return rewritten.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    narrow_batches(spark)
    return simhash.keep_first(docs, stored(simhash.simhash_groups(docs), "near"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, with its place in a sequence."""
    narrow_batches(spark)
    return packing.packed(docs, path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("quality_rules", rules_stage),
    ("line_dedup", lines_stage),
    ("simhash_near_dedup", near_stage),
    ("best_fit_packing", packing_stage),
]

# Compression, robust estimates, fuzzy links and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
