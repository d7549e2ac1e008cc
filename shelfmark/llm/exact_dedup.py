"""Exact deduplication by progressive refinement: length, then a hash of the beginning, then a hash of the whole.

Each level looks at the rows that the one before could not tell apart. Which lengths, and which
beginnings, occur more than once goes to the tasks as a bit set of ``BITS`` bits at any size of the
corpus, joined by word number; texts never cross a shuffle. A false hit of a bit set costs a
hash of one more text and changes no result: the last level groups by SHA-256 of the whole text.
Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.bits import BITS, bit_words, marked
from shelfmark.llm.common import fresh, stored, whole_text

#: Characters of a beginning.
PREFIX_CHARS = 256
#: Parts in which a group is counted and given its result, so that a hot one is no one task's work.
LOTS = 64


def shared_keys(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """``word, mask``: the bits of every long ``key`` that occurs more than once."""
    return bit_words(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), bits)


def exact_groups(
    docs: DataFrame, carry: Mapping[str, Column] | None = None, text: str = "text", prefix_chars: int = PREFIX_CHARS, bits: int = BITS
) -> DataFrame:
    """``doc_id``, the columns of ``carry``, then ``keep_id, group_size`` (long), ``kept`` for every row.

    ``carry`` names columns to pass on, computed from those of ``docs`` where a text is read last. Texts are
    equal when identical; a null one counts as empty. Of equal texts the row with the largest
    doc_id stays, a null doc_id being the smallest; of rows that repeat that doc_id just one stays.
    An empty table gives an empty result; further columns are not read.
    """
    carry = dict(carry or {})
    own = {name: fresh(docs, f"own_{name}") for name in ("text", "length", "begin", "known", "whole")}
    rows = docs.withColumn(own["text"], whole_text(text))
    rows = rows.withColumn(own["length"], F.octet_length(own["text"]).cast("long"))
    lengths = stored(shared_keys(rows.select(F.col(own["length"]).alias("key")), bits), "lengths")

    rows = marked(rows, own["length"], lengths, own["known"], bits)
    begin = F.xxhash64(F.col(own["length"]), F.expr(f"left(`{own['text']}`, {prefix_chars})"))
    rows = rows.withColumn(own["begin"], F.when(F.col(own["known"]), begin))
    begins = rows.where(F.col(own["known"])).select(F.col(own["begin"]).alias("key"))
    begins = stored(shared_keys(begins, bits), "beginnings")

    rows = marked(rows, own["begin"], begins, own["whole"], bits)
    digest = F.when(F.col(own["whole"]), F.unhex(F.sha2(F.col(own["text"]), 256)))
    row = stored(
        rows.select(
            F.col("doc_id").alias("id"),
            F.struct(*(value.alias(name) for name, value in carry.items()), F.lit(0).alias("_")).alias("carried"),
            digest.alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    row = row.withColumn("lot", F.pmod(F.xxhash64("row"), F.lit(LOTS)).cast("int"))

    alone = row.where("digest IS NULL").selectExpr("id", "carried", "id keep_id", "1L group_size", "true kept")
    alike = row.where("digest IS NOT NULL")
    parts = alike.groupBy("digest", "lot").agg(F.count(F.lit(1)).alias("n"), F.expr("max(struct(id, row))").alias("top"))
    groups = parts.groupBy("digest").agg(F.sum("n").alias("group_size"), F.max("top").alias("first"))
    parts = parts.select("digest", "lot").join(groups, "digest")
    found = alike.join(parts, ["digest", "lot"]).selectExpr("id", "carried", "first.id keep_id", "group_size", "row = first.row kept")
    return alone.union(found).select(
        F.col("id").alias("doc_id"), *(F.col("carried").getField(name).alias(name) for name in carry), "keep_id", "group_size", "kept"
    )
