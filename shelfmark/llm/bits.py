"""Bit sets of fixed size that tell tasks which rows may matter: a few set bits too many cost work, never a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a set: 2**17 words of 16 bytes are broadcast.
BITS = 1 << 23


def _placed(key: Column, bits: int) -> tuple[Column, Column]:
    """Word and bit of a long key in a bit set."""
    at = F.pmod(F.xxhash64(key), F.lit(bits))
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")


def bit_words(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """``word, mask``: the bits of every long ``key``; ``bits / 64`` rows at most."""
    word, bit = _placed(F.col("key"), bits)
    return keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))


def marked(rows: DataFrame, key: str, words: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``rows`` and whether the bit of their ``key`` is set; that of a null key is not. ``words`` is stored."""
    word, bit = _placed(F.col(key), bits)
    word_name, bit_name, mask = f"{name}_word", f"{name}_bit", f"{name}_mask"
    placed = rows.withColumns({word_name: F.when(F.col(key).isNotNull(), word), bit_name: bit})
    joined = placed.join(F.broadcast(words.select(F.col("word").alias(word_name), F.col("mask").alias(mask))), word_name, "left")
    return joined.withColumn(name, F.expr(f"coalesce(getbit({mask}, {bit_name}) = 1, false)")).drop(word_name, bit_name, mask)
