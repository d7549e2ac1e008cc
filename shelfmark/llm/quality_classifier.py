"""Compression classifier: a text is like the labelled texts whose dictionary shrinks it more.

Two zstandard dictionaries are built, from good and from bad labelled texts. A text's score
starts from (size with the bad dictionary - size with the good one) / size of the text, summed over blocks of
``BLOCK`` bytes that are each compressed afresh, so that a long text's history does not stand in for the dictionaries; a logistic
curve, fitted to labelled texts that neither dictionary has seen, makes that a probability.

The fit reads a bounded sample: of each label at most ``SAMPLE`` texts for the dictionary and as
many for the curve, of at most ``SAMPLE_BYTES`` bytes each, taken by the hash of their ids.
The share of good labels is counted over all labels. Every whole text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import thrifty

SAMPLE = 1000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 112_640
BLOCK = 4096
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and a logistic curve; ``slope`` 0 gives every text the share of good labels."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float

    def measure(self):
        """A function from bytes to the normalised difference of the two compressed sizes."""
        pair = [
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(content),
                write_content_size=False,
                write_checksum=False,
                write_dict_id=False,
            )
            for content in (self.good, self.bad)
        ]

        def difference(text: bytes) -> float:
            blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)] or [text]
            good, bad = (sum(len(compressor.compress(block)) for block in blocks) for compressor in pair)
            return (bad - good) / max(1, len(text))

        return difference

    def probability(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.intercept, -30, 30)))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train one."""
    pieces = [text[i : i + 4096] for text in texts for i in range(0, len(text), 4096)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except zstandard.ZstdError:
        return (b"\n".join(texts) or b"\n")[:DICTIONARY_BYTES]


def _curve(x: np.ndarray, y: np.ndarray, good_share: float) -> tuple[float, float]:
    """Newton's method for a logistic curve on classes weighted to the share of good labels."""
    scale = float(x.std()) or 1.0
    design = np.column_stack([x / scale, np.ones(len(x))])
    weight = np.where(y == 1, good_share / max(1, (y == 1).sum()), (1 - good_share) / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-2 * beta
        curvature = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> CompressionModel:
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, quality`` 0 or 1).

    Labels with a null or another value are left out; of repeated labels of a document the lowest holds.
    Without texts of both labels every score is the share of good labels.
    """
    marked = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    counts = {row["quality"]: row["count"] for row in marked.groupBy("quality").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    # More ids than texts are needed, because long texts are passed over.
    chosen = [
        marked.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(3 * sample) for label in (0, 1)
    ]
    known = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    known = known.where(F.octet_length("text").between(1, sample_bytes))
    texts = [
        known.join(F.broadcast(ids), known["id"] == ids["doc_id"])
        .select("text", F.xxhash64("id").alias("at"))
        .orderBy("at", "text")
        .limit(2 * sample)
        .toPandas()["text"]
        .map(lambda text: text.encode("utf-8", "surrogatepass"))
        .tolist()
        for ids in chosen
    ]
    flat = CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))))
    if not texts[0] or not texts[1]:
        return flat
    learnt = [own[::2] for own in texts]
    held = [own[1::2] or own for own in texts]
    raw = CompressionModel(_dictionary(learnt[1]), _dictionary(learnt[0]), 1.0, 0.0)
    difference = raw.measure()
    x = np.array([difference(text) for own in held for text in own])
    y = np.repeat([0, 1], [len(own) for own in held])
    slope, intercept = _curve(x, y, share)
    return CompressionModel(raw.good, raw.bad, max(0.0, slope), intercept)


def score(text: Column, model: CompressionModel) -> Column:
    """The probability (0 to 1) that a text is good; a null text counts as empty."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        difference = model.measure() if model.slope else lambda _: 0.0
        for texts in batches:
            x = [difference(text.encode("utf-8", "surrogatepass")) if text else 0.0 for text in texts]
            yield pd.Series(model.probability(np.array(x, np.float64)))

    # pandas_udf needs the hints as types, and this module keeps them as text.
    scored = thrifty(scored)
    scored.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(scored, "double")(text.cast("string"))


def classified(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; labels of the held-out fold are not learnt from.

    The score depends on the text alone, so repeated rows and equal texts score the same. A null or
    empty text has a score too, that of no difference. Other columns are not read. An empty
    table gives an empty result.
    """
    model = fit(docs, labels.where(remainder(F.col("doc_id"), folds) != held_fold))
    return docs.select(
        "doc_id",
        (remainder(F.col("doc_id"), folds) == held_fold).alias("held_out"),
        score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
