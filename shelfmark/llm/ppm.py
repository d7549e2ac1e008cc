"""LM scoring by partial matching: byte contexts, escapes, symbol exclusion.

The contexts are pretrained on the whole training part. A six-byte gram's last byte is a symbol, those before it
a context of order 5, and lower orders are sums of higher ones. In a context with T counts of D symbols a symbol seen
n times has the probability (2n - 1) / 2T and the escape D / 2T; after an escape the next shorter context speaks
about the symbols not seen so far only, and in the end all bytes left are equally likely (PPM, method D,
with exclusion). A text's end is one more symbol, a zero byte.

No context is dropped. A batch of texts sends each of its distinct grams once, with its count in training texts, to the
bucket of the gram's last three context bytes; there stand all longer contexts with that ending, so the bucket adds up,
finds the exact code length of every gram and answers every batch. Counts of order 2 and less, at most 2**24, are
broadcast.

Beside it stands a word baseline: add-one unigram counts of the training words. Words are counted by
batches: a batch sends each of its distinct words once, to the bucket of the word's hash; buckets add
up and answer every batch. No task sees a word more than once for each batch, and no vocabulary is gathered.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import groupby
from math import log10

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, whole_text

ORDER = 5
#: Words whose counts travel together; it bounds memory and leaves the result as it is.
BATCH_TOKENS = 1_500_000
#: Bytes of texts that travel together; a longer text is a batch by itself.
BATCH_BYTES = 8 << 20
#: Bytes of texts counted and scored at a time.
GRAMS_AT_ONCE = 1 << 21
SCORED_AT_ONCE = 1 << 16
#: Parts in which counts of order 2 are added up.
LOW_PARTS = 16
#: Bytes of stored input for one bucket of words.
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1 << 17
START = b"\0" * ORDER
END = b"\0"


def _grams(data: bytes, size: int = ORDER + 1) -> np.ndarray:
    """The grams of ``data`` as numbers, one for each byte after the first ``size - 1``."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    found = a[: len(a) - size + 1]
    for i in range(1, size):
        found = (found << np.uint64(8)) | a[i : len(a) - size + 1 + i]
    return found


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The grams of texts, about ``GRAMS_AT_ONCE`` at a time, and for each array the number of its text."""
    owners, found, size = [], [], 0
    for i, text in enumerate(texts):
        data = START + text + END
        for at in range(0, len(data) - ORDER, GRAMS_AT_ONCE):
            found.append(_grams(data[at : at + GRAMS_AT_ONCE + ORDER]).view(np.int64))
            owners.append(i)
            size += len(found[-1])
            if size >= GRAMS_AT_ONCE:
                yield owners, found
                owners, found, size = [], [], 0
    if found:
        yield owners, found


def _counted(texts: list[bytes], trained: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of texts, upwards, and how often each is in the ``trained`` ones."""
    parts = []
    for learnt in (True, False):
        for _, grams in _chunks([text for text, own in zip(texts, trained, strict=True) if own == learnt]):
            codes, counts = np.unique(np.concatenate(grams), return_counts=True)
            parts.append((codes, counts if learnt else np.zeros(len(codes), np.int64)))
    return _merged(parts)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(columns) for columns in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[starts], np.add.reduceat(counts, starts)


class Level:
    """Counts of one order: ``codes`` (a context's bytes and a symbol), upwards, and sums by ``contexts``."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes, self.counts = codes, counts.astype(np.float64)
        contexts = codes >> 8
        self.starts = np.flatnonzero(np.diff(contexts, prepend=-1))
        self.contexts = contexts[self.starts]
        self.total = self.sums(self.counts)
        self.distinct = np.diff(np.append(self.starts, len(codes)))

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(values) else np.zeros(0)

    def shorter(self, order: int) -> Level:
        """The counts of ``order``, by leaving out a context's first byte."""
        return Level(*_merged([(_last(self.codes, order + 1), self.counts)]) if len(self.codes) else (self.codes, self.counts))


def _last(codes: np.ndarray, size: int) -> np.ndarray:
    return codes & ((1 << 8 * size) - 1)


def _places(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each value is ``among`` ascending ones, -1 where it is not."""
    if not len(among):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def _after(longer: Level, level: Level, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``level`` says behind an escape from each context of ``longer``: counts and symbols that are left, and the halves.

    Symbols seen in a context are seen in its suffixes too, so the longer context alone tells which are excluded.
    """
    own = _places(_last(longer.contexts, order), level.contexts)
    seen = longer.sums(level.counts[_places(_last(longer.codes, order + 1), level.codes)])
    distinct = level.distinct[own] - longer.distinct
    return level.total[own] - seen, distinct, np.where(distinct == 256 - longer.distinct, 0, 0.5)


def code_lengths(grams: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of the probability of each gram's symbol; ``levels`` are the counts of orders 0 to ``ORDER``."""
    found, left = np.zeros(len(grams)), np.ones(len(grams))
    done = np.zeros(len(grams), bool)
    before = np.full(len(grams), -1)
    for order in range(ORDER, -1, -1):
        level = levels[order]
        own = _places(_last(grams >> 8, order), level.contexts)
        if not len(level.codes):
            continue
        # A context that nothing longer was seen of speaks about all its symbols.
        total, distinct = level.total[own], level.distinct[own]
        halves = np.where(distinct == 256, 0, 0.5)
        if order < ORDER and len(levels[order + 1].codes):
            follows = before >= 0
            after = _after(levels[order + 1], level, order)
            total, distinct, halves = (np.where(follows, a[before], b) for a, b in zip(after, (total, distinct, halves), strict=True))
        total = np.maximum(total, 1)
        at = _places(_last(grams, order + 1), level.codes)
        now = ~done & (at >= 0)
        found = np.where(now, left * (level.counts[at] - halves) / total, found)
        done |= now
        # The last symbols that are open need no escape behind them; a context that says nothing is passed over.
        left = np.where((own >= 0) & (distinct > 0), left * halves * distinct / total, left)
        before = own
    rest = 256 - len(levels[0].codes)
    return np.log10(np.where(done, found, left / max(1, rest)))


def _text(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


_GATHERED = "kind string, batch string, bucket int, a binary, b binary"


def _packed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpacked(data: bytes, kind: str | None = None):
    raw = zstandard.ZstdDecompressor().decompress(data)
    return raw if kind is None else np.frombuffer(raw, kind)


def _steps(codes: np.ndarray) -> bytes:
    return _packed(np.diff(codes, prepend=0).astype("<i8").tobytes())


def _codes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<i8"))


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of the last three bytes of a gram's context."""
    mixed = _last(grams >> 8, 3).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _dealt(kind: str, name: str, of: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """A row for each number in ``of`` with its codes, upwards, and their counts."""
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    return [
        (kind, name, int(of[own[0]]), _steps(codes[own]), _packed(counts[own].astype("<i8").tobytes()))
        for own in np.split(order, cuts)
        if len(own)
    ]


def _by_bucket(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word, and the order in which a batch sends its words."""
    of = np.fromiter((zlib.crc32(word) % buckets for word in words), np.int64, len(words))
    return of, np.argsort(of, kind="stable")


def _gathered(folds: int, held_fold: int, buckets: int):
    """Batches: their texts, their grams and words by bucket, and the word numbers of their documents."""

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers: dict[bytes, int] = {b"": 0}
        trained, docs, n_tokens = array("I"), [], 0
        texts: list[bytes] = []
        learnt: list[bool] = []
        size = 0

        def grams(name: str) -> list[tuple]:
            codes, counts = _counted(texts, learnt)
            rows = _dealt("grams", name, _bucket(codes, buckets), codes, counts)
            known = counts > 0
            if known.any():
                low = Level(*_merged([(_last(codes[known], 3), counts[known])]))
                rows += _dealt("low", name, low.codes % LOW_PARTS, low.codes, low.counts)
            sizes = np.array([len(text) for text in texts], "<i8")
            return [*rows, ("texts", name, -1, _packed(b"".join(texts)), _packed(sizes.tobytes()))]

        def batch() -> list[tuple]:
            nonlocal numbers, trained, docs, size, n_tokens
            if not docs:
                return []
            name, words = uuid.uuid4().hex, list(numbers)
            of, order = _by_bucket(words, buckets)
            counts = np.bincount(np.frombuffer(trained, np.uint32), minlength=len(words)) if trained else np.zeros(len(words), np.int64)
            ends = np.append(np.flatnonzero(np.diff(of[order])) + 1, len(words))
            rows, start = [], 0
            for end in ends.tolist():
                own = order[start:end]
                text = b"\n".join([words[i] for i in own])
                rows.append(("words", name, int(of[own[0]]), _packed(text), _packed(counts[own].astype("<u4").tobytes())))
                start = end
            rows.append(("docs", name, -1, _packed(json.dumps(docs).encode()), None))
            numbers, trained, docs, n_tokens = {b"": 0}, array("I"), [], 0
            rows += grams(name)
            texts.clear()
            learnt.clear()
            size = 0
            return rows

        for frame in frames:
            for doc_id, text in zip(frame["id"], frame["text"], strict=True):
                data = _text(text)
                if docs and size + len(data) > BATCH_BYTES:
                    yield pd.DataFrame(batch(), columns=["kind", "batch", "bucket", "a", "b"])
                words = data.lower().split()
                own = array("I", [numbers.setdefault(word, len(numbers)) for word in words])
                own.append(0)
                n_tokens += len(own)
                docs.append(doc_id)
                texts.append(data)
                size += len(data)
                learnt.append(zlib.crc32((doc_id or "").encode()) % folds != held_fold)
                if learnt[-1]:
                    trained.extend(own)
                if n_tokens >= BATCH_TOKENS:
                    yield pd.DataFrame(batch(), columns=["kind", "batch", "bucket", "a", "b"])
        yield pd.DataFrame(batch(), columns=["kind", "batch", "bucket", "a", "b"])

    return mapped


def _summed(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes of rows from ``_dealt`` and their sums, a few rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for codes, counts in zip(rows["a"], rows["b"], strict=True):
        held.append((_codes(codes), _unpacked(counts, "<i8")))
        if sum(len(c) for c, _ in held[1:]) > GRAMS_AT_ONCE + len(held[0][0]):
            held = [_merged(held)]
    return _merged(held)


def _low_counts(rows: pd.DataFrame) -> pd.DataFrame:
    codes, counts = _summed(rows)
    return pd.DataFrame({"a": [_steps(codes)], "b": [_packed(counts.astype("<i8").tobytes())]})


def _short(lengths: np.ndarray) -> bytes:
    """Code lengths as their distinct values and the number of each: a bucket has few of them."""
    values, at = np.unique(lengths, return_inverse=True)
    kind = "<u2" if len(values) <= 1 << 16 else "<u4"
    return _packed(np.array([len(values)], "<i8").tobytes() + values.astype("<f8").tobytes() + at.astype(kind).tobytes())


def _lengths(short: bytes) -> np.ndarray:
    raw = _unpacked(short)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    return np.frombuffer(raw, "<f8", n, 8)[np.frombuffer(raw, "<u2" if n <= 1 << 16 else "<u4", offset=8 + 8 * n)]


def _measured(low):
    """Sums of one bucket of grams, and for each batch its grams with their code lengths."""

    def answered(rows: pd.DataFrame) -> pd.DataFrame:
        codes, counts = _summed(rows)
        known = counts > 0
        five = Level(codes[known], counts[known])
        four = five.shorter(4)
        lengths = code_lengths(codes, [*low.value, four.shorter(3), four, five])
        found = [_short(lengths[np.searchsorted(codes, _codes(own))]) for own in rows["a"]]
        return pd.DataFrame({"batch": rows["batch"], "bucket": rows["bucket"], "a": rows["a"], "b": found})

    return answered


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of one bucket: for each batch the counts of its words; and the bucket's tokens and distinct words."""
    totals: dict[bytes, int] = {}
    batches = []
    for name, words, counts in zip(rows["batch"], rows["a"], rows["b"], strict=True):
        own = _unpacked(words).split(b"\n")
        batches.append((name, own))
        for word, n in zip(own, _unpacked(counts, "<u4").tolist(), strict=True):
            totals[word] = totals.get(word, 0) + n
    out = [(name, _packed(np.fromiter(map(totals.__getitem__, own), "<i8", len(own)).tobytes()), None, None) for name, own in batches]
    out.append((None, None, sum(totals.values()), sum(n > 0 for n in totals.values())))
    found = pd.DataFrame(out, columns=["batch", "counts", "tokens", "words"], dtype=object)
    found.insert(1, "bucket", int(rows["bucket"].iloc[0]))
    return found


def _scores(texts: list[bytes], grams: pd.Index, lengths: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text with its end."""
    out = np.zeros(len(texts))
    for owners, found in _chunks(texts):
        values = lengths[grams.get_indexer(np.concatenate(found))]
        start = 0
        for owner, own in zip(owners, found, strict=True):
            # A sum of its own for each text, so that equal texts score the same.
            out[owner] += values[start : start + len(own)].sum()
            start += len(own)
    return out


def _based(buckets: int):
    """The results of a batch: rows come sorted by batch and part, ids, sums of the words, texts, code lengths of the grams.

    What a text can tell again, its words and their numbers, is not sent beside it.
    """

    def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of tokens of each text, and the place of every token's word among the sums."""
        numbers: dict[bytes, int] = {b"": 0}
        tokens, sizes = array("I"), []
        for text in texts:
            words = text.lower().split()
            tokens.extend([numbers.setdefault(word, len(numbers)) for word in words])
            tokens.append(0)
            sizes.append(len(words) + 1)
        _, order = _by_bucket(list(numbers), buckets)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return np.array(sizes, np.int64), rank[np.frombuffer(tokens, np.uint32)]

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for frame in frames:
                yield from zip(frame["batch"], frame["part"], frame["a"], frame["b"], strict=True)

        for _, group in groupby(rows(), key=lambda row: row[0]):
            parts: dict[int, list[tuple]] = {part: [] for part in range(4)}
            for _, part, a, b in group:
                parts[part].append((a, b))
            ((head, _),), answers, ((joined, lengths),), measured = parts.values()
            docs = json.loads(_unpacked(head))
            whole, ends = _unpacked(joined), np.cumsum(_unpacked(lengths, "<i8")).tolist()
            texts = [whole[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            sizes, tokens = tokens_of(texts)
            counts = np.concatenate([_unpacked(a, "<i8") for a, _ in answers])
            starts = np.cumsum(sizes) - sizes
            grams = pd.Index(np.concatenate([_codes(a) for a, _ in measured]))
            yield pd.DataFrame(
                {
                    "id": pd.Series(docs, dtype=object),
                    "n_tokens": sizes,
                    "n_known": np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts),
                    "logs": np.add.reduceat(np.log10(counts + 1.0)[tokens], starts),
                    "score": _scores(texts, grams, np.concatenate([_lengths(b) for _, b in measured])),
                }
            )

    return mapped


def scored(docs: DataFrame, folds: int = 7, held_fold: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row (``doc_id, text``).

    Rows whose crc32 of the id as text is not ``held_fold`` modulo ``folds`` are learnt from; a null id counts as an empty
    text. A null text is an empty one: its only token is the end. Repeated rows are learnt from as often as they
    stand there and score the same. Without training rows every byte is equally likely. Other columns
    are not read, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A source that cannot tell its size reports more than any has; it gets as many buckets as a shuffle.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < 1 << 60:
        buckets = max(buckets, min(MAX_BUCKETS, -(-size // BUCKET_BYTES)))
    texts = docs.select(F.col("doc_id").cast("string").alias("id"), whole_text().alias("text"))
    gathered = stored(texts.mapInPandas(_gathered(folds, held_fold, buckets), _GATHERED), "gathered")
    of = lambda kind: gathered.where(F.col("kind") == kind).select("batch", "bucket", "a", "b")

    counts = of("low").groupBy("bucket").applyInPandas(_low_counts, "a binary, b binary").toPandas()
    two = Level(*_summed(counts)) if len(counts) else Level(np.zeros(0, np.int64), np.zeros(0, np.int64))
    one = two.shorter(1)
    low = spark.sparkContext.broadcast([one.shorter(0), one, two])
    measured = of("grams").groupBy("bucket").applyInPandas(_measured(low), "batch string, bucket int, a binary, b binary")

    answers = of("words").groupBy("bucket").applyInPandas(_answered, "batch string, bucket int, counts binary, tokens long, words long")
    answers = stored(answers, "answers")
    tokens, words = answers.agg(F.sum("tokens"), F.sum("words")).first()
    tokens, words = tokens or 0, words or 0
    answers = answers.where("batch IS NOT NULL").selectExpr("batch", "bucket", "counts a", "cast(null as binary) b")
    parts = [part.withColumn("part", F.lit(i)) for i, part in enumerate((of("docs"), answers, of("texts"), measured))]
    both = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    based = both.repartition("batch").sortWithinPartitions("batch", "part", "bucket")
    based = based.mapInPandas(_based(buckets), "id string, n_tokens long, n_known long, logs double, score double")
    return based.select(
        F.col("id").cast("long").alias("doc_id"),
        (F.pmod(F.crc32(F.coalesce("id", F.lit(""))), F.lit(folds)) == held_fold).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(log10(tokens + words + 1))).alias("base_score"),
        "score",
    )
