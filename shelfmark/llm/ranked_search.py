"""Ranked lexical search with norm buckets: the k best documents of every query, by exact integer scores.

A document is a vector of impacts over the terms that queries use, a query one of term weights, a score
their inner product. Vectors go through in the order of their length: those of the longest buckets
first, on all executors, which gives every query a score that its k-th best reaches; then the rest, in each
task again from long to short. A bucket whose greatest length times the query's is under the score already
reached is left out (Cauchy-Schwarz). Inside a bucket the rarest terms are added up from lists by
coordinate, until what the others can still add (their greatest values in the bucket, or
Cauchy-Schwarz over the rest) leaves few vectors; these are scored again, exactly, in integers.

Bounds are kept on the safe side of rounding and only vectors below the score reached go, so the
result is whole, ties included. Queries are taken in blocks of bounded size; each block is sent to
every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, whole_text

K = 10
#: Characters of query text that go to the tasks at a time; a longer query is a block by itself.
BLOCK_CHARS = 1 << 22
#: Vectors that a task orders at a time, and of one bucket; bits of a bucket's number after the binary point.
ORDERED = 1 << 14
BUCKET = 1 << 11
STEPS = 8
#: Share of the vectors, the longest ones, that are searched first.
FIRST = 1 / 32
#: Fixed values of the score.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 90
VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"

# A term is a run of letters and digits of ASCII and of all characters beyond it.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, A to Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


class Block(NamedTuple):
    """Some queries: their ids, their term numbers, and the number of each term."""

    ids: list
    queries: list[np.ndarray]
    numbers: dict[bytes, int]


def blocks_of(queries: DataFrame, block_chars: int) -> Iterator[Block]:
    """Queries in blocks of at most ``block_chars`` characters, or of one query."""
    ids, found, numbers, chars = [], [], {}, 0
    for row in queries.toLocalIterator():
        size = len(row["text"])
        if ids and chars + size > block_chars:
            yield Block(ids, found, numbers)
            ids, found, numbers, chars = [], [], {}, 0
        own = sorted({numbers.setdefault(term, len(numbers)) for term in terms_of(row["text"])})
        ids.append(row["item_id"])
        found.append(np.array(own, np.int64))
        chars += size
    if ids:
        yield Block(ids, found, numbers)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))


def _counted(numbers):
    """Texts to vectors: the terms of the block's queries and how often each occurs."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                counts = Counter(words)
                shared = sorted((known[w], counts[w]) for w in counts.keys() & known.keys())
                terms.append(np.array([t for t, _ in shared], np.int64))
                tfs.append(np.array([c for _, c in shared], np.int64))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), _lists(terms), _lists(tfs)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    return mapped


class Rows(NamedTuple):
    """Vectors of one batch: ids, lengths in terms, and all entries with their vector's number."""

    ids: pa.Array
    n: np.ndarray
    sizes: np.ndarray
    terms: np.ndarray
    tfs: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Rows:
        lists = batch.column("terms"), batch.column("tfs")
        offsets = lists[0].offsets.to_numpy()
        flat = [one.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for one in lists]
        return Rows(batch.column("doc_id"), batch.column("n").to_numpy(), np.diff(offsets), *flat)


def _frequencies(size: int):
    """In how many vectors of a task each term is, how many have a term at all, and all terms with repeats."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, words = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            rows = Rows.of(batch)
            df += np.bincount(rows.terms, minlength=size)
            docs, words = docs + int((rows.n > 0).sum()), words + int(rows.n.sum())
        term = np.concatenate([np.flatnonzero(df), [-1, -2]])
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.concatenate([df[df > 0], [docs, words]]))], ["term", "n"])

    return mapped


class Weights(NamedTuple):
    """What scores need of the corpus: documents, terms with repeats, and the weight of every term of the block."""

    docs: int
    words: int
    weight: np.ndarray

    def impacts(self, rows: Rows) -> np.ndarray:
        """The impact of every entry, in integers."""
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * rows.n * self.docs) // max(1, self.words)
        return (SCALE * rows.tfs) // (1000 * rows.tfs + SATURATION * np.repeat(m, rows.sizes))

    def values(self, terms: np.ndarray, impacts: np.ndarray) -> np.ndarray:
        """Coordinates: the impact and the root of the weight; a term of negative weight only lowers a score, so it has none."""
        return np.sqrt(np.maximum(self.weight[terms], 0)) * impacts

    def squares(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Impacts, and the squared length of every vector."""
        impacts = self.impacts(rows)
        owner = np.repeat(np.arange(len(rows.n)), rows.sizes)
        return impacts, np.bincount(owner, self.values(rows.terms, impacts) ** 2, len(rows.n))


def weights_of(vectors: DataFrame, size: int) -> Weights:
    found = vectors.mapInArrow(_frequencies(size), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {row["term"]: row["n"] for row in found.collect()}
    docs, words = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(size)
    df[list(found)] = list(found.values())
    return Weights(docs, words, np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64))


def bucket_of(squares: np.ndarray) -> np.ndarray:
    """The number of a vector's bucket: the logarithm of its length in steps, -1 for no length."""
    return np.where(squares > 0, np.floor(STEPS / 2 * np.log2(np.maximum(squares, 1))), -1).astype(np.int64)


def _histogram(weights):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, factors = Counter(), Weights(*weights.value)
        for batch in batches:
            numbers, n = np.unique(bucket_of(factors.squares(Rows.of(batch))[1]), return_counts=True)
            counts.update(dict(zip(numbers.tolist(), n.tolist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["bucket", "n"])

    return mapped


class Chunk:
    """Vectors in the order of their length, longest first, with entries by vector."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, squares: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: Weights) -> None:
        order = np.argsort(-squares, kind="stable")
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        self.ids, self.known, self.squares, self.sizes = ids[order], known[order], squares[order], sizes[order]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        take = np.repeat(starts[order] - self.starts[:-1], self.sizes) + np.arange(self.starts[-1])
        self.terms, self.impacts = terms[take], impacts[take]
        self.values = weights.values(self.terms, self.impacts)
        self.weights = weights

    def buckets(self, most: int) -> Iterator[tuple[int, int]]:
        """Runs of vectors of the same bucket number, cut at ``most``."""
        numbers = bucket_of(self.squares)
        edges = np.flatnonzero(np.diff(numbers)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)], strict=True):
            for start in range(a, b, most):
                yield start, min(start + most, b)


class Lists:
    """The entries of one bucket in lists by coordinate."""

    def __init__(self, chunk: Chunk, start: int, end: int) -> None:
        a, b = chunk.starts[start], chunk.starts[end]
        order = np.argsort(chunk.terms[a:b], kind="stable")
        owner = np.repeat(np.arange(end - start), chunk.sizes[start:end])
        self.owner, self.values, self.impacts = owner[order], chunk.values[a:b][order], chunk.impacts[a:b][order]
        size = len(chunk.weights.weight)
        self.at = np.concatenate([[0], np.cumsum(np.bincount(chunk.terms[a:b], minlength=size))])
        self.greatest = np.zeros(size)
        np.maximum.at(self.greatest, chunk.terms[a:b], chunk.values[a:b])
        self.length, self.n = float(np.sqrt(chunk.squares[start])), end - start
        self.weight = chunk.weights.weight

    def survivors(self, terms: np.ndarray, least: float) -> np.ndarray:
        """Vectors that may score ``least`` or more, ``terms`` ordered by falling weight."""
        roots = np.sqrt(np.maximum(self.weight[terms], 0))
        # What the terms from each position on can add: by coordinate, and by length.
        by_greatest = np.concatenate([np.cumsum((roots * self.greatest[terms])[::-1])[::-1], [0]])
        by_length = np.concatenate([np.sqrt(np.cumsum((roots**2)[::-1])[::-1]), [0]]) * self.length
        rest = np.minimum(by_greatest, by_length)
        if rest[0] < least:
            return np.zeros(0, np.int64)
        sums = np.zeros(self.n)
        for position, term in enumerate(terms.tolist()):
            if rest[position] < least:
                # Only vectors seen by now can reach it; the others' terms need not be walked when few are left.
                left = np.flatnonzero(sums + rest[position] >= least)
                if len(left) * 8 <= self.n:
                    return left
            a, b = self.at[term], self.at[term + 1]
            if b > a and roots[position] > 0:
                sums[self.owner[a:b]] += roots[position] * self.values[a:b]
        return np.flatnonzero(sums >= least) if least > 0 else np.flatnonzero(sums > 0)

    def scores(self, terms: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact scores of some vectors of the bucket."""
        place = np.full(self.n, -1)
        place[vectors] = np.arange(len(vectors))
        found = np.zeros(len(vectors), np.int64)
        for term in terms.tolist():
            a, b = self.at[term], self.at[term + 1]
            if b > a:
                at = place[self.owner[a:b]]
                inside = at >= 0
                found[at[inside]] += self.weight[term] * self.impacts[a:b][inside]
        return found


class Best:
    """The k best of every query as far as seen: by score, then by id, a null one last."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n)]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        enough = scores >= self.least[query]
        if not enough.any():
            return
        scores, ids, known = (np.concatenate([old, new[enough]]) for old, new in zip(self.rows[query], (scores, ids, known), strict=True))
        first = np.lexsort((ids, ~known, -scores))[: self.k]
        self.rows[query] = scores[first], ids[first], known[first]
        if len(first) == self.k:
            self.least[query] = max(self.least[query], int(scores[first[-1]]))


def _searched(block, weights, least, k: int, low: int, high: int, ordered: int, most: int):
    """The k best of a task's vectors whose bucket number is in ``low..high``, for every query of the block."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, factors = block.value, Weights(*weights.value)
        # A negative weight can only be part of an exact score; bounds take the terms from rare to common.
        queries = [terms[np.argsort(-factors.weight[terms], kind="stable")] for terms in given]
        lengths = np.array([np.sqrt(np.maximum(factors.weight[terms], 0).sum()) for terms in queries])
        best = Best(len(queries), k, least.value)

        def search(parts: list[tuple]) -> None:
            chunk = Chunk(*(np.concatenate(part) for part in zip(*parts, strict=True)), factors)
            for start, end in chunk.buckets(most):
                reach = lengths * np.sqrt(chunk.squares[start]) * (1 + 1e-9) + 1
                wanted = np.flatnonzero(reach >= best.least)
                if not len(wanted):
                    continue
                lists = Lists(chunk, start, end)
                for query in wanted.tolist():
                    # One below: what a double may round off.
                    found = lists.survivors(queries[query], best.least[query] * (1 - 1e-9) - 1)
                    if len(found):
                        scores = lists.scores(queries[query], found)
                        at = start + found
                        best.add(query, scores, chunk.ids[at], chunk.known[at])

        parts, held = [], 0
        for batch in batches:
            rows = Rows.of(batch)
            impacts, squares = factors.squares(rows)
            numbers = bucket_of(squares)
            chosen = (numbers >= low) & (numbers <= high) & (numbers >= 0)
            entries = np.repeat(chosen, rows.sizes)
            known = ~np.array(rows.ids.is_null())
            ids = rows.ids.fill_null(0).to_numpy()
            parts.append((ids[chosen], known[chosen], squares[chosen], rows.sizes[chosen], rows.terms[entries], impacts[entries]))
            held += int(chosen.sum())
            if held >= ordered:
                search(parts)
                parts, held = [], 0
        if held:
            search(parts)
        query = np.repeat(np.arange(len(best.rows)), [len(scores) for scores, _, _ in best.rows])
        scores, ids, known = (np.concatenate(part) if part else np.zeros(0) for part in zip(*best.rows, strict=True))
        columns = [pa.array(query, pa.int64()), pa.array(ids, pa.int64(), mask=~known.astype(bool)), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    return mapped


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_ranked(docs: DataFrame, block: Block, k: int, ordered: int, most: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    numbers, queries = context.broadcast(block.numbers), context.broadcast(block.queries)
    vectors = stored(docs.mapInArrow(_counted(numbers), VECTORS), "vectors")
    # A plain tuple: what is broadcast names no class, so executors need no copy of this module.
    weights = context.broadcast(tuple(weights_of(vectors, len(block.numbers))))
    sizes = vectors.mapInArrow(_histogram(weights), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    sizes = sorted(((row["bucket"], row["n"]) for row in sizes.collect()), reverse=True)
    total, seen, cut = sum(n for _, n in sizes), 0, 0
    for cut, n in sizes:
        seen += n
        if seen >= FIRST * total:
            break

    def search(low: int, high: int, least: np.ndarray) -> DataFrame:
        searched = _searched(queries, weights, context.broadcast(least), k, low, high, ordered, most)
        return stored(_best(vectors.mapInArrow(searched, "query long, doc_id long, score long"), k), "best")

    # Every score in the result is 1 at least.
    least = np.ones(len(block.ids), np.int64)
    first = search(cut, 1 << 40, least)
    for row in first.where(F.col("rank") == k).collect():
        least[row["query"]] = row["score"]
    second = search(0, cut - 1, least)
    names = docs.sparkSession.createDataFrame(list(enumerate(block.ids)), "query long, item_id long")
    return _best(first.union(second).drop("rank"), k).join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, k: int = K, block_chars: int = BLOCK_CHARS, ordered: int = ORDERED, most: int = BUCKET) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 of every row of ``queries``.

    ``docs`` has ``doc_id, text``, ``queries`` ``item_id, text``. A null or empty text has no terms, so it is found by none
    and finds none. Equal scores go by ascending doc_id, a null one last. Rows that repeat a doc_id are documents
    of their own, rows that repeat an item_id queries of their own. An empty table on either side gives
    an empty result; further columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text"))
    found = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks_of(asked, block_chars):
        found = found.union(stored(_block_ranked(rows, block, k, ordered, most), "ranked"))
    return found
