"""Fuzzy line deduplication by MinHash: one line of every group of like lines stays.

A line is what stands between two newlines, lower-cased and with its white space
collapsed. Its signature has one value for each of ``BANDS * ROWS`` bins over its character
shingles (one-permutation MinHash; an empty bin borrows from the next one that is not).
Lines that agree in a band are candidates: at a similarity of 0.8 they meet with a
probability of 0.991, at 0.85 of 0.9997. Every candidate link is verified by the exact Jaccard
similarity of the shingle sets, links go to distributed union-find, and the first line of a
component stays: that of the smallest doc_id, then of the smallest line number.

Each distinct line is signed once for a task and compared once: equal lines meet in a
combinable count, never in a group. Band keys are dealt out in blocks, a row for each range of keys, and of a key that many
lines of a block have only the lowest and the highest line are sent; a bit set of fixed size then finds the lines of the keys that two lines share. A bucket of a band above ``tile`` lines is cut into
tiles. First every tile is compared by itself and with the bucket's lowest line; then only the lines outside the
bucket's largest component meet each other and that component, in pairs of tiles. Within a tile, or a pair, a line is compared
with components, until one member of each is like it, so a dense bucket costs about one comparison, and is sent about once, for each line. Most pairs that are not alike are told
apart by bitmaps of their shingles, the others are compared by the shingles' 64-bit hashes, and near the threshold by the
shingles themselves. Buckets of the same
lines in several bands are compared once. Texts are fetched for candidates only: a bit set of
fixed size tells the tasks which lines to send, and a join by hash takes out its false hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.bits import bit_words, marked
from shelfmark.llm.common import fresh, give_back, stored, thrifty
from shelfmark.llm.components import UNITED_AT_ONCE, Forest, components

SHINGLE_CHARS = 7
SIMILARITY = 0.8
BANDS = 12
ROWS = 5
TILE = 512
#: Bits of each of the sets that say which band keys are shared and which lines are candidates: 8 MB at any size of the corpus.
HINT_BITS = 1 << 26
#: Characters signed at a time, lines sent on at a time and lines a task remembers; they bound memory, not results.
SIGNED_AT_ONCE = 1 << 15
LINES_AT_ONCE = 1 << 14
REMEMBERED = 1 << 17
#: Band keys that a task deals out at a time, and about how many different ones make a part of them; they bound memory, not results.
BUCKETS_AT_ONCE = 1 << 18
BUCKETS_OF_PART = 1 << 16
#: Characters of lines that a task holds because they may come again.
HELD_CHARS = 1 << 20
#: Cells of the bitmap of a line's shingles, and pairs found unlike that a task remembers.
CELLS = 2048
REMEMBERED_PAIRS = 1 << 17
#: What the lines of one comparison have in common.
GROUP = ("low", "bucket", "slot_a", "slot_b")

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


#: What a text holds where one of its lines has white space to collapse; the white space outside ASCII.
_UNEVEN = ("  ", " \n", "\n ", "\t", "\r", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f")
_WIDE = tuple(chr(c) for c in range(0x80, 0x3001) if chr(c).isspace())


def _apart(text: str) -> bool:
    """Whether spaces and newlines stand apart and no other control character is in the text; it then holds nothing of ``_UNEVEN``."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    low = data <= 32
    return not np.count_nonzero(low[1:] & low[:-1]) and np.count_nonzero(data < 32) == text.count("\n")


def normalised_lines(text: str) -> list[str]:
    """``normalised`` of every line; a text whose lines stand as they are is lower-cased whole."""
    lowered = text.lower()
    even = lowered[:1] != " " and lowered[-1:] != " " and (_apart(lowered) or not any(part in lowered for part in _UNEVEN))
    if even and (lowered.isascii() or not any(space in lowered for space in _WIDE)):
        return lowered.split("\n")
    return [" ".join(line.split()) for line in lowered.split("\n")]


def line_hash(line: str) -> int:
    """The signed 64-bit hash of a normalised line."""
    h = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
    return h if h < 1 << 63 else h - (1 << 64)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(30))
    values *= _MIX_A
    values ^= values >> np.uint64(27)
    values *= _MIX_B
    values ^= values >> np.uint64(31)
    return values


def _shingle_hashes(lines: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every line's shingles, and the number of each line; a shorter line is one shingle."""
    pad = "\0" * size
    chars = np.frombuffer(pad.join([*lines, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    hashes = _windows(chars, size)
    # A line is followed by as many pads as a shingle is long; windows that begin in them, or that reach
    # into them from a line that is long enough, are not shingles.
    counts = np.maximum(lengths - size + 1, 1)
    runs = np.column_stack([counts, lengths + size - counts]).ravel()
    inside = np.repeat(np.tile([True, False], len(lines)), runs)[: len(hashes)]
    return _mixed(hashes[inside]), np.repeat(np.arange(len(lines)), counts)


def _windows(chars: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``size`` characters, from those of windows of powers of two."""
    power, width, done, found = chars, 1, 0, None
    factor = int(_MULTIPLIER)
    while True:
        if size & width:
            if found is None:
                found = power
            else:
                found = found[: len(power) - done] * np.uint64(pow(factor, width, 1 << 64))
                found += power[done:][: len(found)]
            done += width
        if 2 * width > size:
            return found[: len(chars) - size + 1]
        wider = power[:-width] * np.uint64(pow(factor, width, 1 << 64))
        wider += power[width:]
        power, width = wider, 2 * width


def shingle_set(line: str, size: int = SHINGLE_CHARS) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def bands_of(lines: list[str], size: int = SHINGLE_CHARS, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """Band keys, one row of ``bands`` longs for each normalised line."""
    bins = bands * rows
    hashes, owner = _shingle_hashes(lines, size)
    cell = hashes >> np.uint64(32)
    cell *= np.uint64(bins)
    cell >>= np.uint64(32)
    cell = cell.view(np.int64)
    cell += owner * bins
    least = np.full(len(lines) * bins, _EMPTY)
    np.minimum.at(least, cell, hashes)
    least = least.reshape(len(lines), bins)
    gaps = np.flatnonzero((least == _EMPTY).any(axis=1))
    if len(gaps):
        least[gaps] = _borrowed(least[gaps])
    values = np.ascontiguousarray(least.reshape(len(lines), bands, rows).transpose(2, 0, 1))
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(lines), 1))
    for row in values:
        keys *= _MULTIPLIER
        keys += row
        keys = _mixed(keys)
    return keys.view(np.int64)


def _borrowed(least: np.ndarray) -> np.ndarray:
    """Every bin's value, an empty one's from the next bin that is not, going round; how far it is becomes part of the value."""
    bins = least.shape[1]
    at = np.where(least == _EMPTY, 4 * bins, np.arange(bins))
    at = np.concatenate([at, at + bins], axis=1)[:, ::-1]
    source = np.minimum.accumulate(at, axis=1)[:, ::-1][:, :bins]
    away = (source - np.arange(bins)).astype(np.uint64)
    return np.take_along_axis(least, source % bins, axis=1) + away * _MULTIPLIER


def _signed(size: int, bands: int, rows: int):
    def signed(seen: set[int], texts: Iterator[tuple], kind) -> pd.DataFrame:
        """The distinct lines of the next documents, until they are ``LINES_AT_ONCE``."""
        ids, numbers, hashes, at, fresh, chars, repeats = [], [], [], [], [], 0, []
        keys: list[bytes] = []

        def sign() -> None:
            block = bands_of(fresh, size, bands, rows).tobytes()
            keys.extend(block[i : i + 8 * bands] for i in range(0, len(block), 8 * bands))

        for doc_id, text in texts:
            own: dict[int, int] = {}
            start = len(ids)
            lines = normalised_lines(text)
            for number, line in enumerate(lines):
                if line:
                    h = line_hash(line)
                    if own.setdefault(h, number) != number:
                        repeats.append(start)
            for i, (h, number) in enumerate(own.items(), start):
                if h not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(h)
                    at.append(i)
                    fresh.append(lines[number])
                    chars += len(lines[number])
                    if chars >= SIGNED_AT_ONCE:
                        sign()
                        fresh, chars = [], 0
            ids += [doc_id] * len(own)
            numbers += own.values()
            hashes += own
            if len(ids) >= LINES_AT_ONCE:
                break
        if fresh:
            sign()
        column = np.full(len(ids), None, object)
        column[at] = keys
        # On a document's first row: whether one of its lines comes again in it.
        again = np.zeros(len(ids), bool)
        again[repeats] = True
        return pd.DataFrame(
            {"id": pd.Series(ids, dtype=kind), "line_no": np.array(numbers, np.int64), "h": np.array(hashes, np.int64), "bands": column, "again": again}
        )

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for frame in frames:
            texts = ((doc_id, text) for doc_id, text in zip(frame["id"].tolist(), frame["text"], strict=True) if text)
            while len(found := signed(seen, texts, frame["id"].dtype)):
                yield found

    return mapped


def _signed_batches(size: int, bands: int, rows: int):
    """``_signed`` over Arrow batches."""
    signed = _signed(size, bands, rows)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in signed(batch.to_pandas() for batch in batches):
            columns = [pa.array(found[name].to_numpy(), pa.binary() if name == "bands" else None) for name in found]
            yield pa.RecordBatch.from_arrays(columns, names=list(found))

    return mapped


def _longs(column: pa.Array) -> np.ndarray:
    """The longs that the values of a binary column hold, one value's after the other's."""
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = column.buffers()[2]
    return np.frombuffer(data, np.int64, (offsets[-1] - offsets[0]) // 8, offsets[0]) if len(column) and data is not None else np.zeros(0, np.int64)


def _in_bands(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``bucket, h``: every band key of every line of ``h, bands``, in the order of the lines."""
    buckets = _longs(batch.column("bands"))
    return buckets, np.repeat(batch.column("h").to_numpy(), len(buckets) // max(1, len(batch)))


def _in_order(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """``bucket, h`` in the order of the buckets; of a bucket that comes often the lowest and the highest line are left."""
    buckets, h = (np.concatenate(column) for column in zip(*pairs, strict=True))
    order = np.argsort(buckets)
    buckets, h = buckets[order], h[order]
    first = np.append(True, buckets[1:] != buckets[:-1])
    if first.all():
        return buckets, h
    starts = np.flatnonzero(first)
    last = np.append(first[1:], True)
    low, high = np.minimum.reduceat(h, starts), np.maximum.reduceat(h, starts)
    h[last] = high
    h[first] = low
    keep = first | last
    return buckets[keep], h[keep]


def _dealt_buckets(parts: int):
    """Batches of ``h, bands`` to ``part, pairs``: a row for each range of band keys, with the bytes of their ``bucket, h``."""

    def rows(held: list[tuple]) -> pa.RecordBatch:
        buckets, h = _in_order(held)
        # Ranges of equal width, numbered from -parts / 2.
        part = ((buckets >> 32) * parts) >> 32
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        ends = (np.append(starts, len(part)) * 16).astype(np.int32)
        pairs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.column_stack([buckets, h]))])
        return pa.RecordBatch.from_arrays([pa.array(part[starts]), pairs], names=["part", "pairs"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_in_bands(batch))
            n += len(held[-1][0])
            if n >= BUCKETS_AT_ONCE:
                yield rows(held)
                held, n = [], 0
        if n:
            yield rows(held)

    return mapped


def _met_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket``, of rows in the order of their parts: those that hold different lines."""

    def met(held: list[tuple]) -> pa.RecordBatch:
        buckets, h = _in_order(held)
        two = (buckets[1:] == buckets[:-1]) & (h[1:] != h[:-1])
        return pa.RecordBatch.from_arrays([pa.array(buckets[1:][two])], names=["bucket"])

    at, held, n = None, [], 0
    for batch in batches:
        for part, pairs in zip(batch.column("part").to_pylist(), batch.column("pairs").to_pylist(), strict=True):
            if held and part != at:
                yield met(held)
                held, n = [], 0
            at = part
            held.append(tuple(np.frombuffer(pairs, np.int64).reshape(-1, 2).T))
            n += len(held[-1][0])
            if n >= 2 * BUCKETS_AT_ONCE:
                # Many lines of few buckets: their ends are enough.
                held = [_in_order(held)]
                n = 0
    if held:
        yield met(held)


def _shared_buckets(banded: DataFrame, part: int = BUCKETS_OF_PART) -> DataFrame:
    """``bucket``: the band keys that two different lines have. A task holds the buckets of one part at a time."""
    keys = banded.selectExpr("sum(length(bands)) div 8 n").first().n or 0
    parts = -(-keys // part) or 1
    dealt = banded.mapInArrow(thrifty(_dealt_buckets(parts)), "part long, pairs binary")
    return dealt.repartition("part").sortWithinPartitions("part").mapInArrow(thrifty(_met_buckets), "bucket long")


def _marked_buckets(banded: DataFrame, shared: DataFrame, bits: int) -> DataFrame:
    """``h, bucket``: the lines of the ``shared`` buckets, and of a few more whose bit is that of one of them."""
    hint = banded.sparkSession.sparkContext.broadcast(bit_hint(shared.withColumnRenamed("bucket", "h"), bits))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, h = _in_bands(batch)
            hit = _hits(hint.value, buckets, bits)
            yield pa.RecordBatch.from_arrays([pa.array(h[hit]), pa.array(buckets[hit])], names=["h", "bucket"])

    return banded.mapInArrow(thrifty(mapped), "h long, bucket long")


def _texts(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))


def bit_hint(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit set of ``bits`` bits of the longs ``h``: at most ``bits / 64`` rows reach the driver."""
    words = (
        hashes.selectExpr(f"pmod(h, {bits}) bit")
        .groupBy(F.expr("cast(bit div 64 as int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("mask"))
        .toPandas()
    )
    hint = np.zeros(bits // 64, np.int64)
    hint[words["word"].to_numpy()] = words["mask"].to_numpy()
    return hint


def _hits(hint: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Of each long whether its bit of ``bit_hint`` is set."""
    at = values % bits
    return (hint[at >> 6] >> (at & 63) & 1).astype(bool)


def _candidate_lines(docs: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """``h, line`` once for each long ``h`` of ``wanted``."""
    hint = docs.sparkSession.sparkContext.broadcast(bit_hint(wanted, bits))

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent: set[int] = set()
        for frame in frames:
            found = []
            lines = [line for text in frame["text"] if text for line in normalised_lines(text) if line]
            hashes = np.fromiter(map(line_hash, lines), np.int64, len(lines))
            at = np.flatnonzero(_hits(hint.value, hashes, bits))
            for i, h in zip(at.tolist(), hashes[at].tolist(), strict=True):
                if h not in sent:
                    if len(sent) >= REMEMBERED:
                        sent.clear()
                    sent.add(h)
                    found.append((h, lines[i]))
            yield pd.DataFrame(found, columns=["h", "line"]).astype({"h": "int64"})

    lines = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(thrifty(mapped), "h long, line string")
    return lines.join(wanted, "h", "left_semi").dropDuplicates(["h"])


class Line:
    """A line as it is compared: the hashes of its shingles, a bitmap of the cells these fall into, and how many cells."""

    __slots__ = ("bitmap", "cells", "hashes", "sorted", "text")

    def __init__(self, text: str, hashes: np.ndarray, bitmap: int, cells: int) -> None:
        self.text, self.hashes, self.bitmap, self.cells, self.sorted = text, hashes, bitmap, cells, False

    def distinct(self) -> np.ndarray:
        """Sorted distinct hashes, made when first asked for."""
        if not self.sorted:
            self.hashes.sort()
            first = np.ones(len(self.hashes), bool)
            np.not_equal(self.hashes[1:], self.hashes[:-1], out=first[1:])
            if not first.all():
                self.hashes = self.hashes[first]
            self.sorted = True
        return self.hashes

    @staticmethod
    def cut(lines: list[str], size: int) -> Iterator[Line]:
        chars, batch = 0, []
        for line in [*lines, None]:
            if batch and (line is None or chars + len(line) > SIGNED_AT_ONCE):
                hashes, owner = _shingle_hashes(batch, size)
                cells = np.zeros((len(batch), CELLS), bool)
                cells[owner, (hashes % np.uint64(CELLS)).astype(np.int64)] = True
                ends, filled = np.cumsum(np.bincount(owner)).tolist(), cells.sum(axis=1).tolist()
                for i, bits in enumerate(np.packbits(cells, axis=1)):
                    own = hashes[ends[i - 1] if i else 0 : ends[i]].copy()
                    yield Line(batch[i], own, int.from_bytes(bits.tobytes(), "big"), filled[i])
                chars, batch = 0, []
            if line is not None:
                batch.append(line)
                chars += len(line)


def _alike(similarity: float, size: int):
    most, least = 1 / (1 + similarity), similarity / (1 + similarity)

    def alike(left: Line, right: Line) -> bool:
        # At the similarity one side has at most so many shingles that the other lacks; each cell that only it fills holds one.
        if (left.bitmap & ~right.bitmap).bit_count() > most * len(left.hashes) - least * right.cells + 1e-6:
            return False
        if (right.bitmap & ~left.bitmap).bit_count() > most * len(right.hashes) - least * left.cells + 1e-6:
            return False
        a, b = left.distinct(), right.distinct()
        if min(len(a), len(b)) < 0.99 * similarity * max(len(a), len(b)):
            return False
        at = np.searchsorted(a, b)
        shared = int((a[np.minimum(at, len(a) - 1)] == b).sum())
        found = shared / (len(a) + len(b) - shared)
        if abs(found - similarity) > 0.01:
            return found > similarity
        own, other = shingle_set(left.text, size), shingle_set(right.text, size)
        common = len(own & other)
        return common >= similarity * (len(own) + len(other) - common)

    return alike


def _verified(size: int, similarity: float):
    alike = _alike(similarity, size)

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, Line] = {}

        def rows():
            held = 0
            for frame in frames:
                texts = dict(zip(frame["h"].tolist(), frame["line"].tolist(), strict=True))
                new = [h for h in texts if h not in known]
                if held > HELD_CHARS:
                    known.clear()
                    held, new = 0, list(texts)
                known.update(zip(new, Line.cut([texts[h] for h in new], size), strict=True))
                held += sum(len(texts[h]) for h in new)
                for *group, slot, h, root in zip(*(frame[c].tolist() for c in (*GROUP, "slot", "h", "root")), strict=True):
                    yield (*group, slot, h, root, known[h])

        # Buckets with the same lowest line come to the same task one after the other: what one
        # has linked, or found unlike, the next need not compare.
        forest, unlike = Forest(), set()
        for (_, _, slot_a, slot_b), group in groupby(rows(), key=lambda row: row[:4]):
            # Members met so far by component, and of two tiles by slot.
            met: dict[int, list[tuple]] = {}
            for _, _, _, _, slot, h, root, line in group:
                joined = []
                for above, members in met.items():
                    if forest.find(root) == forest.find(above):
                        joined.append(above)
                        continue
                    for other_slot, other, others in members:
                        if slot_a != slot_b and slot == other_slot:
                            continue
                        pair = (h, other) if h < other else (other, h)
                        if pair in unlike:
                            continue
                        if alike(line, others):
                            forest.unite(root, above)
                            joined.append(above)
                            break
                        if len(unlike) >= REMEMBERED_PAIRS:
                            unlike.clear()
                        unlike.add(pair)
                own = [(slot, h, line)]
                for above in joined:
                    own += met.pop(above)
                met[root] = own
            if len(forest.parent) >= UNITED_AT_ONCE:
                yield pd.DataFrame(forest.links(), columns=["a", "b"], dtype="int64")
                forest = Forest()
        yield pd.DataFrame(forest.links(), columns=["a", "b"], dtype="int64")

    return mapped


def _links(dealt: DataFrame, lines: DataFrame, similarity: float, size: int) -> DataFrame:
    """Forest links ``a, b`` between the ``root`` values of like lines that were dealt to the same pair of tiles."""
    return (
        dealt.join(lines, "h")
        .repartition("low", "slot_a", "slot_b")
        .sortWithinPartitions(*GROUP, "slot", "h")
        .mapInPandas(thrifty(_verified(size, similarity)), "a long, b long")
    )


def _by_themselves(members: DataFrame) -> DataFrame:
    """Every tile by itself, and in each tile of a bucket the bucket's lowest line: a row for each line, and one for each tile."""
    own = members.selectExpr("low", "bucket", "slot slot_a", "slot slot_b", "slot", "h", "h root")
    lowest = members.where("h = low AND tiles > 1").selectExpr("low", "bucket", "slot", "h", "explode(sequence(0, tiles - 1)) other")
    return own.union(lowest.where("slot <> other").selectExpr("low", "bucket", "other slot_a", "other slot_b", "other slot", "h", "h root"))


def _still_apart(members: DataFrame, roots: DataFrame, tile: int) -> DataFrame:
    """Of buckets with several tiles the lines outside the bucket's largest component, in pairs of tiles with
    each other and with that component; a bucket of one component has no row."""
    wide = members.where("tiles > 1").select("low", "bucket", "h")
    placed = stored(wide.join(roots.withColumnRenamed("node", "h"), "h", "left").select("low", "bucket", "h", F.coalesce("root", "h").alias("root")), "placed")
    counted = placed.groupBy("low", "bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = (
        counted.groupBy("low", "bucket")
        .agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
        .where("all > most.n")
        .selectExpr("low", "bucket", "most.root largest", f"cast(ceil((all - most.n) / {tile}) as int) apart", f"cast(ceil(most.n / {tile}) as int) joined")
    )
    return (
        placed.join(largest, ["low", "bucket"])
        .withColumn("outside", F.expr("root <> largest"))
        .withColumn("slot", F.expr("cast(if(outside, pmod(xxhash64(h), apart), apart + pmod(xxhash64(h), joined)) as int)"))
        .selectExpr("low", "bucket", "slot", "h", "root", "explode(sequence(0, if(outside, apart + joined, apart) - 1)) other")
        .selectExpr("low", "bucket", "least(slot, other) slot_a", "greatest(slot, other) slot_b", "slot", "h", "root")
    )


def line_roots(
    docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE_CHARS, tile: int = TILE, hint_bits: int = HINT_BITS
) -> DataFrame:
    """``node, root`` for the hash of every distinct line that is like another, stored."""
    banded = signed.where("bands IS NOT NULL").select("h", "bands")
    # A line may have been signed in several tasks; a bucket needs two different ones.
    shared = stored(_shared_buckets(banded), "shared")
    members = stored(_marked_buckets(banded, shared, hint_bits).join(shared, "bucket", "left_semi").distinct(), "bands")
    # Buckets that hold the same lines in several bands are compared once.
    sizes = (
        members.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(h)").alias("all"), F.min("h").alias("low"), F.max("h").alias("high"))
        .groupBy("n", "all", "low", "high")
        .agg(F.min("bucket").alias("bucket"))
        .selectExpr("low", "bucket", f"cast(ceil(n / {tile}) as int) tiles")
    )
    members = stored(members.join(sizes, "bucket").selectExpr("low", "bucket", "h", "cast(pmod(xxhash64(h), tiles) as int) slot", "tiles"), "members")
    lines = stored(_candidate_lines(docs, members.select("h").distinct(), hint_bits), "candidates")
    roots = stored(components(_links(_by_themselves(members), lines, similarity, size), done=True), "roots")
    apart = stored(_still_apart(members, roots, tile), "apart")
    if apart.isEmpty():
        return roots
    more = _links(apart, lines, similarity, size)
    return stored(components(roots.selectExpr("root a", "node b").union(more), done=True), "roots")


def signed_lines(docs: DataFrame, size: int = SHINGLE_CHARS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``id`` (not null), ``line_no, h, bands, again`` of the distinct normalised lines of every document, stored; ``bands`` holds the bytes of longs."""
    schema = "id long, line_no long, h long, bands binary, again boolean"
    return stored(_texts(docs).mapInArrow(thrifty(_signed_batches(size, bands, rows)), schema), "lines")


def repeated_lines(
    docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE_CHARS, tile: int = TILE, hint_bits: int = HINT_BITS
) -> DataFrame:
    """``doc_id, line_hashes``: of each document the normalised lines whose group stays elsewhere.

    Repeats within a document are not listed; ``deduplicated`` drops them by itself.
    """
    roots = line_roots(docs, signed, similarity, size, tile, hint_bits).withColumnRenamed("node", "h")
    found = signed.selectExpr("id doc_id", "h")
    counted = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    counted = stored(counted.join(roots, "h", "left").where("n > 1 OR root IS NOT NULL").select("h", F.coalesce("root", "h").alias("root"), "first_id"), "counted")
    # In one document several lines of a group may stand: the first of them stays.
    placed = stored(signed.selectExpr("id doc_id", "line_no", "h").join(counted.select("h", "root"), "h"), "placed")
    firsts = counted.groupBy("root").agg(F.min("first_id").alias("first_id"))
    kept = (
        placed.join(firsts, "root")
        .where("doc_id <=> first_id")
        .groupBy("root", "first_id")
        .agg(F.min(F.struct("line_no", "h")).alias("kept"))
        .select("root", "first_id", F.col("kept.h").alias("kept_h"))
    )
    return (
        placed.join(kept, "root")
        .where("NOT (doc_id <=> first_id AND h = kept_h)")
        .groupBy("doc_id")
        .agg(F.collect_set("h").alias("line_hashes"))
    )


def _rewritten(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    give_back()
    out = []
    for text, hashes in zip(texts, gone, strict=True):
        if text is None:
            out.append((None, 0, 0))
            continue
        dropped = set() if hashes is None else set(np.asarray(hashes).tolist())
        lines, kept = text.split("\n"), []
        for line, short in zip(lines, normalised_lines(text), strict=True):
            if short:
                if (h := line_hash(short)) in dropped:
                    continue
                dropped.add(h)
            kept.append(line)
        out.append(("\n".join(kept), len(lines), len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_kept"]).astype({"n_lines": "int64", "n_kept": "int64"})


def deduplicated(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    size: int = SHINGLE_CHARS,
    bands: int = BANDS,
    rows: int = ROWS,
    tile: int = TILE,
    hint_bits: int = HINT_BITS,
) -> DataFrame:
    """Every row of ``docs`` with its text rewritten, then ``n_lines`` and ``n_kept`` (long).

    Lines without a letter or sign stay as they are. A null text stays null, an empty one
    empty. Rows that repeat a doc_id count as one document: what stays in one stays in
    all. A null doc_id comes after every other. Further columns are passed on; columns named
    ``n_lines`` or ``n_kept``, in any case, are replaced. An empty table gives an empty result.

    Only documents that lose a line, as a bit set of their ids tells, are joined with the lines they lose; the
    others pass where they are read.
    """
    known = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    own_id, gone_id, gone_lines, result, touched = (fresh(docs, name) for name in ("own_id", "gone_id", "gone_lines", "rewritten", "touched"))
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    numbered = known.withColumn("doc_id", key)
    signed = signed_lines(numbered, size, bands, rows)
    gone = stored(repeated_lines(numbered, signed, similarity, size, tile, hint_bits), "gone")
    ids = gone.select(F.col("doc_id").alias("key")).union(signed.where("again").selectExpr("id key"))
    known = marked(known.withColumn(own_id, key), own_id, stored(bit_words(ids), "touched"), touched)

    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_kept")]
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("line_hashes").alias(gone_lines))
    rewritten = F.pandas_udf(_rewritten, "struct<text:string,n_lines:long,n_kept:long>")
    changed = known.where(touched).join(gone, F.col(own_id) == F.col(gone_id), "left")
    changed = changed.withColumn(result, rewritten(F.col("text").cast("string"), F.col(gone_lines)))
    text = F.col("text").cast("string")
    lines = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    same = known.where(~F.col(touched)).select(*(text.alias(c) if c == "text" else F.col(c) for c in kept), lines.alias("n_lines"), lines.alias("n_kept"))
    return same.union(
        changed.select(*(F.col(f"{result}.text").alias(c) if c == "text" else F.col(c) for c in kept), f"{result}.n_lines", f"{result}.n_kept")
    )
