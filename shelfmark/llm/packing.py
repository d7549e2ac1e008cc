"""Best-fit packing: bounded-space online best-fit into sequences of one length.

A document's ids, with the end id, are cut into pieces of the sequence length; the first
piece takes what is over. Full pieces are sequences by themselves. The others arrive one by one at a
packer with a fixed number of open bins. A bit set keyed by free space says which spaces
are on offer, so the tightest bin that fits is one bit operation away; where none fits, a bin is opened,
and when too many are open the fullest closes first.

Every task packs what it has read, with ids and lengths only. What is still open at its end
is packed again, whole bins as items, by fewer tasks in each further round, until the
open bins are few against the closed ones. Bins close for good only within these rounds, and no
round brings more than ``PER_TASK`` bins to a task.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, thrifty, whole_text
from shelfmark.llm.encoding import Encoder

SEQUENCE = 1024
END_ID = 2
OPEN_BINS = 256
#: Bins that one task of a further round packs.
PER_TASK = 16_384


class BestFit:
    """Packs items of size 1 to ``capacity`` into bins, ``open_bins`` of them open at a time."""

    def __init__(self, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.open_bins, self.count = capacity, open_bins, 0
        self.free = 0  # bit s: some open bin has s free
        self.bins: dict[int, deque[list]] = {}

    def _take(self, space: int) -> list:
        queue = self.bins[space]
        found = queue.popleft()
        if not queue:
            del self.bins[space]
            self.free &= ~(1 << space)
        self.count -= 1
        return found

    def add(self, item, size: int) -> list[list]:
        """Place an item; bins that close because of it, each a list of items."""
        closed = []
        fitting = self.free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            content = self._take(space)
        else:
            if self.count >= self.open_bins:
                closed.append(self._take((self.free & -self.free).bit_length() - 1))
            space, content = self.capacity, []
        content.append(item)
        space -= size
        if space:
            self.bins.setdefault(space, deque()).append(content)
            self.free |= 1 << space
            self.count += 1
        else:
            closed.append(content)
        return closed

    def rest(self) -> list[list]:
        """The open bins, the fullest first; none is open afterwards."""
        found = [content for space in sorted(self.bins) for content in self.bins[space]]
        self.__init__(self.capacity, self.open_bins)
        return found


_FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]
_BINS = "open boolean, used long, items array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"


def pieces_of(ids: np.ndarray, sequence: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """``piece, start, length, crc32`` of a document's ids; the first piece takes what is over."""
    over = len(ids) % sequence
    starts = ([0] if over else []) + list(range(over, len(ids), sequence))
    ends = [*starts[1:], len(ids)]
    data = ids.astype("<u4", copy=False).tobytes()
    return [(i, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for i, (a, b) in enumerate(zip(starts, ends, strict=True))]


def _batch(bins: list[tuple[bool, list]]) -> pa.RecordBatch:
    item = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), *((name, pa.int64()) for name in _FIELDS[2:])])
    used = [sum(part[3] for part in content) for _, content in bins]
    items = [[dict(zip(_FIELDS, part, strict=True)) for part in content] for _, content in bins]
    return pa.RecordBatch.from_arrays(
        [pa.array([is_open for is_open, _ in bins], pa.bool_()), pa.array(used, pa.int64()), pa.array(items, pa.list_(item))],
        names=["open", "used", "items"],
    )


def _first_round(file: str, sequence: int, open_bins: int, end_id: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(file), BestFit(sequence, open_bins)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            done = []
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encoder.encode_all(batch["text"]), strict=True):
                ids = np.frombuffer(found + end, "<u4")
                for piece, start, length, crc in pieces_of(ids, sequence):
                    item = (doc_id, piece, start, length, crc)
                    done += [(False, content) for content in packer.add(item, length)]
            yield _batch(done)
        yield _batch([(True, content) for content in packer.rest()])

    return thrifty(mapped, keeps=True)


def _further_round(sequence: int, open_bins: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(sequence, open_bins)
        for batch in batches:
            done = []
            for used, items in zip(batch["used"].to_pylist(), batch["items"].to_pylist(), strict=True):
                content = [tuple(item[field] for field in _FIELDS) for item in items]
                done += [(False, sum(parts, [])) for parts in packer.add(content, used)]
            yield _batch(done)
        yield _batch([(True, sum(parts, [])) for parts in packer.rest()])

    return thrifty(mapped)


def packed(
    docs: DataFrame,
    tokenizer_file: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    per_task: int = PER_TASK,
) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone. Repeated rows are documents of their own, a null
    doc_id stays null, other columns are not read. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    bins = stored(texts.mapInArrow(_first_round(tokenizer_file, sequence, open_bins, end_id), _BINS), "bins")
    closed, left = [bins.where("NOT open")], bins.where("open")
    n = left.count()
    while n > 0:
        # The bins meet in an order of their own, so that every task gets sizes of all kinds.
        tasks = -(-n // per_task)
        dealt = left.repartition(tasks, F.xxhash64("items")) if tasks > 1 else left.coalesce(1)
        again = stored(dealt.mapInArrow(_further_round(sequence, open_bins), _BINS), "bins")
        closed.append(again.where("NOT open"))
        left, before = again.where("open"), n
        n = left.count()
        if tasks == 1 or n > 0.9 * before:
            closed.append(left)
            break
    whole = closed[0]
    for more in closed[1:]:
        whole = whole.union(more)
    # A sequence is known by its first piece: its number need not be dense, only its own.
    numbered = stored(whole.select("items").withColumn("sequence_id", F.monotonically_increasing_id()), "sequences")
    placed = numbered.selectExpr(
        "sequence_id",
        "items",
        "transform(items, (x, i) -> aggregate(slice(items, 1, i), 0L, (s, y) -> s + y.length)) offsets",
    )
    return placed.selectExpr("sequence_id", "inline(arrays_zip(items, offsets))").selectExpr(
        "items.doc_id doc_id", "items.piece piece", "items.start start", "items.length length", "items.ids_crc32 ids_crc32", "sequence_id", "offsets `offset`"
    )
