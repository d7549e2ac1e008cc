"""What the operators share: tables in the shared folder, words, the given tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import ensure_checkpoint_dir

# Python's bytes.split() without an argument cuts at exactly these bytes: 20 and 09 to 0D.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Rows, and bytes, of whole texts that go to a Python worker at a time; they bound memory, not results.
ROWS_AT_ONCE = 2000
BYTES_AT_ONCE = 8 << 20


def narrow_batches(spark: SparkSession) -> None:
    """Texts may be long, so fewer of them than usual travel to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_AT_ONCE))


def give_back() -> None:
    """Return memory that Arrow and the C library hold for later use.

    Python workers outlive their tasks, and several wait beside each executor: what they keep adds up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_held: list[Callable] = []


def held(load: Callable) -> Callable:
    """``load`` with a cache that lasts until the worker's next task that is ``thrifty`` and does not keep it."""
    cached = cache(load)
    _held.append(cached)
    return cached


def forget() -> None:
    """Drop what is ``held``: a tokenizer is of no use to the next operator's tasks."""
    for cached in _held:
        cached.cache_clear()


def thrifty(mapped: Callable[[Iterator], Iterator], keeps: bool = False) -> Callable[[Iterator], Iterator]:
    """``mapped``, a function over batches, giving back memory before and after its task; ``keeps``: it uses what is ``held``."""

    def wrapped(batches: Iterator) -> Iterator:
        if not keeps:
            forget()
        give_back()
        yield from mapped(batches)
        give_back()

    return wrapped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    narrow_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which every executor reaches."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written once to the folder of ``spark.checkpoint.dir`` and read again.

    This cuts lineage: a lost executor costs a read of files that every executor reaches.
    """
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` does not have, whatever the case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(column: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A to Z only) words of a whole text, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
