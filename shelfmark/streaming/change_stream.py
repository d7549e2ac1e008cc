"""Changes as a stream: each micro-batch becomes queue rows and then fresh documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.wire import version_ms
from shelfmark.operators.changes import QUEUE_KEY, coalesced_queue, current_documents
from shelfmark.plans.search_items import search_items, with_json
from shelfmark.schemas import HELD, QUEUE, WANTED
from shelfmark.sources.catalogue import Catalogue, StoreView, narrowed, wanted_ids
from shelfmark.streaming.batch_log import read_batch, read_log, write_batch


def queue_of(changes: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Changes (entity_id, ts) as queue rows: the batch function of the stream."""
    stamped = changes.select("entity_id", version_ms(F.col("ts")).alias("version")).withColumn("seq", F.col("version"))
    return coalesced_queue(stamped, catalogue).select(*QUEUE.names)


def fold_queue(log: DataFrame) -> DataFrame:
    """The queue after all batches: the greatest version of each key, the later batch
    deciding between equal ones; the place in line is the first."""
    latest = F.max_by(F.struct("op", "status", "attempts"), F.struct("version", "batch"))
    folded = log.groupBy(*QUEUE_KEY).agg(
        latest.alias("latest"), F.max("version").alias("version"), F.min("first_seq").alias("first_seq")
    )
    return folded.select(*QUEUE_KEY, "latest.*", "version", "first_seq").select(*QUEUE.names)


def fold_documents(log: DataFrame) -> DataFrame:
    """The documents held after all batches; stale writes are skipped."""
    return current_documents(log, "id", "version", "batch", ["op", "json"]).select("id", "op", "version", "json")


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    return fold_queue(read_log(spark, QUEUE, path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return fold_documents(read_log(spark, HELD, path))


def start_refresh(
    changes: DataFrame,
    catalogue: Catalogue | Callable[[], Catalogue],
    store: StoreView,
    queue_path: str,
    documents_path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Start the stream. Each batch writes its queue rows first, and the ids whose rows its
    documents need; the documents are made from what was written. A replay makes the same
    ones, and the sizes are known, so a small batch is broadcast to the catalogue tables.

    A catalogue that changes while the stream runs is given as a reader: every batch calls
    it, so its documents show the tables, and the files in them, of that moment."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        current = catalogue() if callable(catalogue) else catalogue
        write_batch(queue_of(batch, current), queue_path, batch_id)
        queued = read_batch(spark, QUEUE, queue_path, batch_id)
        requested = queued.select(F.col("object_id").alias("entity_id"), "version")
        write_batch(wanted_ids(current, requested), f"{queue_path}_wanted", batch_id)
        wanted = read_batch(spark, WANTED, f"{queue_path}_wanted", batch_id)
        items = with_json(search_items(requested, narrowed(current, requested, wanted), store)).select(*HELD.names)
        write_batch(items, documents_path, batch_id)

    writer = changes.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
