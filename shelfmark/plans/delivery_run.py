"""From queue rows to request bodies, and from answers back to the queue's log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.batches import MAX_ITEMS, assign_batches, batch_bodies
from shelfmark.operators.drain import batches_in_line
from shelfmark.plans.search_items import search_items, with_json
from shelfmark.session import ensure_checkpoint_dir
from shelfmark.sources.catalogue import Catalogue, StoreView


def numbered_queue(queue: DataFrame, order: str = "object_id") -> DataFrame:
    """Pending rows as (entity_id, version, batch_no, slot)."""
    pending = queue.where(F.col("status") == "pending")
    return assign_batches(pending, order).select(F.col("object_id").alias("entity_id"), "version", "batch_no", "slot")


def bodies(numbered: DataFrame, catalogue: Catalogue, store: StoreView, version: Column | None = None) -> DataFrame:
    """(batch_no, items, body) of a run: a product is one item of one batch."""
    return batch_bodies(with_json(search_items(numbered, catalogue, store, version)))


def claimed_round(
    queue: DataFrame, now: Column, items: Column | None = None, size: int = MAX_ITEMS
) -> DataFrame:
    """``batches_in_line`` kept in the checkpoint folder before anything is sent: what is sent and what is logged
    are the same rows, whatever is lost or enqueued meanwhile."""
    ensure_checkpoint_dir(queue.sparkSession)
    return batches_in_line(queue, now, items, size).checkpoint()


def outcome_log(numbered: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers (batch_no, seq, ts, status) as rows of the queue's log: every product of an
    accepted batch is complete, every other one is released."""
    accepted = F.col("status").between(200, 299)
    return numbered.join(answers, "batch_no").select(
        "seq",
        F.col("entity_id").alias("object_id"),
        "ts",
        F.when(accepted, "complete").otherwise("release").alias("kind"),
        "version",
    )
