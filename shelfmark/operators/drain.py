"""One run of the drain: stalled rows back in line, batches in order up to the first that fails.

The queue is what ``queue_state`` folds from its log, so a run reads the log and answers with
log rows: ``round_log`` closes the loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.batches import MAX_ITEMS, assign_batches
from shelfmark.operators.queue import requeue_stalled

QUEUE_KEYS = ("object_type", "object_id", "store_id")


def batches_in_line(queue: DataFrame, now: Column, items: Column | None = None, size: int = MAX_ITEMS) -> DataFrame:
    """The queue with stalled rows pending again, and pending rows in batches: ``batch_no, slot``.

    ``items`` is how many items a row is sent as, one unless said otherwise; a row that is sent as
    none still takes its place in a batch. Rows being sent have no batch.
    """
    ready = requeue_stalled(queue, now).withColumn("items", F.lit(1) if items is None else items)
    pending = F.col("status") == "pending"
    placed = assign_batches(ready.where(pending), "created_seq", size)
    return placed.unionByName(ready.where(~pending), allowMissingColumns=True)


def drain_round(in_line: DataFrame, answers: DataFrame, budget: int | None = None) -> DataFrame:
    """Every row of ``batches_in_line`` with its ``outcome``.

    Batches are sent in order. ``answers`` (batch_no, status) are the service's; a batch without one counts
    as failed. The first batch that fails is ``released`` and ends the run: those before it are
    ``completed``, those after it ``waiting``. A batch that has no item is not sent and is complete. ``budget`` is how many
    batches the run has time for. Rows that another run holds are ``held``.
    """
    sizes = in_line.where(F.col("batch_no").isNotNull()).groupBy("batch_no").agg(F.sum("items").alias("items"))
    accepted = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    failed = sizes.where("items > 0").join(answers, "batch_no", "left").where(~accepted).agg(F.min("batch_no").alias("batch_no"))
    first = failed.scalar()
    number = F.col("batch_no")
    late = F.lit(False) if budget is None else number >= budget
    outcome = (
        F.when(number.isNull(), "held")
        .when(late | F.coalesce(number > first, F.lit(False)), "waiting")
        .when(number.eqNullSafe(first), "released")
        .otherwise("completed")
    )
    return in_line.withColumn("outcome", outcome)


def queue_after(drained: DataFrame) -> DataFrame:
    """The queue a run leaves: completed rows are gone, a released one waits with one more attempt."""
    released = F.col("outcome") == "released"
    left = drained.where(F.col("outcome") != "completed").withColumn("attempts", F.col("attempts") + released.cast("int"))
    return left.drop("items", "batch_no", "slot", "outcome")


def round_log(drained: DataFrame, last_seq: Column, now: Column) -> DataFrame:
    """A run as rows of the queue's log: a claim of every row sent, then its answer. ``last_seq`` is the log's last one."""
    sent = drained.where(F.col("outcome").isin("completed", "released"))
    kinds = F.array(F.lit("claim"), F.when(F.col("outcome") == "completed", "complete").otherwise("release"))
    keys = [name for name in QUEUE_KEYS if name in drained.columns]
    # created_seq tells the rows apart: twice that number is a place for both entries of each.
    return sent.select("*", F.posexplode(kinds).alias("_nth", "kind")).select(
        (last_seq + 1 + F.col("created_seq") * 2 + F.col("_nth")).alias("seq"), *keys, now.alias("ts"), "kind", "version"
    )


def round_summary(drained: DataFrame) -> DataFrame:
    """(batches, items, failed, released, waiting) of a run: what was accepted, whether it ended early, what is left."""
    done, outcome = F.col("outcome") == "completed", F.col("outcome")
    by_batch = drained.groupBy("batch_no", "outcome").agg(F.sum("items").alias("items"), F.count(F.lit(1)).alias("rows"))
    return by_batch.agg(
        F.count_if(done & (F.col("items") > 0)).alias("batches"),
        F.coalesce(F.sum(F.when(done, F.col("items"))), F.lit(0)).cast("bigint").alias("items"),
        (F.count_if(outcome == "released") > 0).alias("failed"),
        F.coalesce(F.sum(F.when(outcome == "released", F.col("rows"))), F.lit(0)).alias("released"),
        F.coalesce(F.sum(F.when(outcome == "waiting", F.col("rows"))), F.lit(0)).alias("waiting"),
    )
