"""The queue: reading it, folding its log, rescuing stalled rows, its health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.scans import max_before

# Fixed value: seconds after which a claimed row counts as abandoned.
STALE_SECONDS = 900


def queue_head(queue: DataFrame, limit: int, order: tuple[str, ...] = ("first_seq", "object_id")) -> DataFrame:
    """The first pending rows in line, as one claim takes them."""
    return queue.where(F.col("status") == "pending").orderBy(*order).limit(limit)


def queue_peek(queue: DataFrame, after: int, limit: int, id_column: str = "object_id") -> DataFrame:
    """Pending rows behind a cursor, without claiming them."""
    behind = queue.where((F.col("status") == "pending") & (F.col(id_column) > after))
    return behind.orderBy(id_column).limit(limit)


def claim(queue: DataFrame, limit: int, now: Column) -> DataFrame:
    """The queue with its head marked as being sent at ``now``."""
    head = queue_head(queue, limit).select("object_type", "object_id", "store_id", F.lit(True).alias("_claimed"))
    taken = F.coalesce("_claimed", F.lit(False))
    held = F.col("claimed_at") if "claimed_at" in queue.columns else F.lit(None).cast("timestamp")
    return (
        queue.join(head, ["object_type", "object_id", "store_id"], "left")
        .withColumn("status", F.when(taken, "sending").otherwise(F.col("status")))
        .withColumn("claimed_at", F.when(taken, now).otherwise(held))
        .drop("_claimed")
    )


def queue_state(log: DataFrame, keys: Sequence[str] = ("object_id",)) -> DataFrame:
    """The rows left after a log of (seq, keys, ts, kind, version).

    Kinds: enqueue (a change at ``version``), claim, complete and release (``version`` is
    the one sent). Versions grow with seq. A complete removes the row only when nothing
    newer was enqueued before it arrived. A release puts the row back and counts an
    attempt; no number of attempts drops it. Claims and releases of a row that was since
    removed do not touch the row created after it.
    """
    keys = list(keys)
    enqueue, complete = F.col("kind") == "enqueue", F.col("kind") == "complete"
    seen = max_before(log, keys, "seq", F.when(enqueue, F.col("version")), "_queued")
    gone = seen.groupBy(*keys).agg(
        F.max(F.when(complete & (F.col("_queued") <= F.col("version")), F.col("seq"))).alias("_gone")
    )
    later = log.join(gone, keys).where(F.col("_gone").isNull() | (F.col("seq") > F.col("_gone")))
    rows = later.where(enqueue).groupBy(*keys).agg(
        F.min("seq").alias("created_seq"),
        F.min("version").alias("_first_version"),
        F.max("version").alias("_last_version"),
    )
    sent = (F.col("seq") > F.col("created_seq")) & (F.col("version") >= F.col("_first_version"))
    moves = later.where(~complete).join(rows, keys).where(enqueue | sent)
    return (
        moves.groupBy(*keys, "created_seq", F.col("_last_version").alias("version"))
        .agg(
            F.count_if(F.col("kind") == "release").alias("attempts"),
            F.max_by(F.struct("kind", "ts"), "seq").alias("_last"),
        )
        .withColumn("status", F.when(F.col("_last.kind") == "claim", "sending").otherwise("pending"))
        .withColumn("claimed_at", F.when(F.col("status") == "sending", F.col("_last.ts")))
        .drop("_last")
    )


def requeue_stalled(queue: DataFrame, now: Column, seconds: int = STALE_SECONDS) -> DataFrame:
    """Rows claimed longer ago than ``seconds`` go back to pending."""
    stalled = (F.col("status") == "sending") & (F.col("claimed_at") < now - F.expr(f"INTERVAL {seconds} SECONDS"))
    freed = F.coalesce(stalled, F.lit(False))
    return queue.withColumns(
        {
            "status": F.when(freed, "pending").otherwise(F.col("status")),
            "claimed_at": F.when(~freed, F.col("claimed_at")),
        }
    )


def queue_depth(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count(F.lit(1)).alias("depth"))


def queue_health(queue: DataFrame, changes: DataFrame) -> DataFrame:
    """One row: pending against the backlog of unread changes, the oldest row in line and
    the most attempts. A queue that will not drain shows here."""
    backlog = changes.agg(F.count(F.lit(1)).alias("backlog"))
    pending = F.col("status") == "pending"
    return queue.agg(
        F.count_if(pending).alias("pending"),
        F.count_if(F.col("status") == "sending").alias("sending"),
        F.min(F.when(pending, F.col("created_seq"))).alias("oldest_seq"),
        F.max("attempts").alias("max_attempts"),
    ).withColumn("changelog_rows", backlog.scalar())
