"""From bare changed ids to a coalesced queue, and from writes to current documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.parents import versions_with_parents
from shelfmark.operators.scans import max_before
from shelfmark.sources.catalogue import Catalogue

QUEUE_KEY = ["object_type", "object_id", "store_id"]


def newest_per_id(changes: DataFrame) -> DataFrame:
    """(entity_id, version, first_seq): each changed id once, at its latest version.

    Runs before the fan-out and combines on the map side, so a product that changes all
    the time crosses the shuffle once per task.
    """
    return changes.where(F.col("entity_id") != 0).groupBy("entity_id").agg(
        F.max("version").alias("version"), F.min("seq").alias("first_seq")
    )


def as_queue_rows(versions: DataFrame) -> DataFrame:
    """Pending rows. Upsert or delete is not decided here: only the document job can tell."""
    return versions.select(
        F.lit("product").alias("object_type"),
        F.col("entity_id").alias("object_id"),
        F.lit(0).cast("bigint").alias("store_id"),
        F.lit("upsert").alias("op"),
        F.col("version"),
        F.lit("pending").alias("status"),
        F.lit(0).cast("bigint").alias("attempts"),
        F.col("first_seq"),
    )


def coalesced_queue(changes: DataFrame, catalogue: Catalogue) -> DataFrame:
    """Changes (entity_id, version, seq) as one queue row per product or parent."""
    return as_queue_rows(versions_with_parents(newest_per_id(changes), catalogue))


def full_walk(entity: DataFrame, version: Column) -> DataFrame:
    """Every product as a queue row; the same upsert as a change."""
    return as_queue_rows(
        entity.select("entity_id", version.cast("bigint").alias("version"), F.col("entity_id").alias("first_seq"))
    )


def merge_queue(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert ``incoming`` into ``stored``: op, version and status come from the later
    write, arrival deciding between equal versions; attempts and place in line stay."""
    rows = stored.withColumn("_arrival", F.lit(0)).unionByName(incoming.withColumn("_arrival", F.lit(1)))
    latest = F.max_by(F.struct("op", "version", "status"), F.struct("version", "_arrival"))
    return (
        rows.groupBy(*QUEUE_KEY)
        .agg(
            latest.alias("latest"),
            F.max(F.when(F.col("_arrival") == 0, F.col("attempts"))).alias("attempts"),
            F.min("first_seq").alias("first_seq"),
        )
        .select(
            *QUEUE_KEY,
            "latest.op",
            "latest.version",
            "latest.status",
            F.coalesce("attempts", F.lit(0).cast("bigint")).alias("attempts"),
            "first_seq",
        )
    )


def current_documents(writes: DataFrame, key: str, version: str, arrival: str, payload: list[str]) -> DataFrame:
    """The document each key holds after all writes: the greatest version. A write whose
    version is not greater than the one held is stale, so of equal versions the first
    arrival stays."""
    order = F.struct(F.col(version), -F.col(arrival))
    return (
        writes.groupBy(key)
        .agg(F.max_by(F.struct(version, *payload), order).alias("_held"), F.count(F.lit(1)).alias("writes"))
        .select(key, "_held.*", "writes")
    )


def resync_requests(polls: DataFrame) -> DataFrame:
    """Status polls (install_id, seq, required, token, pending) to the requests in them.

    A request is acted on when its token is not the last one acted on. It starts a walk
    unless one is still draining: a walk was started before and the queue is not empty.
    Every request is acknowledged.
    """
    requests = polls.where(F.coalesce("required", F.lit(False)) & (F.coalesce("token", F.lit("")) != ""))
    seen = max_before(requests, ["install_id"], "seq", F.struct("seq", "token"), "_last")
    marked = seen.withColumn("acted", ~F.col("token").eqNullSafe(F.col("_last.token")))
    first = marked.groupBy("install_id").agg(F.min(F.when(F.col("acted"), F.col("seq"))).alias("_first"))
    return marked.join(first, "install_id").select(
        "install_id",
        "seq",
        "token",
        "pending",
        "acted",
        (F.col("acted") & ((F.col("seq") == F.col("_first")) | (F.col("pending") == 0))).alias("walk_started"),
    )


def resync_walk(requests: DataFrame, entity: DataFrame, version: str = "seq") -> DataFrame:
    """The full walk that the latest started request asks for, as queue rows to merge into
    the change flow; nothing when no request started one."""
    started = requests.where("walk_started").agg(F.max(version).alias("version")).scalar()
    return full_walk(entity, started).where(F.col("version").isNotNull())
