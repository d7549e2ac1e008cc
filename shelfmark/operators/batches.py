"""Delivery batches: numbering, JSON bodies, summaries, the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.scans import with_position

# Fixed value: the most items one request may carry.
MAX_ITEMS = 100


def assign_batches(queue: DataFrame, order: str = "object_id", size: int = MAX_ITEMS) -> DataFrame:
    """Queue rows with batch_no and slot, in the order of a unique whole-number column.

    Numbers the narrow queue rows before the documents exist, so only ids are shuffled.
    """
    placed = with_position(queue, order)
    return (
        placed.withColumn("batch_no", F.floor(F.col("position") / F.lit(size)).cast("bigint"))
        .withColumn("slot", (F.col("position") % size).cast("int"))
        .drop("position")
    )


def item_json(op: Column, data: Column, version: Column) -> Column:
    """One item's JSON. Null fields are left out by ``to_json``."""
    return F.to_json(F.struct(op.alias("op"), data.alias("data"), version.alias("version")))


def batch_bodies(items: DataFrame, json: str = "json") -> DataFrame:
    """(batch_no, items, body) from rows (batch_no, slot, json); a batch is bounded by its size."""
    ordered = F.array_sort(F.collect_list(F.struct("slot", F.col(json).alias("json"))))
    body = F.concat(
        F.lit('{"items":['), F.array_join(F.transform(ordered, lambda row: row["json"]), ","), F.lit("]}")
    )
    return items.groupBy("batch_no").agg(F.count(F.lit(1)).alias("items"), body.alias("body"))


def write_bodies(bodies: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON body per line in text files."""
    bodies.select(F.col("body").alias("value")).write.mode(mode).text(path)


def batch_summary(items: DataFrame) -> DataFrame:
    """(batches, items, upserts, deletes) of a run. The batches are counted from one row
    per batch, which is what the slot 0 item is."""
    return items.agg(
        F.count_if(F.col("slot") == 0).alias("batches"),
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("op") == "upsert").alias("upserts"),
        F.count_if(F.col("op") == "delete").alias("deletes"),
    )


def batch_violations(items: DataFrame, size: int = MAX_ITEMS) -> DataFrame:
    """Batches outside 1..size items, or with an item that has no id."""
    sized = items.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("id").isNull()).alias("without_id")
    )
    reason = F.when(F.col("items") > size, "too many items").when(F.col("without_id") > 0, "item without id")
    return sized.withColumn("reason", reason).where(F.col("reason").isNotNull())


# Fixed value: the longest name of a kind of content.
KIND_CHARS = 20


def content_items(rows: DataFrame) -> DataFrame:
    """Pages and posts (id, object_type, name, visible, permalink, image, excerpt,
    published_at, version) as items. They carry no price, stock, SKU, brand or variants;
    a row without an id or with an unusable object_type gets a reject reason and no JSON."""
    reject = (
        F.when(F.col("id").isNull(), "no id")
        .when(F.coalesce(F.length("object_type"), F.lit(0)) == 0, "no object_type")
        .when(F.length("object_type") > KIND_CHARS, "object_type too long")
    )
    visible = F.coalesce("visible", F.lit(False)).alias("visible")
    data = F.struct("id", "object_type", "name", visible, "permalink", "image", "excerpt", "published_at")
    return rows.withColumn("reject", reject).withColumn(
        "json", F.when(F.col("reject").isNull(), item_json(F.lit("upsert"), data, F.col("version")))
    )
