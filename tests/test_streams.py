"""The change stream and the report stream, from files, against their batch forms."""

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import functions as F

from shelfmark.operators.changes import merge_queue
from shelfmark.operators.indexing import indexable
from shelfmark.plans.queries import STORE, catalogue_of
from shelfmark.plans.search_items import search_items, with_json
from shelfmark.schemas import ATTRIBUTED_LINE, HELD, QUEUE
from shelfmark.sources.changelog import WATCHED, stream_changes, union_changes
from shelfmark.streaming import batch_log, change_stream
from shelfmark.streaming.report_stream import read_reports, start_reports
from shelfmark.streaming.session_stream import received_stream

TABLES = ["catalog_product_entity", "catalog_product_super_link"]


def change_files(spark, folder, shop):
    """Two tables' changes, each in two files that arrive one after the other."""
    rows = shop["watched_change"].where("table_no IN (0, 6)").withColumn("ts", F.col("ts").cast("timestamp"))
    for number, table in zip((0, 6), TABLES):
        own = rows.where(F.col("table_no") == number).select(F.col("changed_id").alias(WATCHED[table]), "ts")
        middle = F.lit("2024-01-15").cast("timestamp")
        own.where(F.col("ts") < middle).coalesce(1).write.parquet(f"{folder}/{table}", mode="append")
        own.where(F.col("ts") >= middle).coalesce(1).write.parquet(f"{folder}/{table}", mode="append")


def run(spark, folder, catalogue):
    change_stream.start_refresh(
        stream_changes(spark, f"{folder}/in", TABLES, files_per_batch=1), catalogue, STORE,
        f"{folder}/queue", f"{folder}/documents", f"{folder}/checkpoint", availableNow=True,
    ).awaitTermination()


def test_change_stream_equals_batch(spark, shop, folder):
    catalogue = catalogue_of(shop)
    change_files(spark, f"{folder}/in", shop)
    run(spark, folder, catalogue)
    read = union_changes(lambda table: spark.read.parquet(f"{folder}/in/{table}"), TABLES)
    expected = change_stream.queue_of(read, catalogue)
    held = change_stream.read_queue(spark, f"{folder}/queue")
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, expected.collect()))
    requested = expected.select(F.col("object_id").alias("entity_id"), "version")
    items = with_json(search_items(requested, catalogue, STORE)).select(*HELD.names)
    documents = change_stream.read_documents(spark, f"{folder}/documents")
    assert sorted(map(tuple, documents.collect())) == sorted(map(tuple, items.collect()))
    # A second run has nothing to do, and a compacted log reads the same.
    run(spark, folder, catalogue)
    top = batch_log.read_log(spark, QUEUE, f"{folder}/queue").agg(F.max("batch")).collect()[0][0]
    batch_log.compact(spark, QUEUE, f"{folder}/queue", f"{folder}/queue2", top, change_stream.fold_queue)
    again = change_stream.read_queue(spark, f"{folder}/queue2")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, expected.collect()))


def test_every_batch_reads_the_catalogue_anew(spark, shop, folder):
    """The tables change between two micro-batches, and the second one's documents show it."""
    before, calls = catalogue_of(shop), []
    after = replace(before, entity=before.entity.withColumn("sku", F.concat(F.lit("NEW-"), "sku")))

    def reader():
        calls.append(1)
        return before if len(calls) == 1 else after

    ids = [r.entity_id for r in indexable(before, STORE).orderBy("entity_id").limit(2).collect()]
    for number, changed in enumerate(ids):
        row = [(changed, dt.datetime(2026, 1, 20 + number))]
        path = f"{folder}/in/{TABLES[0]}"
        spark.createDataFrame(row, f"{WATCHED[TABLES[0]]} bigint, ts timestamp").coalesce(1).write.parquet(path, mode="append")
    change_stream.start_refresh(
        stream_changes(spark, f"{folder}/in", TABLES[:1], files_per_batch=1), reader, STORE,
        f"{folder}/queue", f"{folder}/documents", f"{folder}/checkpoint", availableNow=True,
    ).awaitTermination()
    assert len(calls) == 2
    skus = {r.id: json.loads(r.json)["data"]["sku"] for r in change_stream.read_documents(spark, f"{folder}/documents").collect()}
    assert sorted(sku.startswith("NEW-") for sku in skus.values()) == [False, True]


def test_replayed_batch_changes_nothing(spark, folder):
    rows = spark.createDataFrame([("product", 1, 0, "upsert", 5, "pending", 0, 1)], QUEUE)
    for _ in range(2):
        batch_log.write_batch(rows, f"{folder}/log", 3)
    assert batch_log.read_log(spark, QUEUE, f"{folder}/log").count() == 1
    assert change_stream.read_queue(spark, f"{folder}/log").count() == 1


def test_log_fold_equals_merge(spark, folder):
    first = spark.createDataFrame([("product", i, 0, "upsert", i, "pending", 0, i) for i in range(1, 6)], QUEUE)
    second = spark.createDataFrame([("product", i, 0, "upsert", 4, "pending", 0, 9) for i in range(3, 8)], QUEUE)
    batch_log.write_batch(first, f"{folder}/log", 0)
    batch_log.write_batch(second, f"{folder}/log", 1)
    folded = change_stream.read_queue(spark, f"{folder}/log")
    merged = merge_queue(first, second).select(*QUEUE.names)
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, merged.collect()))


def test_reports_are_received_once(spark, folder):
    day = dt.datetime(2026, 1, 20)
    schema = "store_id bigint, order_ref string, occurred_at timestamp"
    batches = [
        [(1, "a", day), (1, "a", day), (2, "a", day)],
        [(1, "a", day), (1, "b", day + dt.timedelta(days=1))],
        [(1, "a", day), (1, "c", day - dt.timedelta(days=30))],
    ]
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.parquet(f"{folder}/in", mode="append")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    received_stream(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.store_id, r.order_ref) for r in spark.read.parquet(f"{folder}/out").collect())
    # The report of 30 days earlier arrives behind the watermark and is dropped.
    assert got == [(1, "a"), (1, "b"), (2, "a")]


def test_report_stream_keeps_the_first_time(spark, folder):
    day = dt.datetime(2026, 1, 20)
    for number, value in enumerate((100, 250)):
        rows = [(1, 7, 1, 5, "USD", value, f"term {number}", day + dt.timedelta(days=number))]
        spark.createDataFrame(rows, ATTRIBUTED_LINE).coalesce(1).write.parquet(f"{folder}/in", mode="append")
    stream = spark.readStream.schema(ATTRIBUTED_LINE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    start_reports(stream, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    row = read_reports(spark, f"{folder}/out").collect()[0]
    assert (row.order_id, row.occurred_at, row.value_cents, row.q, row.writes) == (7, day, 250, "term 1", 2)
