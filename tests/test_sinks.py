"""Bodies are kept once whatever is replayed; reports too old to send are kept aside and counted."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from shelfmark.operators.batches import assign_batches, batch_bodies
from shelfmark.operators.delivery import expiry_counts
from shelfmark.streaming.body_sink import BodyWriter, Written, read_bodies, start_bodies
from shelfmark.streaming.report_stream import EXPIRY_METRICS, read_judged, start_expiry

NOW = dt.datetime(2026, 1, 20)
REPORT = "store_id bigint, id bigint, occurred_at timestamp"


def body_files(spark, folder, shop):
    """Every product's id as an item, in bodies of 10, in three files."""
    items = shop["entity"].select(F.col("entity_id").alias("object_id"), F.to_json(F.struct("entity_id", "sku")).alias("json"))
    bodies = batch_bodies(assign_batches(items, size=10))
    for number in range(3):
        bodies.where(F.col("batch_no") % 3 == number).coalesce(1).write.parquet(f"{folder}/in", mode="append")
    return spark.readStream.schema(bodies.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_a_replayed_batch_leaves_bodies_single(spark, shop, folder):
    stream = body_files(spark, folder, shop)
    expected = sorted(r.body for r in spark.read.parquet(f"{folder}/in").select("body").collect())
    start_bodies(stream, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    assert sorted(r.body for r in read_bodies(spark, f"{folder}/out").collect()) == expected
    files = set(glob.glob(f"{folder}/out/bodies/*.txt"))
    # The driver is lost after a batch was listed and before the stream noted it: the stream writes it again.
    last = max(int(os.path.basename(path)) for path in glob.glob(f"{folder}/checkpoint/commits/[0-9]*"))
    for path in (f"{folder}/checkpoint/commits/{last}", f"{folder}/checkpoint/commits/.{last}.crc"):
        if os.path.exists(path):
            os.remove(path)
    start_bodies(stream, f"{folder}/out", f"{folder}/checkpoint", availableNow=True).awaitTermination()
    assert os.path.exists(f"{folder}/checkpoint/commits/{last}")
    assert sorted(r.body for r in read_bodies(spark, f"{folder}/out").collect()) == expected
    assert set(glob.glob(f"{folder}/out/bodies/*.txt")) == files
    assert read_bodies(spark, f"{folder}/out").select("batch").distinct().count() == 3


def test_files_on_no_list_do_not_count(spark, folder):
    rows = spark.createDataFrame([("a",), ("ü/",), (None,)], "body string").toArrow().to_batches()
    writer = BodyWriter(folder)
    first, lost, again = (writer.write(iter(rows)) for _ in range(3))
    assert first.bodies == 2 and writer.write(iter([])) == Written(None, 0)
    writer.commit([first, None, Written(None, 0)], 0)
    writer.commit([again], 0)
    assert sorted(map(tuple, read_bodies(spark, folder).collect())) == [(0, "a"), (0, "ü/")]
    writer.abort([lost, None], 1)
    assert [os.path.basename(path) for path in glob.glob(f"{folder}/bodies/*.txt")] == [first.file]


def test_abandoned_reports_are_counted_and_kept_aside(spark, folder):
    ages = [[0, 6, 7, 8], [30, None], [1]]
    for number, batch in enumerate(ages):
        rows = [(1, 10 * number + i, None if age is None else NOW - dt.timedelta(days=age)) for i, age in enumerate(batch)]
        spark.createDataFrame(rows, REPORT).coalesce(1).write.parquet(f"{folder}/in", mode="append")
    stream = spark.readStream.schema(REPORT).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    now = F.lit(NOW).cast("timestamp")
    query = start_expiry(stream, f"{folder}/out", f"{folder}/checkpoint", now, availableNow=True)
    query.awaitTermination()
    judged = read_judged(spark, stream.schema, f"{folder}/out")
    kept, gone = judged.where("NOT abandoned"), judged.where("abandoned")
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 11, 20]
    assert sorted(r.id for r in gone.collect()) == [3, 10]
    # What each micro-batch dropped, as its progress tells.
    counts = [progress.observedMetrics[EXPIRY_METRICS] for progress in query.recentProgress if progress.numInputRows]
    written = {r.batch: r.n for r in gone.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert {i: c.abandoned for i, c in enumerate(counts) if c.abandoned} == written
    assert sum(c.kept for c in counts) == 5 and sum(c.abandoned for c in counts) == 2
    whole = spark.read.parquet(f"{folder}/in").where("occurred_at IS NOT NULL")
    assert tuple(expiry_counts(whole, now).collect()[0]) == (4, 2)
