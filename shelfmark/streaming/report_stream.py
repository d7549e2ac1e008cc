"""Order reports as a stream: attributed lines in, one stored report per order out; reports too old to send are kept aside and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from shelfmark.operators.attribution import one_report_per_order, order_reports
from shelfmark.operators.delivery import with_expiry
from shelfmark.schemas import row
from shelfmark.streaming.batch_log import read_log, write_batch

WRITTEN = row(
    order_id=LongType(), value_cents=LongType(), currency=StringType(), item_ids=StringType(), q=StringType(),
    occurred_at=TimestampType(),
)


def start_reports(lines: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each micro-batch's reports; an order reported again is folded when read."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(order_reports(batch).select(*WRITTEN.names), path, batch_id)

    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """One report per order: the first timestamp and currency, the last value and items."""
    arrival = F.struct("batch", "occurred_at")
    return one_report_per_order(read_log(spark, WRITTEN, path).withColumn("arrival", arrival))


#: The name under which a stream's progress carries its counts.
EXPIRY_METRICS = "report_expiry"


def judged_reports(reports: DataFrame, now: Column | None = None) -> DataFrame:
    """A stream's reports with ``abandoned``, and (kept, abandoned) of every micro-batch in its progress.

    The clock is the micro-batch's own, which a replay repeats, so a report is judged the same again. A report
    without a time cannot be called too old; it is kept, and what reads its time says that it is unreadable.
    """
    judged = with_expiry(reports, F.current_timestamp() if now is None else now)
    judged = judged.withColumn("abandoned", F.coalesce("abandoned", F.lit(False)))
    return judged.observe(
        EXPIRY_METRICS, F.count_if(~F.col("abandoned")).alias("kept"), F.count_if("abandoned").alias("abandoned")
    )


def start_expiry(reports: DataFrame, path: str, checkpoint: str, now: Column | None = None, **trigger) -> StreamingQuery:
    """Write each micro-batch's reports to one log, those to send and those abandoned unsent in folders of their own.

    One write reads a micro-batch once, so the counts in its progress are those of its rows."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("abandoned").parquet(f"{path}/batch={batch_id}")

    writer = judged_reports(reports, now).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def read_judged(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """The reports of ``start_expiry`` with ``abandoned`` and ``batch``; a filter on either reads only its folders."""
    return read_log(spark, StructType([*schema.fields, StructField("abandoned", BooleanType())]), path)
