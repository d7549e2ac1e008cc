"""Order reports on their way out: age limit, payload, answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.wire import classify, is_retry, order_ref, split_ids, wire_timestamp

# Days a report may wait, days the service accepts, reports per flush.
REPORT_TTL_DAYS = 7
SERVICE_CLAMP_DAYS = 8
FLUSH_LIMIT = 10


def with_expiry(reports: DataFrame, now: Column) -> DataFrame:
    """Adds ``abandoned``: older than the limit, which stays inside what the service takes."""
    days = min(REPORT_TTL_DAYS, SERVICE_CLAMP_DAYS - 1)
    return reports.withColumn("abandoned", F.col("occurred_at") < now - F.expr(f"INTERVAL {days} DAYS"))


def expiry_counts(reports: DataFrame, now: Column) -> DataFrame:
    """(kept, abandoned): what is dropped is counted, not lost silently."""
    return with_expiry(reports, now).agg(
        F.count_if(~F.col("abandoned")).alias("kept"), F.count_if("abandoned").alias("abandoned")
    )


def report_payloads(reports: DataFrame, install_id: Column, stored: Column | None = None) -> DataFrame:
    """(order_id, payload fields, unreadable). A row whose timestamp cannot be read is
    marked and must not be sent."""
    text = F.date_format("occurred_at", "yyyy-MM-dd HH:mm:ss") if stored is None else stored
    when = wire_timestamp(text)
    return reports.select(
        "order_id",
        order_ref(install_id, F.col("order_id")).alias("order_ref"),
        "value_cents",
        "currency",
        when.alias("occurred_at"),
        split_ids(F.col("item_ids")).alias("item_ids"),
        "q",
        when.isNull().alias("unreadable"),
    )


def payload_json(payloads: DataFrame) -> DataFrame:
    fields = ["order_ref", "value_cents", "currency", "occurred_at", "item_ids", "q"]
    return payloads.where(~F.col("unreadable")).select("order_id", F.to_json(F.struct(*fields)).alias("payload"))


def report_head(reports: DataFrame, limit: int = FLUSH_LIMIT) -> DataFrame:
    return reports.orderBy("id").limit(limit)


def delivery_classified(answers: DataFrame) -> DataFrame:
    return answers.withColumn("outcome", classify(F.col("status")))


def delivered_prefix(answers: DataFrame, per: str | None = None) -> DataFrame:
    """The answers, in id order, before the first one that says "ask again"; with ``per``,
    for each queue of its own.

    That is every id below the least retryable id: one combined minimum, no ordering.
    """
    retries = answers.where(is_retry(F.col("status")))
    if per is None:
        first = retries.agg(F.min("id").alias("id")).scalar()
        return answers.where(first.isNull() | (F.col("id") < first))
    firsts = retries.groupBy(per).agg(F.min("id").alias("_first"))
    before = F.col("_first").isNull() | (F.col("id") < F.col("_first"))
    return answers.join(firsts, per, "left").where(before).drop("_first")


def report_flush(
    reports: DataFrame, settings: DataFrame, answers: DataFrame, now: Column, limit: int = FLUSH_LIMIT
) -> DataFrame:
    """One flush of every store's reports (store_id, id, occurred_at, stored): each row and its ``outcome``.

    A store that is not connected, or does not share, sends nothing: ``gated``. Reports older than the limit are ``abandoned``
    first. Of the rest the first ``limit`` of a store are taken in id order; ``stored`` is the timestamp as it is kept, and one that cannot be
    read is ``unreadable`` and goes. The others are sent up to the first answer that says "ask again": ``sent`` (accepted), ``dropped``
    (refused on its merits), ``retry``. What is behind that, or beyond the limit, is ``waiting``. ``answers`` is (id, status); none is a retry.
    """
    willing = settings.where(F.col("connected") & F.col("share_search_data")).select("store_id", F.lit(True).alias("_open"))
    open_ = F.coalesce("_open", F.lit(False))
    rows = with_expiry(reports.join(willing, "store_id", "left"), now).withColumn("_takes", open_ & ~F.col("abandoned"))
    # A rank with a limit: Spark keeps the first of each store in every task before it shuffles them.
    in_line = Window.partitionBy("store_id").orderBy("id")
    head = rows.where("_takes").select("store_id", "id", "stored").withColumn("_nth", F.row_number().over(in_line)).where(F.col("_nth") <= limit)
    head = head.withColumn("_readable", wire_timestamp(F.col("stored")).isNotNull()).join(answers.select("id", "status"), "id", "left")
    again = F.col("_readable") & F.coalesce(is_retry(F.col("status")), F.lit(True))
    stopped = F.min(F.when(again, F.col("id"))).over(Window.partitionBy("store_id"))
    head = head.withColumns({"_stop": stopped, "_again": again}).select("store_id", "id", "status", "_readable", "_stop", "_again")
    reached = F.col("_readable").isNotNull() & (F.col("_stop").isNull() | (F.col("id") <= F.col("_stop")))
    outcome = (
        F.when(~open_, "gated")
        .when(F.col("abandoned"), "abandoned")
        .when(~F.coalesce(reached, F.lit(False)), "waiting")
        .when(~F.col("_readable"), "unreadable")
        .when(F.col("_again"), "retry")
        .when(F.col("status").between(200, 299), "sent")
        .otherwise("dropped")
    )
    flushed = rows.join(head, ["store_id", "id"], "left")
    return flushed.select(*reports.columns, outcome.alias("outcome"))


def reports_left(flushed: DataFrame) -> DataFrame:
    """What a flush leaves, each row exactly as it was: the next attempt sends the same payload."""
    return flushed.where(F.col("outcome").isin("gated", "waiting", "retry")).drop("outcome")
