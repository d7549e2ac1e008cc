"""Search to order: which order lines a search earned, and what they were worth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.money import exponent_of, line_value, order_currency
from shelfmark.functions.wire import join_ids
from shelfmark.operators.scans import last_before
from shelfmark.session import ensure_checkpoint_dir

# Seconds a marker lives after its last mark, products it holds, length of
# its term.
WINDOW_SECONDS = 7 * 86400
MAX_TRACKED = 25
TERM_CHARS = 128

# Sessions with more events than this are cut into slices.
SLICE_EVENTS = 20_000


# --------------------------------------------------------------- order lines and values


def parent_lines(lines: DataFrame) -> DataFrame:
    """Order lines as bought: the child of a configurable repeats its parent's line."""
    return lines.where((F.coalesce("parent_item_id", F.lit(0)) == 0) & (F.col("order_id") > 0))


def sharing_stores(rows: DataFrame, settings: DataFrame) -> DataFrame:
    """Only rows of stores that are connected and share search data."""
    willing = settings.where(F.col("connected") & F.col("share_search_data"))
    return rows.join(willing.select("store_id"), "store_id", "left_semi")


def consenting(events: DataFrame, changes: DataFrame, at: str = "ts") -> DataFrame:
    """Only events of stores that were connected and shared search data when they happened.

    ``changes`` (store_id, ``at``, seq, connected, share_search_data) is the history of the settings; before its
    first change a store is not connected.
    """
    history = changes.select("store_id", at, "seq", "connected", "share_search_data")
    asked = last_before(events, history, ["store_id"], at, "_consent")
    return asked.where("_consent.connected AND _consent.share_search_data").drop("_consent")


def paid_lines(lines: DataFrame, orders: DataFrame, tax: str = "incl") -> DataFrame:
    """Parent lines with their currency and value in minor units. ``tax`` chooses the
    line total with or without tax."""
    total = F.coalesce("row_total_incl_tax", "row_total") if tax == "incl" else F.col("row_total")
    head = orders.select(
        "order_id", "session_id", order_currency(F.col("order_currency"), F.col("base_currency")).alias("currency")
    ).withColumn("places", exponent_of(F.col("currency")))
    return parent_lines(lines).join(head, "order_id").select(
        "order_id",
        "session_id",
        "item_id",
        "product_id",
        "currency",
        line_value(total, F.col("discount_amount"), F.col("currency"), F.col("places")).alias("value_cents"),
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """(order_id, currency, value_cents, item_ids) of attributed lines, in line order. A
    product on two lines appears twice."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("item_id", "product_id"))), lambda row: row["product_id"])
    return lines.groupBy("order_id", "currency").agg(
        F.sum("value_cents").alias("value_cents"), join_ids(ids).alias("item_ids")
    )


def attributed_order_value(lines: DataFrame, orders: DataFrame, marks: DataFrame, tax: str = "incl") -> DataFrame:
    """Orders with at least one line of a product their session had marked."""
    marked = marks.where(F.col("product_id") > 0).select("session_id", "product_id").distinct()
    return order_totals(paid_lines(lines, orders, tax).join(marked, ["session_id", "product_id"], "left_semi"))


# ------------------------------------------------------------------------- session fold
#
# A session's events in order (ts, event_id, item_id). A mark adds its product; the first
# term stays; the marker dies 7 days after its last mark. An order with a marked product
# takes those lines and empties the marker; any other order leaves it alone. What an order
# does depends on every earlier order of the session, so this is a fold and not a window.

STATE = (
    "struct<ids:array<bigint>,q:string,at:bigint,event_id:bigint,hit:boolean,"
    "found:array<struct<order_id:bigint,item_id:bigint,product_id:bigint,currency:string,value_cents:bigint,"
    "q:string,ts:timestamp>>>"
)
CARRY = "struct<ids:array<bigint>,q:string,at:bigint>"


def empty_marker() -> Column:
    return F.struct(
        F.array().cast("array<bigint>").alias("ids"), F.lit("").alias("q"), F.lit(None).cast("bigint").alias("at")
    ).cast(CARRY)


def session_events(marks: DataFrame, lines: DataFrame) -> DataFrame:
    """Marks (session_id, event_id, ts, product_id, q) and order lines (session_id,
    event_id, ts, order_id, item_id, product_id, currency, value_cents) in one frame."""
    nothing = {"order_id": "bigint", "item_id": "bigint", "currency": "string", "value_cents": "bigint"}
    marked = marks.where(F.col("product_id") > 0).select(
        "session_id",
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(True).alias("is_mark"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.substring(F.coalesce("q", F.lit("")), 1, TERM_CHARS).alias("q"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()),
    )
    bought = lines.where(F.col("order_id") > 0).select(
        "session_id",
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(False).alias("is_mark"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.lit("").alias("q"),
        *(F.col(name).cast(kind).alias(name) for name, kind in nothing.items()),
    )
    return marked.unionByName(bought)


def _step(state: Column, event: Column) -> Column:
    """The marker after one mark or one order line. An order empties the marker after its
    last line, which is when the next event begins."""
    moment = F.unix_micros(event["ts"])
    same_event = state["event_id"].eqNullSafe(event["event_id"])
    over = (state["hit"] & ~same_event) | F.coalesce(moment - state["at"] > WINDOW_SECONDS * 1_000_000, F.lit(False))
    ids = F.when(over, F.array().cast("array<bigint>")).otherwise(state["ids"])
    term = F.when(over, F.lit("")).otherwise(state["q"])
    known = F.array_contains(ids, event["product_id"])
    added = F.when(known, ids).otherwise(
        F.slice(F.concat(ids, F.array(event["product_id"])), F.greatest(F.size(ids) + 2 - MAX_TRACKED, F.lit(1)), MAX_TRACKED)
    )
    line = F.struct(
        event["order_id"].alias("order_id"),
        event["item_id"].alias("item_id"),
        event["product_id"].alias("product_id"),
        event["currency"].alias("currency"),
        event["value_cents"].alias("value_cents"),
        term.alias("q"),
        event["ts"].alias("ts"),
    )
    return F.when(
        event["is_mark"],
        F.struct(
            added.alias("ids"),
            F.when(term != "", term).otherwise(event["q"]).alias("q"),
            moment.alias("at"),
            event["event_id"].alias("event_id"),
            F.lit(False).alias("hit"),
            state["found"].alias("found"),
        ).cast(STATE),
    ).otherwise(
        F.struct(
            ids.alias("ids"),
            term.alias("q"),
            F.when(~over, state["at"]).alias("at"),
            event["event_id"].alias("event_id"),
            ((state["hit"] & same_event) | known).alias("hit"),
            F.when(known, F.concat(state["found"], F.array(line))).otherwise(state["found"]).alias("found"),
        ).cast(STATE)
    )


def _fold(events: Column, marker: Column) -> Column:
    """(found, after): the attributed lines of ordered events, and the marker they leave."""
    start = F.struct(
        marker["ids"].alias("ids"),
        marker["q"].alias("q"),
        marker["at"].alias("at"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.lit(False).alias("hit"),
        F.array().alias("found"),
    ).cast(STATE)

    def finish(state: Column) -> Column:
        left = F.struct(state["ids"].alias("ids"), state["q"].alias("q"), state["at"].alias("at")).cast(CARRY)
        return F.struct(state["found"].alias("found"), F.when(state["hit"], empty_marker()).otherwise(left).alias("after"))

    return F.aggregate(events, start, _step, finish)


EVENT_FIELDS = ("ts", "event_id", "item_id", "is_mark", "product_id", "q", "order_id", "currency", "value_cents")


def _collected(events: DataFrame, keys: list[str]) -> DataFrame:
    return events.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*EVENT_FIELDS))).alias("events"))


def _lines(folded: DataFrame) -> DataFrame:
    return folded.select("session_id", F.inline("folded.found"))


def attributed_lines(events: DataFrame, slice_events: int = SLICE_EVENTS) -> DataFrame:
    """(session_id, order_id, item_id, product_id, currency, value_cents, q, ts) of every
    order line a search earned.

    A session of ordinary size is folded in one piece. A session with more events than
    ``slice_events`` goes through ``_sliced_lines``. One combined count decides.
    """
    sizes = events.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    long = sizes.where(F.col("n") > slice_events).select("session_id")
    if long.isEmpty():
        return _lines(_collected(events, ["session_id"]).withColumn("folded", _fold(F.col("events"), empty_marker())))
    ensure_checkpoint_dir(events.sparkSession)
    long = long.checkpoint()
    short = events.join(long, "session_id", "left_anti")
    whole = _lines(_collected(short, ["session_id"]).withColumn("folded", _fold(F.col("events"), empty_marker())))
    return whole.unionByName(_sliced_lines(events.join(long, "session_id", "left_semi"), slice_events))


def _with_slice(events: DataFrame, slice_events: int) -> DataFrame:
    """Adds ``slice``: consecutive seconds of a session, together about ``slice_events``
    events. Counted per second first, so the running total sees one row per second."""
    seconds = events.withColumn("_second", F.unix_seconds("ts"))
    counts = seconds.groupBy("session_id", "_second").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.partitionBy("session_id").orderBy("_second"))
    slices = counts.select(
        "session_id", "_second", F.floor((running - F.col("n")) / F.lit(slice_events)).cast("bigint").alias("slice")
    )
    return seconds.join(slices, ["session_id", "_second"]).drop("_second")


def _sliced_lines(events: DataFrame, slice_events: int) -> DataFrame:
    """Long sessions, slice by slice in parallel.

    Every slice is folded from an empty marker. Then each slice whose predecessor leaves
    another marker than it assumed is folded again with that one, until none changes.
    After n rounds the first n slices of every session are final, so this ends; most
    slices hold an attributed order, behind which the marker no longer depends on what
    came before, so it ends after a few rounds.
    """
    ordered = Window.partitionBy("session_id").orderBy("slice")
    slices = _collected(_with_slice(events, slice_events), ["session_id", "slice"]).withColumn("before", empty_marker())
    state = slices.withColumn("folded", _fold(F.col("events"), F.col("before"))).checkpoint()
    while True:
        left = state.select(
            "session_id", "slice", F.coalesce(F.lag("folded.after").over(ordered), empty_marker()).alias("given")
        )
        stale = state.select("session_id", "slice", "before").join(left, ["session_id", "slice"]).where(
            F.to_json("before") != F.to_json("given")
        )
        stale = stale.select("session_id", "slice", "given").checkpoint()
        if stale.isEmpty():
            return _lines(state)
        redone = state.join(stale, ["session_id", "slice"], "left").withColumn(
            "before", F.coalesce("given", "before")
        )
        refolded = F.when(F.col("given").isNotNull(), _fold(F.col("events"), F.col("before"))).otherwise(F.col("folded"))
        state = redone.withColumn("folded", refolded).drop("given").checkpoint()


# ------------------------------------------------------------------------------ reports


def order_reports(lines: DataFrame) -> DataFrame:
    """(order_id, session_id, value_cents, currency, item_ids, q, occurred_at): one report
    for each time an order was attributed."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("item_id", "product_id"))), lambda row: row["product_id"])
    return lines.groupBy("order_id", "session_id", "currency", "q", F.col("ts").alias("occurred_at")).agg(
        F.sum("value_cents").alias("value_cents"), join_ids(ids).alias("item_ids")
    )


def one_report_per_order(reports: DataFrame, arrival: str = "arrival") -> DataFrame:
    """Upsert by order: the first timestamp and currency stay, value, items and term are
    replaced. ``arrival`` orders the writes."""
    return reports.groupBy("order_id").agg(
        F.min_by("occurred_at", arrival).alias("occurred_at"),
        F.min_by("currency", arrival).alias("currency"),
        F.max_by("value_cents", arrival).alias("value_cents"),
        F.max_by("item_ids", arrival).alias("item_ids"),
        F.max_by("q", arrival).alias("q"),
        F.count(F.lit(1)).alias("writes"),
    )


def received_once(reports: DataFrame) -> DataFrame:
    """What the receiver keeps: one row per store, reference and timestamp."""
    return reports.dropDuplicates(["store_id", "order_ref", "occurred_at"])
