"""Search-to-order attribution as a stream, with one marker per session as keyed state.

Events of a session are taken in (ts, event_id, item_id) order within a micro-batch and in
arrival order between batches. All lines of one order arrive together. What one call
gathers is bounded by the source's rate option, not by the session.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfmark.operators.attribution import MAX_TRACKED, WINDOW_SECONDS
from shelfmark.schemas import ATTRIBUTED_LINE, MARKER

WINDOW_MS = WINDOW_SECONDS * 1000


def _expiry(marked: int) -> int:
    """The timer, in milliseconds, of a marker last touched at ``marked`` microseconds."""
    return int(marked) // 1000 + WINDOW_MS + 1


class SessionMarker(StatefulProcessor):
    """Keeps (ids, q, at in microseconds) per session and emits attributed order lines."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.marker = handle.getValueState("marker", MARKER)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["ts", "event_id", "item_id"], na_position="first")
        stored = self.marker.get() if self.marker.exists() else None
        ids, term, marked = (list(stored[0]), stored[1], stored[2]) if stored else ([], "", None)
        found = []
        for (ts, _), group in groupby(events.itertuples(index=False), key=lambda row: (row.ts, row.event_id)):
            event, moment = list(group), ts.value // 1000
            if marked is not None and moment - marked > WINDOW_SECONDS * 1_000_000:
                ids, term, marked = [], "", None
            if event[0].is_mark:
                for row in event:
                    if row.product_id not in ids:
                        ids = [*ids, int(row.product_id)][-MAX_TRACKED:]
                    term = term or row.q
                marked = moment
                continue
            hits = [row for row in event if row.product_id in ids]
            if hits:
                found += [
                    (key[0], row.order_id, row.item_id, row.product_id, row.currency, row.value_cents, term, ts)
                    for row in hits
                ]
                ids, term, marked = [], "", None
        if stored:
            self.handle.deleteTimer(_expiry(stored[2]))
        if marked is None:
            self.marker.clear()
        else:
            self.marker.update((ids, term, int(marked)))
            self.handle.registerTimer(_expiry(marked))
        if found:
            whole = {"order_id": "int64", "item_id": "int64", "value_cents": "int64"}
            yield pd.DataFrame(found, columns=ATTRIBUTED_LINE.names).astype(whole)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget a marker whose 7 days have passed."""
        self.marker.clear()
        return iter(())

    def close(self) -> None:
        pass


def attributed_stream(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Attributed order lines of a stream of session events (see ``session_events``).

    Needs the RocksDB state store provider, which this kind of state is kept in. A mark has
    no order, item or value; it gets zeros, because a column of longs with nulls would reach
    Python as doubles and round ids and amounts.
    """
    whole = {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in ("order_id", "item_id", "value_cents")}
    return (
        events.withColumns(whole)
        .withWatermark("ts", lateness)
        .groupBy("session_id")
        .transformWithStateInPandas(
            statefulProcessor=SessionMarker(), outputStructType=ATTRIBUTED_LINE, outputMode="append", timeMode="eventTime"
        )
    )


def received_stream(reports: DataFrame) -> DataFrame:
    """Reports kept once per store, reference and timestamp, and none older than 7 days."""
    return reports.withWatermark("occurred_at", "7 days").dropDuplicatesWithinWatermark(
        ["store_id", "order_ref", "occurred_at"]
    )
