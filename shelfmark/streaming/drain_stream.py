"""The queue as a stream of its log, with one row per key as keyed state and a timer on every claim."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType

from shelfmark.operators.drain import QUEUE_KEYS
from shelfmark.operators.queue import STALE_SECONDS
from shelfmark.schemas import row

# What is kept of a row; claimed is in milliseconds, 0 when it is not being sent.
HELD_ROW = row(
    created_seq=LongType(), first_version=LongType(), version=LongType(), attempts=LongType(), claimed=LongType(),
    seq=LongType(),
)
CHANGE = row(
    object_type=StringType(), object_id=LongType(), store_id=LongType(), seq=LongType(), expired=BooleanType(),
    created_seq=LongType(), version=LongType(), status=StringType(), attempts=LongType(),
)


class QueueRow(StatefulProcessor):
    """Folds a key's log and emits the row it leaves: ``pending``, ``sending`` or ``gone``.

    A claim that no answer follows within ``seconds`` is taken back by its timer.
    """

    def __init__(self, seconds: int = STALE_SECONDS) -> None:
        self.wait = seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("row", HELD_ROW)

    def _expiry(self, claimed: int) -> int:
        return claimed + self.wait + 1

    @staticmethod
    def _step(held: dict | None, event) -> dict | None:
        seq, kind, version = int(event.seq), event.kind, int(event.version)
        if kind == "enqueue":
            if held is None:
                return dict(created_seq=seq, first_version=version, version=version, attempts=0, claimed=0, seq=seq)
            return held | dict(version=version, claimed=0, seq=seq)
        if held is None or version < held["first_version"]:
            return held
        if kind == "complete":
            return None if held["version"] <= version else held | dict(seq=seq)
        if kind == "release":
            return held | dict(attempts=held["attempts"] + 1, claimed=0, seq=seq)
        return held | dict(claimed=event.ts.value // 1_000_000, seq=seq)

    @staticmethod
    def _emitted(key, held: dict, status: str, expired: bool) -> Iterator[pd.DataFrame]:
        fields = [held[name] for name in ("created_seq", "version")]
        yield pd.DataFrame([(*key, held["seq"], expired, *fields, status, held["attempts"])], columns=CHANGE.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values("seq")
        stored = dict(zip(HELD_ROW.names, map(int, self.held.get()), strict=True)) if self.held.exists() else None
        held, last = stored, stored
        for event in events.itertuples(index=False):
            held = self._step(held, event)
            last = held or (last and last | dict(seq=int(event.seq)))
        if stored and stored["claimed"]:
            self.handle.deleteTimer(self._expiry(stored["claimed"]))
        if held is None:
            self.held.clear()
            return self._emitted(key, last, "gone", False) if last else iter(())
        self.held.update(tuple(held[name] for name in HELD_ROW.names))
        if held["claimed"]:
            self.handle.registerTimer(self._expiry(held["claimed"]))
        return self._emitted(key, held, "sending" if held["claimed"] else "pending", False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.held.exists():
            return iter(())
        held = dict(zip(HELD_ROW.names, map(int, self.held.get()), strict=True))
        if not held["claimed"] or self._expiry(held["claimed"]) > expiredTimerInfo.getExpiryTimeInMs():
            return iter(())
        held["claimed"] = 0
        self.held.update(tuple(held[name] for name in HELD_ROW.names))
        return self._emitted(key, held, "pending", True)

    def close(self) -> None:
        pass


def queue_changes(log: DataFrame, lateness: str = "0 seconds", seconds: int = STALE_SECONDS) -> DataFrame:
    """The row that each micro-batch, or a timer, leaves of every key it touches.

    ``log`` streams (seq, ts, kind, version) by object_type, object_id and store_id; entries of a key arrive in the order
    of seq from one micro-batch to the next. Needs the RocksDB state store provider.
    """
    return (
        log.withWatermark("ts", lateness)
        .groupBy(*QUEUE_KEYS)
        .transformWithStateInPandas(
            statefulProcessor=QueueRow(seconds), outputStructType=CHANGE, outputMode="append", timeMode="eventTime"
        )
    )


def latest_rows(changes: DataFrame) -> DataFrame:
    """The queue from all that ``queue_changes`` wrote: the last row of each key that is not gone."""
    last = F.max_by(F.struct("created_seq", "version", "status", "attempts"), F.struct("seq", "expired"))
    return changes.groupBy(*QUEUE_KEYS).agg(last.alias("last")).select(*QUEUE_KEYS, "last.*").where("status <> 'gone'")
