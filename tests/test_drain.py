"""The drain: a run against a plain loop, its log, and the stream against the batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import drain, queue
from shelfmark.streaming.drain_stream import latest_rows, queue_changes

LOG = "seq bigint, object_type string, object_id bigint, store_id bigint, ts timestamp, kind string, version bigint"
START = dt.datetime(2026, 1, 20)
NOW = START + dt.timedelta(seconds=4000)


def log_rows(n, seed, objects=12):
    rng, rows = random.Random(seed), []
    for seq in range(1, n + 1):
        kind = rng.choice(["enqueue", "enqueue", "claim", "complete", "release"])
        version = seq * 10 if kind == "enqueue" else max(1, seq - rng.randint(0, 40)) * 10
        key = (rng.choice(["product", "page"]), rng.randint(1, objects), rng.randint(0, 1))
        rows.append((seq, *key, START + dt.timedelta(seconds=seq * 10), kind, version))
    return rows


def plain_rows(log, now):
    """The queue after a log, one entry at a time, stalled rows back in line."""
    held = {}
    for seq, *key, ts, kind, version in sorted(log):
        key = tuple(key)
        found = held.get(key)
        if kind == "enqueue":
            if found is None:
                held[key] = dict(created=seq, first=version, version=version, claimed=None, attempts=0)
            else:
                found.update(version=version, claimed=None)
        elif found is None or version < found["first"]:
            continue
        elif kind == "complete":
            if found["version"] <= version:
                del held[key]
        elif kind == "release":
            found.update(claimed=None, attempts=found["attempts"] + 1)
        else:
            found["claimed"] = ts
    for found in held.values():
        if found["claimed"] and (now - found["claimed"]).total_seconds() > 900:
            found["claimed"] = None
    return held


def plain_round(held, size, status, sent=lambda key: 1, budget=None):
    """A run as a loop: claim, send, complete, until a batch fails or there is nothing left."""
    line = sorted((row["created"], key) for key, row in held.items() if row["claimed"] is None)
    outcomes = {key: "held" for key, row in held.items() if row["claimed"] is not None}
    stopped = False
    for number in range(0, -(-len(line) // size)):
        batch = [key for _, key in line[number * size : (number + 1) * size]]
        if stopped or (budget is not None and number >= budget):
            outcomes |= dict.fromkeys(batch, "waiting")
        elif sum(map(sent, batch)) and not 200 <= status.get(number, 0) <= 299:
            outcomes |= dict.fromkeys(batch, "released")
            stopped = True
        else:
            outcomes |= dict.fromkeys(batch, "completed")
    return outcomes


def states(frame):
    return {(r.object_type, r.object_id, r.store_id): (r.created_seq, r.version, r.status, r.attempts) for r in frame.collect()}


@pytest.mark.parametrize(
    ("status", "budget"), [({0: 202, 1: 202, 2: 503, 3: 202}, None), ({0: 202}, None), ({n: 202 for n in range(20)}, 3), ({0: 429}, None)]
)
def test_round_matches_a_plain_loop(spark, status, budget):
    log = log_rows(300, 5)
    frame = spark.createDataFrame(log, LOG)
    now = F.lit(NOW).cast("timestamp")
    held = plain_rows(log, NOW)
    state = queue.queue_state(frame, drain.QUEUE_KEYS)
    # Objects 1 and 2 make no item; a batch of nothing but these is not sent.
    makes = (F.col("object_id") > 2).cast("int")
    answers = spark.createDataFrame(list(status.items()), "batch_no bigint, status int")
    drained = drain.drain_round(drain.batches_in_line(state, now, makes, size=4).checkpoint(), answers, budget)
    expected = plain_round(held, 4, status, lambda key: key[1] > 2, budget)
    rows = drained.collect()
    assert {(r.object_type, r.object_id, r.store_id): r.outcome for r in rows} == expected
    left = states(drain.queue_after(drained))
    assert left == {
        key: (row["created"], row["version"], "sending" if row["claimed"] else "pending", row["attempts"] + (expected[key] == "released"))
        for key, row in held.items()
        if expected[key] != "completed"
    }
    # The run's own entries behind the log fold to the same queue.
    added = drain.round_log(drained, F.lit(300), now)
    again = queue.requeue_stalled(queue.queue_state(frame.unionByName(added.select(frame.columns)), drain.QUEUE_KEYS), now)
    assert states(again) == left
    summary = drain.round_summary(drained).collect()[0]
    assert summary.failed == ("released" in expected.values())
    assert summary.released == list(expected.values()).count("released")
    assert summary["items"] == sum(v == "completed" and k[1] > 2 for k, v in expected.items())


def test_next_round_starts_with_what_was_released(spark):
    log = [(seq, "product", seq, 0, START, "enqueue", seq) for seq in range(1, 8)]
    state = queue.queue_state(spark.createDataFrame(log, LOG), drain.QUEUE_KEYS)
    now = F.lit(NOW).cast("timestamp")
    answer = lambda *codes: spark.createDataFrame(list(enumerate(codes)), "batch_no bigint, status int")
    first = drain.queue_after(drain.drain_round(drain.batches_in_line(state, now, size=3), answer(202, 503, 202)))
    assert {(r.object_id, r.attempts) for r in first.collect()} == {(4, 1), (5, 1), (6, 1), (7, 0)}
    second = drain.drain_round(drain.batches_in_line(first, now, size=3), answer(202, 202))
    assert drain.queue_after(second).count() == 0


def test_queue_stream_equals_batch(spark, folder):
    """Micro-batches of the log, the last one long after: its watermark takes stalled claims back."""
    log = log_rows(240, 8, objects=5)
    later = START + dt.timedelta(hours=5)
    ends = [(1000 + i, "page", 99, 0, later + dt.timedelta(minutes=i), "enqueue", (1000 + i) * 10) for i in range(2)]
    for part in (log[:100], log[100:180], log[180:], ends[:1], ends[1:]):
        spark.createDataFrame(part, LOG).coalesce(1).write.parquet(f"{folder}/in", mode="append")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    queue_changes(stream).writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    changes = spark.read.parquet(f"{folder}/out")
    batch = queue.queue_state(spark.createDataFrame(log + ends, LOG), drain.QUEUE_KEYS)
    expected = queue.requeue_stalled(batch, F.lit(later).cast("timestamp"))
    assert states(latest_rows(changes)) == states(expected)
    assert states(expected) != states(batch)
    assert changes.where("expired").count() > 0
