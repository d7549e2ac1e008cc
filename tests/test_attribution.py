"""The session fold against golden sequences, a plain fold, slices and a stream."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shelfmark.operators import attribution as A
from shelfmark.streaming.session_stream import attributed_stream

START = dt.datetime(2026, 1, 1)
MARKS = "session_id bigint, event_id bigint, ts timestamp, product_id bigint, q string"
LINES = (
    "session_id bigint, event_id bigint, ts timestamp, order_id bigint, item_id bigint, product_id bigint,"
    " currency string, value_cents bigint"
)


def at(days=0.0, seconds=0.0):
    return START + dt.timedelta(days=days, seconds=seconds)


def frames(spark, marks, lines):
    return A.session_events(spark.createDataFrame(marks, MARKS), spark.createDataFrame(lines, LINES))


def line(event, ts, product, item=1, session=1, order=None):
    return (session, event, ts, order or event, item, product, "USD", 100)


def rows_of(frame):
    return sorted((r.session_id, r.order_id, r.item_id, r.product_id, r.q, r.ts) for r in frame.collect())


def plain_fold(marks, lines):
    """The rules, one event at a time."""
    events = [(m[2], m[1], 0, "mark", m) for m in marks] + [(o[2], o[1], o[4], "line", o) for o in lines]
    found = []
    for session in {e[4][0] for e in events}:
        ids, term, marked = [], "", None
        own = sorted(e for e in events if e[4][0] == session)
        for ts, event_id in sorted({(e[0], e[1]) for e in own}):
            group = [e for e in own if e[:2] == (ts, event_id)]
            if marked is not None and ts - marked > dt.timedelta(days=7):
                ids, term, marked = [], "", None
            if group[0][3] == "mark":
                m = group[0][4]
                if m[3] not in ids:
                    ids.append(m[3])
                ids = ids[-25:]
                term = term or m[4]
                marked = ts
            else:
                hits = [e[4] for e in group if e[4][5] in ids]
                found += [(session, o[3], o[4], o[5], term, ts) for o in hits]
                if hits:
                    ids, term, marked = [], "", None
    return sorted(found)


def random_events(seed, sessions=3, n=400, products=40, span_days=40):
    rng = random.Random(seed)
    marks, lines = [], []
    for event in range(1, n + 1):
        ts = at(seconds=int(event * span_days * 86400 / n))
        session = rng.choice([1, 1, 1, *range(1, sessions + 1)])
        if rng.random() < 0.8:
            marks.append((session, event, ts, rng.randint(1, products), rng.choice(["", f"term {event}"])))
        else:
            lines += [line(event, ts, rng.randint(1, products * 3), item, session) for item in range(rng.randint(1, 3))]
    return marks, lines


def test_golden_sequences(spark):
    cases = [
        ([(at(0), 1, "yoga"), (at(1), 2, "towel")], [(at(2), [1, 2, 3])], [("yoga", [1, 2])]),
        ([(at(0), 1, ""), (at(1), 2, "mat")], [(at(1, 60), [1])], [("mat", [1])]),
        ([(at(0), 1, "a")], [(at(7), [1])], [("a", [1])]),
        ([(at(0), 1, "a")], [(at(7, 1), [1])], []),
        ([(at(0), 1, "a"), (at(8), 2, "b")], [(at(8, 60), [1, 2])], [("b", [2])]),
        ([(at(0), 1, "a")], [(at(1), [9]), (at(2), [1])], [("a", [1])]),
        ([(at(0), 1, "a")], [(at(1), [1]), (at(2), [1])], [("a", [1])]),
        ([(at(0, i), i, "t") for i in range(1, 27)], [(at(1), [1, 26])], [("t", [26])]),
    ]
    marks, lines, expected = [], [], []
    for session, (marked, bought, found) in enumerate(cases, 1):
        base = session * 1000
        marks += [(session, base + i, ts, product, q) for i, (ts, product, q) in enumerate(marked)]
        for i, (ts, products) in enumerate(bought):
            lines += [line(base + 500 + i, ts, p, item, session) for item, p in enumerate(products, 1)]
        expected += [(session, q, product) for q, products in found for product in products]
    got = A.attributed_lines(frames(spark, marks, lines))
    assert sorted((r.session_id, r.q, r.product_id) for r in got.collect()) == sorted(expected)


def test_child_lines_are_ignored(spark):
    rows = [(1, None, 5), (1, 1, 5), (1, 0, 6), (0, None, 7)]
    lines = spark.createDataFrame(rows, "order_id bigint, parent_item_id bigint, product_id bigint")
    assert sorted(r.product_id for r in A.parent_lines(lines).collect()) == [5, 6]


def test_fold_matches_plain_fold_whole_and_sliced(spark, folder):
    for seed in (1, 2):
        marks, lines = random_events(seed)
        expected = plain_fold(marks, lines)
        assert expected
        shuffled = list(marks)
        random.Random(seed).shuffle(shuffled)
        events = frames(spark, shuffled, lines)
        assert rows_of(A.attributed_lines(events)) == expected
        # Session 1 holds most events: cut into slices of a few events each.
        assert rows_of(A.attributed_lines(events, slice_events=40)) == expected


def test_slices_with_no_order_in_them(spark):
    """A marker that passes unchanged through many slices reaches the last one."""
    marks = [(1, i, at(seconds=i), i % 7 + 1, "first" if i == 1 else "later") for i in range(1, 200)]
    lines = [line(500, at(1), 3)]
    events = frames(spark, marks, lines)
    assert rows_of(A.attributed_lines(events, slice_events=30)) == plain_fold(marks, lines)


def test_stream_equals_batch(spark, folder):
    marks, lines = random_events(3, sessions=5, n=300)
    # Amounts that a double cannot hold, beside marks that have none.
    events = frames(spark, marks, lines).withColumn("value_cents", F.col("value_cents") + F.lit(2**53 + 1))
    expected = rows_of(A.attributed_lines(events))
    values = [r.value_cents for r in A.attributed_lines(events).orderBy("order_id", "item_id", "value_cents").collect()]
    assert any(v % 2 for v in values) and min(values) > 2**53
    cut = [at(0), at(15), at(30), at(400)]
    for part, (low, high) in enumerate(zip(cut, cut[1:])):
        chosen = events.where((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))
        chosen.coalesce(1).write.mode("append").parquet(f"{folder}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    query = (
        attributed_stream(stream)
        .writeStream.format("parquet")
        .option("path", f"{folder}/lines")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.parquet(f"{folder}/lines")
    assert rows_of(found) == expected
    assert [r.value_cents for r in found.orderBy("order_id", "item_id", "value_cents").collect()] == values


def test_order_value_and_reports(spark):
    lines = spark.createDataFrame(
        [
            (1, 1, None, 5, "19.9900", "5.0000"),
            (1, 2, None, 6, "3.0000", "9.0000"),
            (1, 3, 1, 5, "19.9900", "0.0000"),
            (1, 4, None, 5, "1.0050", None),
        ],
        "order_id bigint, item_id bigint, parent_item_id bigint, product_id bigint, total string, off string",
    ).select(
        "order_id", "item_id", "parent_item_id", "product_id",
        F.col("total").cast("decimal(12,4)").alias("row_total_incl_tax"),
        F.lit(None).cast("decimal(12,4)").alias("row_total"),
        F.col("off").cast("decimal(12,4)").alias("discount_amount"),
    )
    orders = spark.createDataFrame(
        [(1, 7, "", " usd ")], "order_id bigint, session_id bigint, order_currency string, base_currency string"
    )
    marks = spark.createDataFrame([(7, 5), (7, 6)], "session_id bigint, product_id bigint")
    got = A.attributed_order_value(lines, orders, marks).collect()
    assert [(r.currency, r.value_cents, r.item_ids) for r in got] == [("USD", 1499 + 0 + 101, "5,6,5")]


def test_one_report_per_order_keeps_the_first_time(spark):
    rows = [(1, 10, at(0), "USD", 5, "1", "a"), (1, 20, at(3), "EUR", 7, "1,2", "b")]
    reports = spark.createDataFrame(
        rows, "order_id bigint, arrival bigint, occurred_at timestamp, currency string, value_cents bigint, item_ids string, q string"
    )
    row = A.one_report_per_order(reports).collect()[0]
    assert (row.occurred_at, row.currency, row.value_cents, row.item_ids, row.q, row.writes) == (
        at(0), "USD", 7, "1,2", "b", 2,
    )
