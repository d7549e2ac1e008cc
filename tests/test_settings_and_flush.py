"""Settings by scope and by time, and the flush of reports, against plain loops."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import attribution, delivery, settings
from shelfmark.operators.scans import last_before
from shelfmark.plans.queries import catalogue_of, flushed
from shelfmark.plans.search_items import documents

START = dt.datetime(2026, 1, 20)


@pytest.mark.parametrize("bits", [22, 36, 50])
def test_last_before_matches_a_plain_search(spark, bits):
    rng = random.Random(bits)
    at = lambda: START + dt.timedelta(seconds=rng.randint(0, 400))
    changes = [(rng.choice([1, 1, 2, 3]), at(), seq, rng.choice(["a", "b", None])) for seq in range(60)]
    facts = [(n, rng.choice([1, 2, 3, 4]), at()) for n in range(200)]
    left = spark.createDataFrame(facts, "n bigint, k bigint, at timestamp")
    right = spark.createDataFrame(changes, "k bigint, at timestamp, seq bigint, value string")
    found = {r.n: r.state and (r.state.seq, r.state.value) for r in last_before(left, right, ["k"], "at", "state", bits=bits).collect()}
    for n, key, moment in facts:
        before = [(when, seq, value) for own, when, seq, value in changes if own == key and when <= moment]
        assert found[n] == (max(before)[1:] if before else None)


def test_attribution_asks_for_the_consent_of_the_moment(spark):
    """A mark made before sharing was switched on is not one; sharing switched off later does not undo one."""
    hour = lambda n: START + dt.timedelta(hours=n)
    history = spark.createDataFrame(
        [(7, hour(1), 1, True, False), (7, hour(3), 2, True, True), (7, hour(9), 3, True, False)],
        "store_id bigint, ts timestamp, seq bigint, connected boolean, share_search_data boolean",
    )
    marks = spark.createDataFrame(
        [(7, 1, 10, hour(2), 100, "early"), (7, 1, 11, hour(4), 200, "late"), (7, 2, 12, hour(5), 300, "x")],
        "store_id bigint, session_id bigint, event_id bigint, ts timestamp, product_id bigint, q string",
    )
    lines = spark.createDataFrame(
        [(7, 1, 20, hour(6), 1, 1, 100, "USD", 5), (7, 1, 20, hour(6), 1, 2, 200, "USD", 9), (7, 2, 21, hour(10), 2, 1, 300, "USD", 4)],
        "store_id bigint, session_id bigint, event_id bigint, ts timestamp, order_id bigint, item_id bigint, product_id bigint, currency string, value_cents bigint",
    )
    gated = [attribution.consenting(rows, history) for rows in (marks, lines)]
    found = attribution.attributed_lines(attribution.session_events(*gated)).collect()
    assert [(r.order_id, r.item_id, r.q) for r in found] == [(1, 2, "late")]


def test_flush_matches_a_plain_loop(spark):
    rng = random.Random(4)
    now = START + dt.timedelta(days=10)
    rows = []
    for number in range(400):
        age = rng.choice([1, 2, 3, 9])
        stored = "no time" if rng.random() < 0.1 else (now - dt.timedelta(days=age)).strftime("%Y-%m-%d %H:%M:%S")
        rows.append((rng.randint(1, 30), number, now - dt.timedelta(days=age), stored, rng.choice([202, 202, 202, 409, 422, None])))
    willing = set(range(1, 28))
    frame = spark.createDataFrame(rows, "store_id bigint, id bigint, occurred_at timestamp, stored string, status int")
    consent = spark.createDataFrame([(s, True, s in willing) for s in range(1, 31)], "store_id bigint, connected boolean, share_search_data boolean")
    result = delivery.report_flush(frame.drop("status"), consent, frame, F.lit(now).cast("timestamp"), limit=6)
    expected = {}
    for store in range(1, 31):
        taken, stopped = 0, False
        for _, number, when, stored, status in sorted(r for r in rows if r[0] == store):
            if store not in willing:
                expected[number] = "gated"
            elif when < now - dt.timedelta(days=7):
                expected[number] = "abandoned"
            elif stopped or taken == 6:
                expected[number] = "waiting"
            else:
                taken += 1
                if stored == "no time":
                    expected[number] = "unreadable"
                elif status in (None, 409):
                    expected[number], stopped = "retry", True
                else:
                    expected[number] = "sent" if status == 202 else "dropped"
    assert {r.id: r.outcome for r in result.collect()} == expected
    assert set(expected.values()) == {"gated", "abandoned", "waiting", "unreadable", "retry", "sent", "dropped"}
    left = {r.id for r in delivery.reports_left(result).collect()}
    assert left == {n for n, outcome in expected.items() if outcome in ("gated", "waiting", "retry")}


def test_flush_of_the_given_tables_has_every_outcome(shop):
    assert {r.outcome for r in flushed(shop).select("outcome").distinct().collect()} >= {"gated", "abandoned", "sent"}


def test_nearest_scope_wins(spark):
    stores = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "store_id bigint, website_id bigint")
    rows = [("default", 0, "p", "d"), ("websites", 10, "p", "w"), ("stores", 2, "p", ""), ("stores", 1, "p", None), ("stores", 10, "p", "x"), ("default", 0, "q", "other")]
    config = spark.createDataFrame(rows, "scope string, scope_id bigint, path string, value string")
    found = settings.scoped_settings(stores, config, {"p": "p", "r": "r"})
    assert {(r.store_id, r.p, r.r) for r in found.collect()} == {(1, "w", None), (2, "", None), (3, "d", None)}


def test_documents_of_two_store_views(shop):
    views = settings.store_views(shop["store"], shop["scoped_config"])
    one, other = (settings.view_of(views, store_id) for store_id in (1, 3))
    assert one.currency != other.currency
    for view in (one, other):
        # The given price index and websites know website 1.
        rows = documents(catalogue_of(shop), replace(view, website_id=1, website_code="base")).limit(5).collect()
        assert rows and all(r.currency in (None, view.currency) and r.permalink.startswith(view.base_url) for r in rows)
    with pytest.raises(ValueError, match="no store view"):
        settings.view_of(views, 999)
