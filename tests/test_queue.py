"""Scans, the queue, changes and batches against plain Python."""

import json
import random

from pyspark.sql import functions as F

from shelfmark.operators import batches, changes, delivery, queue
from shelfmark.operators.ids import normalise_ids
from shelfmark.operators.lookups import lookup_join
from shelfmark.operators.parents import with_parents
from shelfmark.operators.scans import max_before, with_position


def test_position_and_running_max_over_many_buckets(spark):
    rng = random.Random(1)
    ids = rng.sample(range(-5_000, 10_000), 500)
    rows = [(i, rng.choice("aab"), rng.choice([None, rng.randint(1, 99)])) for i in ids]
    frame = spark.createDataFrame(rows, "id bigint, k string, v bigint")
    placed = {r.id: r.position for r in with_position(frame, "id", bits=5).collect()}
    assert placed == {i: n for n, i in enumerate(sorted(ids))}
    got = {r.id: r.top for r in max_before(frame, ["k"], "id", F.col("v"), "top", bits=5).collect()}
    for i, k, _ in rows:
        earlier = [v for j, other, v in rows if other == k and j < i and v is not None]
        assert got[i] == max(earlier, default=None)


def test_lookup_join_is_the_same_salted(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(300)], "id bigint, k bigint")
    dimension = spark.createDataFrame([(1, "hot"), (3, "x"), (6, "y")], "k bigint, label string")
    plain = lookup_join(facts, dimension, ["k"], "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = lookup_join(facts, dimension, ["k"], "id", salts=4)
        assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_normalise_ids(spark):
    rows = spark.createDataFrame([("5", 3), ("0", 1), ("x", 2), ("5", 1), ("7", 0)], "id string, place int")
    got = {(r.entity_id, r.ordinal) for r in normalise_ids(rows, "id", "place").collect()}
    assert got == {(5, 1), (7, 0)}
    assert sorted(r.entity_id for r in normalise_ids(rows, "id").collect()) == [5, 7]


def plain_queue(log):
    """The queue after a log of (seq, object, kind, version), one event at a time."""
    held = {}
    for seq, key, kind, version in sorted(log):
        row = held.get(key)
        if kind == "enqueue":
            if row is None:
                held[key] = dict(created=seq, first=version, version=version, status="pending", attempts=0)
            else:
                row.update(version=version, status="pending")
        elif row is None or version < row["first"]:
            continue
        elif kind == "complete":
            if row["version"] <= version:
                del held[key]
        elif kind == "release":
            row.update(status="pending", attempts=row["attempts"] + 1)
        else:
            row["status"] = "sending"
    return {(k, r["created"], r["version"], r["status"], r["attempts"]) for k, r in held.items()}


def test_queue_state_matches_a_plain_fold(spark):
    for seed in range(3):
        rng = random.Random(seed)
        log = []
        for seq in range(1, 600):
            kind = rng.choice(["enqueue", "enqueue", "claim", "complete", "release"])
            version = seq * 10 if kind == "enqueue" else max(1, seq - rng.randint(0, 60)) * 10
            log.append((seq, rng.choice([1, 1, 1, 2, 3, 4, 5]), kind, version))
        rng.shuffle(log)
        frame = spark.createDataFrame(log, "seq bigint, object_id bigint, kind string, version bigint").withColumn(
            "ts", F.timestamp_seconds("seq")
        )
        got = queue.queue_state(frame).collect()
        assert {(r.object_id, r.created_seq, r.version, r.status, r.attempts) for r in got} == plain_queue(log)
        assert all((r.claimed_at is not None) == (r.status == "sending") for r in got)


def test_requeue_stalled(spark):
    rows = [(1, "sending", 0), (2, "sending", 100), (3, "sending", 101), (4, "pending", None)]
    frame = spark.createDataFrame(rows, "id int, status string, at bigint").select(
        "id", "status", F.timestamp_seconds("at").alias("claimed_at")
    )
    got = queue.requeue_stalled(frame, F.timestamp_seconds(F.lit(1000)))
    assert {(r.id, r.status) for r in got.collect()} == {
        (1, "pending"), (2, "sending"), (3, "sending"), (4, "pending"),
    }


def test_merge_queue_later_write_wins(spark):
    names = "object_type string, object_id bigint, store_id bigint, op string, version bigint, status string, attempts bigint, first_seq bigint"
    stored = spark.createDataFrame(
        [("product", 1, 0, "upsert", 5, "sending", 3, 1), ("product", 2, 0, "upsert", 9, "pending", 1, 2)], names
    )
    incoming = spark.createDataFrame(
        [("product", 1, 0, "upsert", 5, "pending", 0, 8), ("product", 3, 0, "upsert", 7, "pending", 0, 9)], names
    )
    got = {tuple(r) for r in changes.merge_queue(stored, incoming).collect()}
    assert got == {
        ("product", 1, 0, "upsert", 5, "pending", 3, 1),
        ("product", 2, 0, "upsert", 9, "pending", 1, 2),
        ("product", 3, 0, "upsert", 7, "pending", 0, 9),
    }


def test_current_documents_skip_stale_writes(spark):
    rows = [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 3, "c"), (2, 1, 4, "d"), (2, 2, 5, "e")]
    frame = spark.createDataFrame(rows, "id bigint, version bigint, arrival bigint, doc string")
    got = {(r.id, r.version, r.doc) for r in changes.current_documents(frame, "id", "version", "arrival", ["doc"]).collect()}
    assert got == {(1, 5, "a"), (2, 2, "e")}


def test_parents_one_level_and_grouped_only(spark, shop):
    from shelfmark.plans.queries import catalogue_of

    catalogue = catalogue_of(shop)
    ids = spark.createDataFrame([(21,), (90,), (98,), (4,)], "entity_id bigint")
    got = {r.entity_id for r in with_parents(ids, catalogue).collect()}
    # 21 is a variant of 20, 90 a member of group 89, 98 a choice in bundle 97; 4 only recommends 5.
    assert got == {21, 20, 90, 89, 98, 97, 4}


def test_resync_starts_one_walk_per_request(spark):
    polls = [
        (1, 1, True, "a", 0), (1, 2, True, "a", 5), (1, 3, True, "b", 5), (1, 4, True, "c", 0), (1, 5, False, "d", 0),
        (1, 6, True, "", 0), (1, 7, True, "c", 0), (2, 1, True, "a", 9),
    ]
    frame = spark.createDataFrame(polls, "install_id bigint, seq bigint, required boolean, token string, pending bigint")
    got = {(r.install_id, r.seq): (r.acted, r.walk_started) for r in changes.resync_requests(frame).collect()}
    assert got == {
        (1, 1): (True, True), (1, 2): (False, False), (1, 3): (True, False), (1, 4): (True, True),
        (1, 7): (False, False), (2, 1): (True, True),
    }


def test_batches_hold_at_most_a_hundred_in_order(spark, folder):
    ids = random.Random(2).sample(range(1, 100_000), 1234)
    rows = spark.createDataFrame([(i,) for i in ids], "object_id bigint")
    numbered = batches.assign_batches(rows).withColumn("json", F.to_json(F.struct("object_id")))
    bodies = batches.batch_bodies(numbered)
    batches.write_bodies(bodies, f"{folder}/out")
    read = [json.loads(r.value)["items"] for r in spark.read.text(f"{folder}/out").collect()]
    assert sorted(map(len, read)) == [34] + [100] * 12
    assert [i["object_id"] for b in sorted(read, key=lambda b: b[0]["object_id"]) for i in b] == sorted(ids)


def test_delivered_prefix_stops_at_the_first_retry(spark):
    answers = spark.createDataFrame([(1, 202), (2, 422), (3, 429), (4, 202)], "id bigint, status int")
    assert sorted(r.id for r in delivery.delivered_prefix(answers).collect()) == [1, 2]
    calm = answers.where("status <> 429")
    assert sorted(r.id for r in delivery.delivered_prefix(calm).collect()) == [1, 2, 4]


def test_reports_expire_after_seven_days(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1)], "order_id bigint, at bigint").select(
        "order_id", F.timestamp_seconds("at").alias("occurred_at")
    )
    now = F.timestamp_seconds(F.lit(7 * 86400 + 1))
    assert delivery.expiry_counts(rows, now).collect()[0].asDict() == {"kept": 1, "abandoned": 1}


def test_positions_of_sparse_ids_of_64_bits(spark):
    """Ids over the whole range of a long, with buckets far smaller than the range."""
    rng = random.Random(8)
    ids = sorted({rng.getrandbits(64) - (1 << 63) for _ in range(300)} | set(range(-5, 40)))
    rows = spark.createDataFrame([(i,) for i in ids], "object_id bigint")
    for bits in (13, 18):
        found = {r.object_id: r.position for r in with_position(rows, "object_id", bits=bits).collect()}
        assert found == {i: n for n, i in enumerate(ids)}
