"""Exact deduplication and ranked search beside brute force."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup, ranked_search

DOCS = "doc_id long, text string, lang string, keep_id string, own_text string, word long, carried int, query string"


def frame(spark, rows):
    return spark.createDataFrame([(i, text, "en", "x", "y", 1, 2, "z") for i, text in rows], DOCS)


def plain_groups(rows):
    ids = {}
    for i, text in rows:
        ids.setdefault(text or "", []).append(i)
    keep = {t: max((i for i in own if i is not None), default=None) for t, own in ids.items()}
    return Counter((i, keep[t or ""], len(ids[t or ""]), sha256((t or "").encode()).hexdigest()) for i, t in rows)


def exact_rows():
    rng = random.Random(4)
    long = "ab " * 30_000
    texts = ["", None, "a", "A", "a ", "é", "é", long, long + "x", long[:-1] + "y", "line\n", "line\r"]
    # The same length and beginning, another end.
    texts += ["p" * 300 + c for c in "xyz"]
    rows = [(i, rng.choice(texts)) for i in rng.sample(range(1000), 120)]
    return rows + [(2000 + i, "copy of one text") for i in range(300)] + [(5000 + i, f"alone {i}") for i in range(50)]


@pytest.mark.parametrize(("prefix_chars", "bits"), [(256, 1 << 23), (1, 64)])
def test_exact_groups(spark, prefix_chars, bits):
    rows = exact_rows()
    digest = {"sha": F.sha2(F.coalesce("text", F.lit("")), 256)}
    found = exact_dedup.exact_groups(frame(spark, rows), digest, prefix_chars=prefix_chars, bits=bits).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.sha) for r in found) == plain_groups(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_exact_ties_nulls_and_nothing(spark):
    rows = [(None, "t"), (None, "t"), (3, "t"), (3, "t"), (None, "u"), (None, "u"), (None, None), (8, ""), (9, "v")]
    found = exact_dedup.exact_groups(frame(spark, rows), {"text": F.col("text")}).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == Counter((i, k, n) for (i, k, n, _), c in plain_groups(rows).items() for _ in range(c))
    kept = Counter(r.text or "" for r in found if r.kept)
    assert kept == {"t": 1, "u": 1, "": 1, "v": 1}
    assert [(r.doc_id) for r in found if r.kept and r.text == "t"] == [3]
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_exact_groups_use_no_python(spark):
    plan = exact_dedup.exact_groups(frame(spark, exact_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def plain_terms(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_ranked(docs, queries, k=10):
    terms = [(i, Counter(plain_terms(text))) for i, text in docs]
    sizes = [sum(c.values()) for _, c in terms]
    total, words = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in queries:
        scored = []
        for (i, counts), n in zip(terms, sizes, strict=True):
            m = 10 + 90 * n * total // max(1, words)
            score = 0
            for t in set(plain_terms(text)) & counts.keys():
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Été", "naïve", "42", "ÀB"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 30, 200, 900])))) for i in range(n)]
    passage = "Rare passage: w90-w91_w92 W93 (w94) été"
    docs += [(n + i, f"{docs[i][1]} {passage}") for i in range(14)] + [(n + 100 + i, passage) for i in range(20)]
    docs += [(None, passage), (None, None), (3, passage), (3, passage), (n + 300, ""), (n + 301, " \t.,;"), (n + 302, "w1 " * 40_000)]
    queries = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 20])))) for i in range(25)]
    return docs, queries + [(90, passage), (91, None), (92, "nowhere"), (90, "w0"), (93, " ".join(words)), (None, "w5 w5")]


@pytest.mark.parametrize("settings", [{}, {"ordered": 40, "most": 7, "block_chars": 60}, {"k": 3, "ordered": 200, "most": 16}])
def test_ranked_as_plain(spark, settings):
    docs, queries = corpus(260, 6)
    asked = spark.createDataFrame([(i, text, 1) for i, text in queries], "item_id long, text string, doc_id int")
    found = ranked_search.ranked(frame(spark, docs).repartition(5), asked, **settings).collect()
    assert sorted((tuple(row) for row in found), key=repr) == plain_ranked(docs, queries, settings.get("k", 10))


def test_ranked_of_nothing(spark):
    empty, asked = frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.ranked(empty, asked).count() == 0
    assert ranked_search.ranked(frame(spark, [(1, None), (2, "")]), asked).count() == 0
    assert ranked_search.ranked(frame(spark, [(1, "a")]), asked.limit(0)).count() == 0


def test_buckets_are_pruned_by_length(spark):
    """Vectors too short to reach the score are never summed."""
    weights = ranked_search.Weights(100, 100, ranked_search.np.array([5000, 4000, 10]))
    np = ranked_search.np
    sizes = np.array([2, 1, 1])
    terms, impacts = np.array([0, 1, 0, 2]), np.array([900, 900, 100, 1])
    squares = np.bincount([0, 0, 1, 2], weights.values(terms, impacts) ** 2)
    chunk = ranked_search.Chunk(np.arange(3), np.ones(3, bool), squares, sizes, terms, impacts, weights)
    assert [chunk.ids[a:b].tolist() for a, b in chunk.buckets(10)] == [[0], [1], [2]]
    lists = ranked_search.Lists(chunk, 0, 3)
    assert lists.survivors(np.array([0, 1]), 600_000.0).tolist() == [0]
    assert lists.scores(np.array([0, 1]), np.array([0, 1])).tolist() == [8_100_000, 500_000]
