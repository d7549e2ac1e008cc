"""The Merkle manifest beside a plain one: all nodes in lists, paths by position."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long, tree string, word int, node binary"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lowered=False):
    doc_id, text, lang, source, n_chars = row
    if lowered and text is not None:
        text = "".join(c.lower() if c.isascii() else c for c in text)
    values = (doc_id, source, lang, n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def reduced(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + fan])) for i in range(0, len(levels[-1]), fan)])
    return levels


def path(levels, at, fan):
    for level in levels[:-1]:
        first = at // fan * fan
        yield level[first:at], level[at + 1 : first + fan]
        at //= fan


def plain(rows, fan):
    """Result rows, by brute force."""
    sources = sorted({row[3] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: reduced([leaf(r) for r in own[s]], fan) for s in sources}
    top = reduced([trees[s][-1][0] for s in sources], fan)
    out = []
    for number, source in enumerate(sources):
        for at, row in enumerate(own[source]):
            steps = [*path(trees[source], at, fan), *path(top, number, fan)]
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf(row, bad)
            for left, right in steps:
                node = digest("".join([*left, node, *right]))
            shown = digest("".join("".join(left + right) for left, right in steps))
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[source][-1][0], root, shown, node, node == root))
    return sorted(out, key=repr)


def found(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, 7, "t", 3, b"x") for row in rows], DOCS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = merkle.manifest(merkle.leaves_of(frame, tampered), **settings)
    return made, sorted((tuple(row) for row in merkle.proofs(made).collect()), key=repr)


def documents(n, sources, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(-3 * n, 4 * n), n - 3) + [-(1 << 63), (1 << 63) - 1, 1 << 40]
    texts = ["Mixed Case", "lower", "", None, "Été À\n", "long " * 5000]
    return [(i, rng.choice(texts), rng.choice(["en", None]), rng.choice(sources), rng.choice([4, None])) for i in ids]


@pytest.mark.parametrize(("fan", "depth"), [(2, 2), (16, 3), (3, 1)])
def test_manifest_as_plain(spark, fan, depth):
    rows = documents(90, ["a", "b", "ß", "", None, "A"] + ["hot"] * 6, 3) + [(1000, "Lone", "en", "lone", 4)]
    _, result = found(spark, rows, fan=fan, depth=depth)
    assert result == plain(rows, fan)
    assert {row[6] for row in result} == {True, False}


def test_many_sources(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 41}", 6) for i in range(120)]
    assert found(spark, rows, fan=2, depth=2)[1] == plain(rows, 2)


def test_repeated_and_null_ids(spark):
    """Rows that repeat an id stand in the order of their leaves; equal rows are leaves too."""
    rng = random.Random(9)
    rows = [(rng.choice([None, 5, 6, 64, 70, 1000]), rng.choice(["A b", "c D", "e", None]), "en", "s", 3) for _ in range(60)]
    assert found(spark, rows, fan=4, depth=2)[1] == plain(rows, 4)


def test_one_leaf_and_none(spark):
    made, result = found(spark, [(4, None, None, None, None)])
    assert result == plain([(4, None, None, None, None)], 16)
    assert made.root() == result[0][1]
    made, result = found(spark, [])
    assert (made.root(), result) == (None, [])


def test_ranks_of_sparse_longs(spark):
    rng = random.Random(2)
    values = [None, -(1 << 63), (1 << 63) - 1, -1, 0, 63, 64, *(rng.getrandbits(63) for _ in range(200))]
    rows = spark.createDataFrame([(k, v) for v in values for k in ("a", "b")], "k string, v long")
    ranked = merkle.with_ranks(rows, ["k"], ["v"]).collect()
    order = {v: i for i, v in enumerate(sorted(values, key=lambda v: (v is not None, v or 0)))}
    assert {(r.k, r.v, r["rank"]) for r in ranked} == {(k, v, i) for v, i in order.items() for k in ("a", "b")}
