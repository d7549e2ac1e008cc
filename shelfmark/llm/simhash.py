"""SimHash near-duplicates: fingerprints linked by BK-trees.

A fingerprint has 64 bits. Two of them within 3 bits agree in at least one of four quarters,
so each goes to four shards, one for the value of each quarter, and a shard holds its
fingerprints in a BK-tree: children are keyed by their integer Hamming distance to the
parent, and a search follows only the edges within the radius. Shard trees grow with the
corpus, so they have no proven bound for a broadcast: a tree is built where the queries of
its shard are, by one shuffle on the shard's key. A shard above ``tree_size`` is dealt again by
the quarters of its other bits, and what is still larger is cut into several trees that meet
in pairs, so a task never holds more than two trees however hot the shard is.

Only distinct fingerprints are searched, and a shard passes on links of its forest, not its
pairs. Exact copies share a fingerprint and are never compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, thrifty, words_of
from shelfmark.llm.components import Forest, components, united

SHINGLE_WORDS = 3
MAX_BITS = 3
TREE_SIZE = 512
SEED = 42
#: Shingles whose bits are counted at a time; it bounds memory and leaves the result as it is.
COUNTED_AT_ONCE = 1 << 14


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit SimHash of a whole text; 0 without words."""
    words = words_of(text)
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(shingle, SEED) for shingle in shingles), "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), COUNTED_AT_ONCE):
        part = hashes[start : start + COUNTED_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


class BKTree:
    """Values under integer Hamming distance; a child hangs on the edge of its distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node, children = self.root
        while distance := (node ^ value).bit_count():
            if distance not in children:
                children[distance] = (value, {})
                return
            node, children = children[distance]

    def within(self, value: int, radius: int) -> list[int]:
        found, waiting = [], [self.root] if self.root else []
        while waiting:
            node, children = waiting.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge, child in children.items():
                if distance - radius <= edge <= distance + radius:
                    waiting.append(child)
        return found


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` for each row of ``docs``, fp the signed long of the fingerprint's bits."""

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bits = np.array([fingerprint(text, shingle_words) for text in frame["text"]], np.uint64)
            yield pd.DataFrame({"id": frame["id"], "fp": bits.astype(np.int64)})

    return (
        docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
        .mapInPandas(thrifty(mapped), "id string, fp long")
        .select(F.col("id").cast("long").alias("doc_id"), "fp")
    )


def _block(fp: str, shift: int, bits: int) -> str:
    return f"(shiftrightunsigned({fp}, {shift}) & {(1 << bits) - 1})"


def _sized(dealt: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of keys that more than one row has, with the number ``n`` of rows."""
    sizes = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return dealt.join(sizes, key)


def _shards(distinct: DataFrame, tree_size: int) -> DataFrame:
    """``shard, slot_a, slot_b, slot, fp``: every two fingerprints within 3 bits meet in a shard.

    The rows of one ``(shard, slot_a, slot_b)`` are at most about two trees.
    """
    quarter = [f"named_struct('part', {i}, 'value', {_block('fp', 16 * i, 16)})" for i in range(4)]
    dealt = distinct.selectExpr("fp", f"explode(array({', '.join(quarter)})) q").selectExpr(
        "fp", "q.part part", "q.value * 4 + q.part shard"
    )
    dealt = stored(_sized(dealt, ["shard"]), "shards")
    small = dealt.where(F.col("n") <= tree_size).selectExpr("shard", "0 slot_a", "0 slot_b", "0 slot", "fp")
    # The other 48 bits, in order, then their quarters of 12: two within 3 bits agree in one of these too.
    rest = (
        "CASE part WHEN 0 THEN shiftrightunsigned(fp, 16)"
        " WHEN 1 THEN (shiftrightunsigned(fp, 32) << 16) | (fp & 65535)"
        " WHEN 2 THEN (shiftrightunsigned(fp, 48) << 32) | (fp & 4294967295)"
        " ELSE fp & 281474976710655 END"
    )
    inner = [f"named_struct('part', {i}, 'value', {_block('rest', 12 * i, 12)})" for i in range(4)]
    large = (
        dealt.where(F.col("n") > tree_size)
        .selectExpr("fp", "shard", f"{rest} rest")
        .selectExpr("fp", "shard", f"explode(array({', '.join(inner)})) q")
        .selectExpr("fp", "((shard * 4096) + q.value) * 4 + q.part + 262144 shard")
    )
    cut = _sized(large, ["shard"]).selectExpr("fp", "shard", f"cast(ceil(n / {tree_size}) as int) trees")
    tiles = (
        cut.selectExpr("fp", "shard", "cast(pmod(xxhash64(fp), trees) as int) slot", "trees")
        .selectExpr("fp", "shard", "slot", "explode(sequence(0, trees - 1)) other")
        .selectExpr("shard", "least(slot, other) slot_a", "greatest(slot, other) slot_b", "slot", "fp")
    )
    return small.union(tiles)


def _linked(radius: int):
    def links_of(rows: list[tuple[int, int]], own: bool) -> list[tuple[int, int]]:
        tree, forest, known = BKTree(), Forest(), rows[0][0]
        inside = [fp for slot, fp in rows if own or slot == known]
        for fp in inside:
            if own:
                for other in tree.within(fp & MASK, radius):
                    forest.unite(fp, other if other < SIGN else other - 2 * SIGN)
            tree.add(fp & MASK)
        if not own:
            for slot, fp in rows:
                if slot != known:
                    for other in tree.within(fp & MASK, radius):
                        forest.unite(fp, other if other < SIGN else other - 2 * SIGN)
        return forest.links()

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for frame in frames:
                yield from zip(*(frame[c].tolist() for c in ("shard", "slot_a", "slot_b", "slot", "fp")), strict=True)

        found = []
        for (_, slot_a, slot_b), group in groupby(rows(), key=lambda row: row[:3]):
            found += links_of([row[3:] for row in group], slot_a == slot_b)
            if len(found) >= 50_000:
                yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
                found = []
        yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return mapped


SIGN = 1 << 63
MASK = (1 << 64) - 1


def near_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Forest links ``a, b`` between distinct longs ``fp`` at ``max_bits`` (3 at most) or fewer differing bits."""
    if max_bits > 3:
        raise ValueError("four quarters find fingerprints within 3 bits")
    groups = ["shard", "slot_a", "slot_b"]
    dealt = _shards(distinct, tree_size).repartition(*groups).sortWithinPartitions(*groups, "slot", "fp")
    linked = _linked(max_bits)
    return dealt.mapInPandas(thrifty(lambda frames: united(linked(frames))), "a long, b long")


def simhash_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, tree_size: int = TREE_SIZE
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs`` (``doc_id, text``).

    Null and empty texts, and texts without words, have fingerprint zero and link like any
    other. Repeated rows each get their row. A null doc_id keeps its row and is never the
    smallest unless its group has no other id: then component_id is null. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(near_fingerprints(distinct.select("fp"), max_bits, tree_size), done=True)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id"
    )
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = stored(rooted.join(firsts, "root").select("fp", "component_id"), "groups")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are the first of their group, all columns kept.

    The document whose id is the group's component_id stays. Of rows that repeat an id any one
    stays. A row without an id cannot be named: such rows stay, one for each text.
    """
    dropped = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    again = groups.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(F.col("_again"))
    single, repeated = kept.join(again, same, "left_anti"), kept.join(again, same, "left_semi")
    return single.unionByName(repeated.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).unionByName(
        repeated.where("doc_id IS NULL").dropDuplicates(["text"])
    )
