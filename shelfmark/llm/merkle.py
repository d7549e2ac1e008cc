"""Merkle manifest of a dataset: leaves by source and doc_id, their proofs, and what a changed row proves.

A leaf's place among those of its source comes from bitmaps: each holds 64 neighbouring ids, is merged by a
combinable OR and has in a directory how many rows stand before it; a place is that number and
the count of lower bits. No row is sorted. Nodes then go to arrays keyed by tree and block, each to
the slot its place gives; a block of ``FAN ** DEPTH`` slots reduces by ``DEPTH`` levels at
once, so a tree of n leaves takes log(n) / log(4096) shuffles of ever fewer nodes. Proofs go the same way back down.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import stored

FAN = 16
#: Levels that one shuffle reduces, and what a task then holds at a time.
DEPTH = 3
#: Ids, then bitmaps, then groups of these that one window adds up.
WINDOW_BITS = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "slots array<int>, siblings array<string>, subroot string"


def leaf_hash(values: list[Column]) -> Column:
    """Hex SHA-256 of each value in UTF-8 behind its byte count and a colon; ``-`` for a null one."""
    texts = [value.cast("string") for value in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def leaves_of(docs: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``id, tree, leaf, changed``: the leaf of every row and, where ``tampered`` holds, that of the row with a lower-cased text.

    ``tree`` is the source behind ``=``, or ``-`` for a null one, so that it sorts null first.
    """
    own = [F.col(name) for name in fields]
    lowered = [F.translate(F.col(name).cast("string"), UPPER, LOWER) if name == "text" else F.col(name) for name in fields]
    return docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        F.unhex(leaf_hash(own)).alias("leaf"),
        F.when(tampered, F.unhex(leaf_hash(lowered))).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )


def _starts(sizes: DataFrame, keys: list[str], left: int) -> DataFrame:
    """``keys, at, start``: how many of ``n`` stand at lower numbers ``at`` of ``left`` bits, in groups of upper bits."""
    before = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if left <= WINDOW_BITS:
        return sizes.select(*keys, "at", before(*keys).alias("start"))
    grouped = sizes.withColumn("up", F.shiftright("at", WINDOW_BITS))
    upper = grouped.groupBy(*keys, "up").agg(F.sum("n").alias("n")).withColumnRenamed("up", "at")
    above = _starts(upper, keys, left - WINDOW_BITS).select(*keys, F.col("at").alias("up"), F.col("start").alias("above"))
    inside = grouped.select(*keys, "at", "up", before(*keys, "up").alias("inside"))
    return inside.join(above, [*keys, "up"]).select(*keys, "at", F.expr("above + inside").alias("start"))


def with_ranks(rows: DataFrame, keys: list[str], orders: list[str]) -> DataFrame:
    """``rows`` and ``rank``: how many rows of the same ``keys`` have a lower ``orders[0]``, then a lower ``orders[1]`` and so on.

    ``orders`` are longs, a null before any; ``keys`` are never null.
    """
    order, later = orders[0], orders[1:]
    bit = f"cast(coalesce({order} & 63, 0) as int)"
    # The lowest long is the number of no bitmap, so it is free for null.
    placed = rows.withColumns({"word": F.expr(f"coalesce(shiftright({order}, 6), {-(1 << 63) + 1}L - 1L)"), "bit": F.expr(bit)})
    words = stored(
        placed.groupBy(*keys, F.col("word").alias("at")).agg(F.count(F.lit(1)).alias("n"), F.expr("bit_or(shiftleft(1L, bit))").alias("mask")), "bitmaps"
    )
    ranked = words.join(_starts(words.select(*keys, "at", "n"), keys, 64), [*keys, "at"]).withColumnRenamed("at", "word")
    repeated = words.where("n > bit_count(mask)").select(*keys, F.col("at").alias("word"))
    rank = "start + bit_count(mask & ~shiftleft(-1L, bit))"
    if repeated.isEmpty():
        joined = placed.join(ranked.drop("n").hint("shuffle_hash"), [*keys, "word"])
        return joined.selectExpr(*rows.columns, f"{rank} rank")
    # Ids that more than one row has: how many more count for the higher ids of their bitmap.
    twice = stored(
        placed.join(repeated, [*keys, "word"], "left_semi").groupBy(*keys, "word", "bit").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "repeated"
    )
    more = twice.groupBy(*keys, "word").agg(F.expr("collect_list(struct(bit b, c - 1 more))").alias("more"))
    joined = placed.join(ranked.drop("n").join(more, [*keys, "word"], "left").hint("shuffle_hash"), [*keys, "word"])
    extra = "aggregate(filter(coalesce(more, array()), x -> x.b < bit), 0L, (s, x) -> s + x.more)"
    joined = stored(joined.selectExpr(*rows.columns, "word", "bit", f"{rank} + {extra} rank"), "ranks")
    if not later:
        return joined.drop("word", "bit")
    single = joined.join(twice, [*keys, "word", "bit"], "left_anti").select(*rows.columns, "rank")
    tied = joined.join(twice.drop("c"), [*keys, "word", "bit"], "left_semi")
    tied = tied.withColumnsRenamed({"word": f"{order}_word", "bit": f"{order}_bit", "rank": f"{order}_rank"})
    tied = with_ranks(tied, [*keys, f"{order}_word", f"{order}_bit"], later)
    return single.union(tied.selectExpr(*rows.columns, f"{order}_rank + rank rank"))


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _slots(ranks: list[int], nodes: list[bytes], span: int) -> list[str]:
    """The nodes of one block, each in the slot of its place."""
    slots = [""] * len(nodes)
    for rank, node in zip(ranks, nodes, strict=True):
        slots[rank % span] = node.hex()
    return slots


def _levels(slots: list[str], block: int, fan: int, depth: int) -> list[list[str]]:
    """The levels of a block from its slots up to its one node.

    A first block that is not full is a whole tree and ends as soon as one node is left; every other block has ``depth`` levels.
    """
    whole = block == 0 and len(slots) < fan**depth
    levels = [slots]
    while len(levels[-1]) > 1 if whole else len(levels) <= depth:
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def _steps(levels: list[list[str]], at: int, fan: int) -> tuple[list[int], list[str]]:
    """Slot and joined siblings on every level from slot ``at`` up."""
    slots, siblings = [], []
    for level in levels[:-1]:
        first = at // fan * fan
        slots.append(at - first)
        siblings.append("".join(level[first:at] + level[at + 1 : first + fan]))
        at //= fan
    return slots, siblings


def _blocked(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"rank div {fan**depth}"))


def _reduced(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """The nodes of the next table up, one for each block of ``nodes``."""

    def reduce(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        slots = _slots(frame["rank"].tolist(), frame["node"].tolist(), fan**depth)
        top = _levels(slots, int(key[1]), fan, depth)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "rank": [int(key[1])], "node": [bytes.fromhex(top)]})

    blocked = _blocked(nodes.select("tree", "rank", "node"), fan, depth)
    return blocked.groupBy("tree", "block").applyInPandas(reduce, "tree string, rank long, node binary")


def tables_of(nodes: DataFrame, fan: int = FAN, depth: int = DEPTH) -> list[DataFrame]:
    """``tree, rank, node`` of the given nodes, then of each table above, the last with one node for each tree."""
    tables = [nodes]
    while not tables[-1].where("rank > 0").isEmpty():
        tables.append(stored(_reduced(tables[-1], fan, depth), "nodes"))
    return tables


def _upper(above: pd.DataFrame) -> tuple[list[int], list[str], str | None]:
    """Slots, siblings and subroot of the one path above a block."""
    return above["slots"].iloc[0].tolist(), above["siblings"].iloc[0].tolist(), above["subroot"].iloc[0]


def _descended(nodes: DataFrame, paths: DataFrame, fan: int, depth: int) -> DataFrame:
    """``tree, rank`` and path of ``nodes``, from the ``paths`` of the table above."""

    def descend(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        ranks = frame["rank"].tolist()
        levels = _levels(_slots(ranks, frame["node"].tolist(), fan**depth), int(key[1]), fan, depth)
        over, beside, subroot = _upper(above)
        steps = [_steps(levels, rank % fan**depth, fan) for rank in ranks]
        return pd.DataFrame(
            {"tree": key[0], "rank": ranks, "slots": [s + over for s, _ in steps], "siblings": [s + beside for _, s in steps], "subroot": subroot}
        )

    blocked = _blocked(nodes.select("tree", "rank", "node"), fan, depth).groupBy("tree", "block")
    return blocked.cogroup(paths.withColumnRenamed("rank", "block").groupBy("tree", "block")).applyInPandas(descend, f"tree string, rank long, {PATH}")


def paths_of(tables: list[DataFrame], roots: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """``tree, rank`` and path of the nodes above the first table's blocks; ``roots`` has those of the last table."""
    paths = roots
    for nodes in reversed(tables[1:-1]):
        paths = stored(_descended(nodes, paths, fan, depth), "paths")
    return paths


@dataclass
class Manifest:
    """``leaves`` (``id, tree, node, changed, rank``), the node tables of all sources' trees, those of the tree over the sources, and its ``names`` (``tree, rank, node``)."""

    leaves: DataFrame
    trees: list[DataFrame]
    top: list[DataFrame]
    names: DataFrame
    fan: int = FAN
    depth: int = DEPTH

    def root(self) -> str | None:
        """Hex of the root; none of an empty dataset."""
        found = self.top[-1].first()
        return found and bytes(found["node"]).hex()


def _ordered(subroots: DataFrame) -> DataFrame:
    """``tree, rank, node``: sources in order, numbered by their place in sorted parts."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = stored(subroots.orderBy("tree").select("tree", "node", F.spark_partition_id().alias("part"), place.alias("at")), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return stored(parts.join(starts, "part").selectExpr("tree", "start + at rank", "node"), "subroots")


def manifest(leaves: DataFrame, fan: int = FAN, depth: int = DEPTH) -> Manifest:
    """The manifest over ``id, tree, leaf, changed, row`` of ``leaves_of``.

    Within a source leaves ascend by id, a null one first; rows that repeat an id are in the order of their leaves.
    """
    prefix = "cast(conv(hex(substring(node, 1, 7)), 16, 10) as bigint) prefix"
    leaves = stored(leaves.withColumnRenamed("leaf", "node").selectExpr("*", prefix), "leaves")
    ranked = stored(with_ranks(leaves, ["tree"], ["id", "prefix", "row"]), "ranked")
    trees = tables_of(ranked, fan, depth)
    names = _ordered(trees[-1])
    top = tables_of(names.select(F.lit("").alias("tree"), "rank", "node"), fan, depth)
    return Manifest(ranked, trees, top, names, fan, depth)


def proofs(made: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every leaf of a manifest.

    Digests are lowercase hex. ``proof_sha256`` hashes the leaf's siblings, level by level up to the root, left to
    right; ``folded_root`` folds the changed leaf, else the leaf, with them, and ``verified`` says whether that is the root.
    """
    fan, depth = made.fan, made.depth
    span, root = fan**depth, made.root()
    none = ("cast(array() as array<int>) slots", "cast(array() as array<string>) siblings", "cast(null as string) subroot")
    over = _descended(made.top[0], paths_of(made.top, made.top[-1].selectExpr("tree", "rank", *none), fan, depth), fan, depth)
    roots = over.drop("tree", "subroot").join(made.names, "rank")
    roots = stored(roots.selectExpr("tree", "0L rank", "slots", "siblings", "lower(hex(node)) subroot"), "roots")
    paths = paths_of(made.trees, roots, fan, depth)

    def finish(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        ranks = frame["rank"].tolist()
        levels = _levels(_slots(ranks, frame["leaf"].tolist(), span), int(key[1]), fan, depth)
        over, beside, subroot = _upper(above)
        upper = "".join(beside)
        leaves, shown, folded = [], [], []
        for rank, changed in zip(ranks, frame["changed"].tolist(), strict=True):
            slots, siblings = _steps(levels, rank % span, fan)
            leaves.append(leaf := levels[0][rank % span])
            shown.append(_hash("".join(siblings) + upper))
            node = leaf if changed is None else changed.hex()
            for slot, others in zip(slots + over, siblings + beside, strict=True):
                node = _hash(others[: 64 * slot] + node + others[64 * slot :])
            folded.append(node)
        return pd.DataFrame({"id": frame["id"], "leaf": leaves, "subroot": subroot, "proof_sha256": shown, "folded_root": folded})

    # Ids go as texts: pandas would make a column of longs with a null in it one of doubles.
    leaves = made.leaves.select(F.col("id").cast("string").alias("id"), "tree", "rank", F.col("node").alias("leaf"), "changed")
    blocked = _blocked(leaves, fan, depth).groupBy("tree", "block")
    above = paths.withColumnRenamed("rank", "block").groupBy("tree", "block")
    done = blocked.cogroup(above).applyInPandas(finish, "id string, leaf string, subroot string, proof_sha256 string, folded_root string")
    return done.select(
        F.col("id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )


def proven(docs: DataFrame, tampered: Column) -> DataFrame:
    """``proofs`` of a manifest over all rows of ``docs``, of which those where ``tampered`` holds are checked in changed form.

    Any of the fields may be null; a null doc_id comes before any other. Rows that repeat a doc_id are leaves of their
    own. An empty table gives an empty result; further columns are not read.
    """
    return proofs(manifest(leaves_of(docs, tampered)))
