"""Distributed union-find: the smallest member of every connected component.

Each task first unites the links it holds and passes on one link for each member, so a
dense group shrinks before anything is shuffled. Then rounds on the cluster: every node
takes the smallest node beside it as its parent (a combinable minimum), the links are
carried over to the parents, and links inside one parent go. The smallest node of a
component is its own parent in every round and is what remains. No component, and no
list of neighbours, is ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored, thrifty

#: Links that a task unites at a time; it bounds memory and leaves the result as it is.
UNITED_AT_ONCE = 200_000


class Forest:
    """Union-find over any ordered values; the root is the smallest member."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, node):
        parent = self.parent
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while (above := parent.get(node, node)) != root:
            parent[node] = root
            node = above
        return root

    def unite(self, left, right) -> bool:
        left, right = self.find(left), self.find(right)
        if left == right:
            return False
        self.parent[max(left, right)] = min(left, right)
        return True

    def links(self) -> list[tuple]:
        return [(root, node) for node in list(self.parent) if (root := self.find(node)) != node]


def united(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links ``a, b`` of a task as forests: one link for each member."""
    forest, held = Forest(), 0
    for frame in frames:
        for left, right in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            forest.unite(left, right)
        held += len(frame)
        if held >= UNITED_AT_ONCE:
            yield pd.DataFrame(forest.links(), columns=["a", "b"], dtype="int64")
            forest, held = Forest(), 0
    yield pd.DataFrame(forest.links(), columns=["a", "b"], dtype="int64")


def components(links: DataFrame, done: bool = False) -> DataFrame:
    """``node, root`` for every node of ``links`` (longs ``a, b``), root the smallest of its component.

    Nodes without a link to another node are not in the result. Repeated links, links to
    oneself and both directions are allowed; a null end is ignored. ``done``: the Python function that makes
    the links unites them, which saves each task a second Python worker beside the first.
    """
    labels = None
    links = links.where("a <> b")
    while True:
        links = stored(links if done else links.mapInPandas(thrifty(united), "a long, b long"), "links")
        done = False
        if links.isEmpty():
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stored(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("parent")), "parents"
        )
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("root"))
        else:
            above = left.withColumnRenamed("a", "root").withColumnRenamed("pa", "_above")
            labels = stored(
                labels.join(above, "root", "left").select("node", F.coalesce("_above", "root").alias("root")), "labels"
            )
        links = (
            links.join(left, "a")
            .join(right, "b")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .where("a <> b")
            .distinct()
        )
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if labels is None else labels
