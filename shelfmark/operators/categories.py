"""Category names of each product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import trimmed
from shelfmark.operators.lookups import lookup_join
from shelfmark.operators.scope import scoped_wide
from shelfmark.sources.catalogue import Catalogue, StoreView

TREE_ROOT = 1


def category_names(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """Names by position, then category id; trimmed, without blanks, each name once.

    The tree's root and the store's root hold every product and say nothing. A product's
    list can be no longer than the category tree.
    """
    ids = catalogue.ids("name", entity_type="catalog_category")
    names = scoped_wide(catalogue.category_varchar, ids, store.store_id, either=("name",)).select(F.col("entity_id").alias("category_id"), trimmed(F.col("name")).alias("name"))
    membership = catalogue.category_product.where(~F.col("category_id").isin(TREE_ROOT, store.root_category_id))
    placed = lookup_join(
        membership.select("product_id", "category_id", "position"),
        names.where(F.col("name") != ""),
        ["category_id"],
        spread_by="product_id",
        how="inner",
        sized_by=[catalogue.category_varchar],
    )
    ordered = F.array_sort(F.collect_list(F.struct("position", "category_id", "name")))
    return placed.groupBy(F.col("product_id").alias("entity_id")).agg(
        F.array_distinct(F.transform(ordered, lambda row: row["name"])).alias("categories")
    )
