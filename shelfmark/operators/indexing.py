"""Which products are searchable in a store view, and which must leave the index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ids import normalise_ids
from shelfmark.operators.scope import scoped_wide
from shelfmark.sources.catalogue import Catalogue, StoreView

# Enabled, and the visibilities "search" and "catalogue and search".
ENABLED = 1
SEARCHABLE = (3, 4)


def members(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, sku, type_id) of the products in the store's website."""
    placed = catalogue.website.where(F.col("website_id") == store.website_id).select(F.col("product_id").alias("entity_id"))
    return catalogue.entity.select("entity_id", "sku", "type_id").join(placed, "entity_id", "left_semi")


def indexable(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """Products in the store's website that are enabled and visible in search there."""
    codes = ("status", "visibility")
    flags = scoped_wide(catalogue.eav_int, catalogue.ids(*codes), store.store_id, either=codes).where(
        (F.col("status") == ENABLED) & F.col("visibility").isin(*SEARCHABLE)
    )
    return members(catalogue, store).join(flags.select("entity_id"), "entity_id")


def indexable_products(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """The same with the scoped name, which stays null when there is none."""
    names = scoped_wide(catalogue.eav_varchar, catalogue.ids("name"), store.store_id, either=("name",))
    return indexable(catalogue, store).join(names, "entity_id", "left")


def split_requested(requested: DataFrame, searchable: DataFrame) -> DataFrame:
    """Every requested id with ``op``: upsert when searchable, else delete, for whatever
    reason it is not. One left join answers both."""
    hits = searchable.select("entity_id", F.lit(True).alias("_found"))
    return requested.join(hits, "entity_id", "left").withColumn(
        "op", F.when(F.col("_found"), "upsert").otherwise("delete")
    ).drop("_found")


def tombstones(changes: DataFrame, catalogue: Catalogue, store: StoreView) -> DataFrame:
    """Changed ids that no longer resolve to a searchable product."""
    return normalise_ids(changes).join(indexable(catalogue, store), "entity_id", "left_anti")


def billable_count(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """Catalogue rows, searchable products and the difference."""
    searchable = indexable(catalogue, store)
    return (
        split_requested(catalogue.entity.select("entity_id"), searchable)
        .agg(
            F.count(F.lit(1)).alias("catalogue_rows"),
            F.count_if(F.col("op") == "upsert").alias("billable"),
        )
        .withColumn("not_indexed", F.col("catalogue_rows") - F.col("billable"))
    )
