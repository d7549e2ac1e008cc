"""Parent fan-out: when a child changes, its composite parents' documents change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.catalogue import Catalogue

# Fixed value: the link type of grouped members; the others only recommend.
GROUPED_LINK = 3


def parent_links(catalogue: Catalogue) -> DataFrame:
    """(entity_id, parent_id) of the three composite types."""
    grouped = catalogue.product_link.where(F.col("link_type_id") == GROUPED_LINK)
    parts = [
        catalogue.super_link.select(F.col("product_id").alias("entity_id"), "parent_id"),
        catalogue.bundle_selection.select(
            F.col("product_id").alias("entity_id"), F.col("parent_product_id").alias("parent_id")
        ),
        grouped.select(F.col("linked_product_id").alias("entity_id"), F.col("product_id").alias("parent_id")),
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("parent_id") != 0)


def with_parents(ids: DataFrame, catalogue: Catalogue) -> DataFrame:
    """``ids`` and the parents one level up, once each."""
    parents = parent_links(catalogue).join(ids, "entity_id", "left_semi").select(F.col("parent_id").alias("entity_id"))
    return ids.select("entity_id").unionByName(parents).distinct()


def versions_with_parents(versions: DataFrame, catalogue: Catalogue) -> DataFrame:
    """(entity_id, version, first_seq), already one row per id, extended to the parents."""
    inherited = (
        parent_links(catalogue)
        .join(versions, "entity_id")
        .select(F.col("parent_id").alias("entity_id"), "version", "first_seq")
    )
    return (
        versions.select("entity_id", "version", "first_seq")
        .unionByName(inherited)
        .groupBy("entity_id")
        .agg(F.max("version").alias("version"), F.min("first_seq").alias("first_seq"))
    )
