"""Configurable children as variants of their parent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import trimmed
from shelfmark.operators.lookups import lookup_join
from shelfmark.operators.pricing import price_rows, with_headline_price
from shelfmark.operators.scope import attribute_labels, in_scope, own_and_default
from shelfmark.operators.stock import stock_of
from shelfmark.sources.catalogue import Catalogue, StoreView

# Groups that a parent's children are gathered in before its document is put together.
SALTS = 64


def variant_rows(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(parent_id, id, sku, price, in_stock), one row per link to a child with a price.

    A child without a price row cannot be bought in this scope and is left out. Whether
    the child is itself enabled or visible does not matter.
    """
    children = catalogue.super_link.join(
        catalogue.entity.select(F.col("entity_id").alias("product_id"), "sku"), "product_id"
    ).select("parent_id", F.col("product_id").alias("entity_id"), "sku")
    priced = with_headline_price(
        children.join(price_rows(catalogue.price, store), "entity_id"), F.lit(store.currency), F.lit("simple")
    ).where(F.col("price").isNotNull())
    stock = stock_of(catalogue, store, children.select("entity_id", "sku").distinct())
    return priced.join(stock, "entity_id", "left").select(
        "parent_id",
        F.col("entity_id").alias("id"),
        "sku",
        "price",
        F.coalesce("in_stock", F.lit(True)).alias("in_stock"),
    )


def variant_options(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(parent_id, id, attribute_id, label, value): what each child chooses for the
    attributes its own parent varies by. Values are the children's default rows."""
    labelled = attribute_labels(
        catalogue.attribute.where(F.col("entity_type_code") == "catalog_product"),
        catalogue.attribute_label,
        store.store_id,
    ).select("attribute_id", trimmed(F.col("label")).alias("label"))
    varied = catalogue.super_attribute.select(F.col("product_id").alias("parent_id"), "attribute_id")
    metadata = [table for table in (catalogue.attribute, catalogue.attribute_label) if table is not None]
    asked = lookup_join(
        catalogue.super_link.select("parent_id", F.col("product_id").alias("entity_id")).join(varied, "parent_id"),
        labelled.where(F.col("label") != ""),
        ["attribute_id"],
        spread_by="entity_id",
        how="inner",
        sized_by=metadata,
    )
    # Only values of attributes that some parent varies by are worth shuffling.
    used = labelled.join(varied.select("attribute_id").distinct(), "attribute_id", "left_semi").select("attribute_id")
    chosen = lookup_join(
        catalogue.eav_int.where(F.col("store_id") == 0),
        used,
        ["attribute_id"],
        spread_by="entity_id",
        how="left_semi",
        sized_by=metadata,
    ).select("entity_id", "attribute_id", F.col("value").alias("option_id"))
    texts = (
        catalogue.option_value.where(in_scope(store.store_id))
        .groupBy("option_id")
        .agg(*own_and_default(store.store_id))
        .select("option_id", trimmed(F.coalesce("_own", "_default")).alias("value"))
        .where(F.col("value") != "")
    )
    return lookup_join(
        asked.join(chosen, ["entity_id", "attribute_id"]),
        texts,
        ["option_id"],
        spread_by="entity_id",
        how="inner",
        sized_by=[catalogue.option_value],
    ).select("parent_id", F.col("entity_id").alias("id"), "attribute_id", "label", "value")


def option_maps(options: DataFrame) -> DataFrame:
    """(parent_id, id, attributes): label -> distinct values. Attributes that share a
    label add to one list."""
    placed = F.array_sort(F.collect_list(F.struct("attribute_id", "value")))
    return (
        options.repartition("parent_id", "id")
        .groupBy("parent_id", "id", "label")
        .agg(F.array_distinct(F.transform(placed, lambda row: row["value"])).alias("values"))
        .groupBy("parent_id", "id")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "values")))).alias("attributes"))
    )


def nested_variants(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, variants): each parent's variants by child id, one row for a parent.

    Children are gathered in groups by child id first, so that what one task gathers of a
    parent with very many children is a share of them; only the finished array, which is
    one field of one document, is whole in one place.
    """
    flat = variant_rows(catalogue, store).join(
        option_maps(variant_options(catalogue, store)), ["parent_id", "id"], "left"
    )
    variant = F.struct("id", "sku", "price", "in_stock", "attributes")
    shares = flat.groupBy("parent_id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("_share")).agg(
        F.collect_list(variant).alias("_variants")
    )
    return shares.groupBy(F.col("parent_id").alias("entity_id")).agg(
        F.array_sort(
            F.flatten(F.collect_list("_variants")),
            lambda left, right: F.when(left["id"] < right["id"], -1).when(left["id"] > right["id"], 1).otherwise(0),
        ).alias("variants")
    )
