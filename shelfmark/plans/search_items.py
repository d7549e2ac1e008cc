"""The search document job: every requested id as one upsert or delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank
from shelfmark.operators.batches import item_json
from shelfmark.operators.categories import category_names
from shelfmark.operators.content import image_url, permalink
from shelfmark.operators.indexing import ENABLED, SEARCHABLE, members
from shelfmark.operators.popularity import popularity
from shelfmark.operators.pricing import price_rows, with_headline_price
from shelfmark.operators.product_values import product_values
from shelfmark.operators.stock import stock_of
from shelfmark.operators.variants import nested_variants
from shelfmark.sources.catalogue import Catalogue, StoreView

# The fields of a document in wire order. An upsert always has the first five.
FIELDS = (
    "id", "name", "sku", "visible", "in_stock", "price", "currency", "price_exponent", "on_sale", "permalink",
    "image", "description", "brand", "categories", "popularity_score", "attributes", "variants",
)


def documents(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """One document per searchable product, keyed by entity_id.

    All stored values come from one pass (``product_values``); each further field is a left join on entity_id.
    Every side is grouped by entity_id, so large sides meet without a further shuffle.
    """
    values = product_values(catalogue, store).withColumnRenamed("image", "full_image")
    searchable = (F.col("status") == ENABLED) & F.col("visibility").isin(*SEARCHABLE)
    base = members(catalogue, store).join(values.where(searchable).drop("status", "visibility"), "entity_id")
    rows = base.join(price_rows(catalogue.price, store), "entity_id", "left")
    rows = with_headline_price(rows, F.lit(store.currency), F.col("type_id"))
    rows = rows.join(stock_of(catalogue, store, catalogue.entity), "entity_id", "left")
    if catalogue.category_product is not None and catalogue.category_varchar is not None:
        rows = rows.join(category_names(catalogue, store), "entity_id", "left")
    if catalogue.bestsellers is not None:
        rows = rows.join(popularity(catalogue.bestsellers, store.store_id), "entity_id", "left")
    if catalogue.super_link is not None and catalogue.super_attribute is not None:
        rows = rows.join(nested_variants(catalogue, store), "entity_id", "left")
    absent = {"categories": "array<string>", "popularity_score": "bigint"}
    absent["variants"] = (
        "array<struct<id:bigint,sku:string,price:bigint,in_stock:boolean,attributes:map<string,array<string>>>>"
    )
    for name, kind in absent.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    return rows.select(
        "entity_id",
        F.coalesce("name", "sku").alias("name"),
        "sku",
        F.lit(True).alias("visible"),
        F.coalesce("in_stock", F.lit(True)).alias("in_stock"),
        "price",
        "currency",
        "price_exponent",
        F.when(F.col("on_sale"), True).alias("on_sale"),
        permalink(F.col("url_key"), store.base_url, store.url_suffix).alias("permalink"),
        image_url(F.col("small_image"), F.col("full_image"), store.media_url).alias("image"),
        null_if_blank(F.col("description")).alias("description"),
        "brand",
        F.when(F.size("categories") > 0, F.col("categories")).alias("categories"),
        "popularity_score",
        F.when(F.size("attributes") > 0, F.col("attributes")).alias("attributes"),
        F.when(F.size("variants") > 0, F.col("variants")).alias("variants"),
        "price_reject",
    )


def search_items(requested: DataFrame, catalogue: Catalogue, store: StoreView, version: Column | None = None) -> DataFrame:
    """(op, version, id, fields..., price_reject), one row for every row of ``requested``,
    which holds unique entity_id values and may hold a version and further columns.

    An id that is not searchable, for whatever reason, becomes a delete that says no more
    than its id and ``visible`` false.
    """
    stamp = F.col("version") if version is None else version
    found = documents(catalogue, store).withColumn("_found", F.lit(True))
    kept = [F.col(name) for name in requested.columns if name not in ("entity_id", "version")]
    asked = requested.select(F.col("entity_id"), stamp.cast("bigint").alias("version"), *kept)
    hit = F.coalesce("_found", F.lit(False))
    return asked.join(found, "entity_id", "left").select(
        F.when(hit, "upsert").otherwise("delete").alias("op"),
        "version",
        *kept,
        F.col("entity_id").alias("id"),
        *(hit.alias("visible") if name == "visible" else F.col(name) for name in FIELDS if name != "id"),
        "price_reject",
    )


def with_json(items: DataFrame) -> DataFrame:
    """Adds the wire form of each item. Null fields, which is what a delete and an absent
    field have, are left out of it."""
    return items.withColumn("json", item_json(F.col("op"), F.struct(*FIELDS), F.col("version")))


def quarantine(items: DataFrame) -> DataFrame:
    """Items with an amount that cannot be sent as it is, and why. They are sent without
    a price rather than with a wrong one."""
    return items.where(F.col("price_reject").isNotNull()).select("id", F.col("price_reject").alias("reason"))
