"""Stock: one answer per product from whichever source serves the store's website."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.catalogue import Catalogue, StoreView

DEFAULT_STOCK = 1


def legacy_stock(stock_status: DataFrame) -> DataFrame:
    """Salable in any website or stock counts as salable."""
    return (
        stock_status.groupBy(F.col("product_id").alias("entity_id"))
        .agg(F.max("stock_status").alias("_top"))
        .select("entity_id", (F.col("_top") != 0).alias("in_stock"))
    )


def stock_by_sku(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """The answer of a per-stock table, which knows SKUs only. SKUs match exactly,
    including their case. A product that is not in the table gets no row."""
    salable = inventory.select("sku", (F.col("is_salable") != 0).alias("in_stock"))
    return products.select("entity_id", "sku").join(salable, "sku").select("entity_id", "in_stock")


def stock_id_of(channel: DataFrame | None, website_code: str) -> int:
    """The stock a website sells from, read when the plan is built: one configuration row
    decides which table the plan reads."""
    if channel is None or website_code == "":
        return DEFAULT_STOCK
    row = (
        channel.where((F.col("type") == "website") & (F.col("code") == website_code))
        .orderBy("stock_id")
        .select("stock_id")
        .first()
    )
    return row[0] if row else DEFAULT_STOCK


def stock_of(catalogue: Catalogue, store: StoreView, products: DataFrame) -> DataFrame:
    """(entity_id, in_stock) for ``products`` (entity_id, sku). A custom stock that has a
    table answers by SKU; the default stock and everything else answers by product."""
    code = store.website_code
    stock_id = catalogue.once(f"stock of {code}", lambda: stock_id_of(catalogue.stock_channel, code))
    if stock_id > DEFAULT_STOCK and stock_id in catalogue.inventory_stock:
        return stock_by_sku(catalogue.inventory_stock[stock_id], products)
    return legacy_stock(catalogue.stock_status)
