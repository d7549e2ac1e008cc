"""Prices of the price index: which column is the headline, and what is on sale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.money import currency_code, exponent_of, is_currency, round_minor
from shelfmark.sources.catalogue import StoreView

GUEST_GROUP = 0
# Fixed value: a discount smaller than this is noise in a four-decimal column.
SALE_MARGIN = "0.001"


def price_rows(price: DataFrame, store: StoreView) -> DataFrame:
    """The guest prices of the store's website."""
    return price.where((F.col("customer_group_id") == GUEST_GROUP) & (F.col("website_id") == store.website_id)).select(
        "entity_id", "price", "final_price", "min_price"
    )


def headline_amount(type_id: Column, final_price: Column, min_price: Column) -> Column:
    """``final_price`` wherever it says something: a grouped product has none and a
    bundle has 0, and both show ``min_price``."""
    amount = F.coalesce(final_price, min_price)
    return F.when((type_id == "bundle") | (amount <= 0), min_price).otherwise(amount)


def on_sale(price: Column, final_price: Column) -> Column:
    return F.coalesce(final_price < price - F.lit(SALE_MARGIN).cast("decimal(4,3)"), F.lit(False))


def with_headline_price(rows: DataFrame, currency: Column, type_id: Column) -> DataFrame:
    """Adds price, currency and price_exponent, which are all set or all null, on_sale,
    and price_reject with the reason when an amount cannot be sent.

    The amount is rounded to the currency's own exponent.
    """
    amount = headline_amount(type_id, F.col("final_price"), F.col("min_price"))
    rows = rows.withColumns({"_amount": amount, "_places": exponent_of(currency)})
    amount, places = F.col("_amount"), F.col("_places")
    reject = (
        F.when(amount.isNull(), F.lit(None).cast("string"))
        .when(~F.coalesce(is_currency(currency), F.lit(False)), "bad currency")
        .when(amount < 0, "negative price")
    )
    sendable = amount.isNotNull() & reject.isNull()
    return rows.withColumns(
        {
            "_minor": F.when(sendable, round_minor(amount, currency, places)),
            "currency": F.when(sendable, currency_code(currency)),
            "price_exponent": F.when(sendable, places),
            "on_sale": on_sale(F.col("price"), F.col("final_price")),
            "price_reject": reject,
        }
    ).drop("price", "final_price", "min_price", "_amount", "_places").withColumnRenamed("_minor", "price")


def headline_prices(price: DataFrame, entity: DataFrame, store: StoreView, currency: Column | None = None) -> DataFrame:
    rows = price_rows(price, store).join(entity.select("entity_id", "type_id"), "entity_id")
    return with_headline_price(rows, F.lit(store.currency) if currency is None else currency, F.col("type_id"))


def price_range(prices: DataFrame, variants: DataFrame) -> DataFrame:
    """The least and greatest price over each product and its variants. ``prices`` holds
    (entity_id, price) of the products, ``variants`` (parent_id, price)."""
    own = prices.select("entity_id", "price")
    nested = variants.select(F.col("parent_id").alias("entity_id"), "price")
    spread = nested.join(own.select("entity_id"), "entity_id", "left_semi")
    return (
        own.unionByName(spread)
        .groupBy("entity_id")
        .agg(F.min("price").alias("price_min"), F.max("price").alias("price_max"))
    )
