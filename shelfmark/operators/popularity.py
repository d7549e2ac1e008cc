"""Units sold per product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL_STORES = 0


def popularity(bestsellers: DataFrame, store_id: int) -> DataFrame:
    """The store's own total where it has one, else the all-stores rollup.

    The rollup already contains every store, so the two are never added. A product with
    neither has no row: no sales figure is not the same as 0 sold.
    """
    own = F.sum(F.when(F.col("store_id") == store_id, F.col("qty_ordered")))
    rollup = F.sum(F.when(F.col("store_id") == ALL_STORES, F.col("qty_ordered")))
    return (
        bestsellers.where(F.col("store_id").isin(ALL_STORES, store_id))
        .groupBy(F.col("product_id").alias("entity_id"))
        .agg(own.alias("_own"), rollup.alias("_rollup"))
        .select("entity_id", F.round(F.coalesce("_own", "_rollup"), 0).cast("bigint").alias("popularity_score"))
        .where(F.col("popularity_score").isNotNull())
    )
