"""Change sources: which tables are watched, and how each row becomes a changed id."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The watched tables and the column that holds the changed product's id.
WATCHED = {
    "catalog_product_entity": "entity_id",
    "catalog_product_entity_datetime": "entity_id",
    "catalog_product_entity_decimal": "entity_id",
    "catalog_product_entity_int": "entity_id",
    "catalog_product_entity_text": "entity_id",
    "catalog_product_entity_varchar": "entity_id",
    "catalog_product_super_link": "product_id",
    "catalog_product_bundle_selection": "product_id",
    "catalog_product_link": "product_id",
    "catalog_product_website": "product_id",
    "catalog_category_product": "product_id",
    "catalogrule_product_price": "product_id",
    "catalog_product_entity_tier_price": "entity_id",
    "cataloginventory_stock_item": "product_id",
}


def changed_ids(rows: DataFrame, table: str, moment: str = "ts") -> DataFrame:
    """The bare id, the table it came from and the time of one table's change rows."""
    return rows.select(
        F.col(WATCHED[table]).try_cast("bigint").alias("entity_id"),
        F.lit(table).alias("source_table"),
        F.col(moment).alias("ts"),
    )


def union_changes(read: Callable[[str], DataFrame], tables: list[str] | None = None, moment: str = "ts") -> DataFrame:
    """All watched tables' changes in one frame; batch and streaming frames both fit."""
    parts = [changed_ids(read(table), table, moment) for table in (tables or list(WATCHED))]
    return reduce(DataFrame.unionByName, parts)


def stream_changes(
    spark: SparkSession, folder: str, tables: list[str] | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """A stream over change files laid out as ``{folder}/{table}/*.parquet``."""

    def read(table: str) -> DataFrame:
        schema = f"{WATCHED[table]} bigint, ts timestamp"
        return (
            spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/{table}")
        )

    return union_changes(read, tables)
