"""The catalogue tables as one bundle, the store view they are read for, and readers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schemas import SOURCES, STOCK_TABLE

DEFAULT_SUFFIX = ".html"
SUFFIX_PATH = "catalog/seo/product_url_suffix"

# The attributes a document names.
PRODUCT_ATTRIBUTES = (
    "name", "description", "short_description", "manufacturer", "image", "small_image", "status", "visibility",
    "url_key",
)
CATEGORY_ATTRIBUTES = ("name",)


@dataclass(frozen=True)
class StoreView:
    """What a store view fixes: its ids, its addresses, its currency."""

    store_id: int = 1
    website_id: int = 1
    website_code: str = "base"
    root_category_id: int = 2
    base_url: str = "https://shop.example/"
    media_url: str = "https://shop.example/media/"
    currency: str = "USD"
    url_suffix: str = DEFAULT_SUFFIX


@dataclass(frozen=True)
class Catalogue:
    """Source tables. A table a shop does not have is None, and its fields stay absent."""

    entity: DataFrame
    website: DataFrame
    eav_int: DataFrame
    eav_varchar: DataFrame
    eav_text: DataFrame
    attribute: DataFrame
    option: DataFrame
    option_value: DataFrame
    price: DataFrame
    stock_status: DataFrame
    attribute_label: DataFrame | None = None
    stock_channel: DataFrame | None = None
    bestsellers: DataFrame | None = None
    super_link: DataFrame | None = None
    super_attribute: DataFrame | None = None
    bundle_selection: DataFrame | None = None
    product_link: DataFrame | None = None
    category_product: DataFrame | None = None
    category_varchar: DataFrame | None = None
    inventory_stock: dict[int, DataFrame] = field(default_factory=dict)

    @cached_property
    def attribute_ids(self) -> dict[tuple[str, str], int]:
        """(entity type, code) -> id of the attributes the document names: at most one
        row each, read once when a plan is built so that the ids are pushed as literals."""
        named = F.col("attribute_code").isin(*PRODUCT_ATTRIBUTES, *CATEGORY_ATTRIBUTES)
        rows = self.attribute.where(named).select("entity_type_code", "attribute_code", "attribute_id").collect()
        return {(row[0], row[1]): row[2] for row in rows}

    def once(self, name: str, read: Callable):
        """What ``read`` found in the tables when a plan of this bundle first asked; a new bundle reads anew."""
        found = self.__dict__.setdefault("_once", {})
        if name not in found:
            found[name] = read()
        return found[name]

    def ids(self, *codes: str, entity_type: str = "catalog_product") -> dict[str, int | None]:
        return {code: self.attribute_ids.get((entity_type, code)) for code in codes}


def load(read: Callable[[str], DataFrame], without: tuple[str, ...] = (), stock_ids: tuple[int, ...] = ()) -> Catalogue:
    """Build the bundle with any reader, naming what the shop lacks in ``without``."""
    names = [f.name for f in fields(Catalogue) if f.name != "inventory_stock" and f.name not in without]
    tables = {name: read(name) for name in names}
    return Catalogue(**tables, inventory_stock={i: read(f"inventory_stock_{i}") for i in stock_ids})


def from_files(spark: SparkSession, folder: str, fmt: str = "parquet", **options) -> Catalogue:
    """Tables stored as ``{folder}/{table}`` with the known row types, so that no file is
    opened to infer them. The value tables read best partitioned by attribute_id."""

    def read(name: str) -> DataFrame:
        return spark.read.format(fmt).schema(SOURCES.get(name, STOCK_TABLE)).load(f"{folder}/{name}")

    return load(read, **options)


def from_jdbc(
    spark: SparkSession, url: str, bounds: dict[str, tuple[str, int, int, int]], properties: dict[str, str], **options
) -> Catalogue:
    """Tables of a shop database. ``bounds`` gives (column, lower, upper, partitions) for
    the tables that are read in parallel; the rest are small and read in one piece."""

    def read(name: str) -> DataFrame:
        if name not in bounds:
            return spark.read.jdbc(url, name, properties=properties)
        column, lower, upper, parts = bounds[name]
        return spark.read.jdbc(
            url, name, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties
        )

    return load(read, **options)


def from_shop(shop) -> Catalogue:
    """The bundle over the shop views."""
    return load(lambda name: shop[name], stock_ids=(2,))


def url_suffix(config: DataFrame):
    """The configured suffix as a scalar subquery, read once per job and not per product.

    A setting saved for several scopes gives several rows; the smallest scope id, which is
    the default scope, answers.
    """
    rows = config.where((F.col("path") == SUFFIX_PATH)).orderBy("scope_id").limit(1)
    stored = rows.select("value").scalar()
    return F.when(F.coalesce(stored, F.lit("")) == "", DEFAULT_SUFFIX).otherwise(stored)


def sample_ids(entity: DataFrame, ids: list[int] | None = None, limit: int = 3) -> DataFrame:
    """The ids named, or the first ``limit`` by id."""
    if ids:
        return entity.where(F.col("entity_id").isin(ids)).select("entity_id")
    return entity.select("entity_id").orderBy("entity_id").limit(limit)


# The key of each table whose size follows the catalogue.
ENTITY_KEYS = {
    "entity": "entity_id",
    "website": "product_id",
    "eav_int": "entity_id",
    "eav_varchar": "entity_id",
    "eav_text": "entity_id",
    "price": "entity_id",
    "stock_status": "product_id",
    "bestsellers": "product_id",
    "category_product": "product_id",
    "super_attribute": "product_id",
}


def wanted_ids(catalogue: Catalogue, requested: DataFrame) -> DataFrame:
    """The requested products and their variants: all ids whose rows their documents need."""
    ids = requested.select("entity_id")
    if catalogue.super_link is None:
        return ids
    parents = ids.withColumnRenamed("entity_id", "parent_id")
    children = catalogue.super_link.join(parents, "parent_id", "left_semi")
    return ids.unionByName(children.select(F.col("product_id").alias("entity_id"))).distinct()


def narrowed(catalogue: Catalogue, requested: DataFrame, wanted: DataFrame | None = None) -> Catalogue:
    """The bundle cut down to the requested products and their variants.

    For refreshing a few of many products: each table is semi-joined where it is read,
    before any grouping. Pass ``wanted`` as stored rows of ``wanted_ids``: Spark knows their
    size, and broadcasts them when they are few, so that only their rows are shuffled. A
    full walk asks for everything and does not need this.
    """
    wanted = wanted_ids(catalogue, requested) if wanted is None else wanted
    kept = {
        name: table.join(wanted.select(F.col("entity_id").alias(key)), key, "left_semi")
        for name, key in ENTITY_KEYS.items()
        if (table := getattr(catalogue, name)) is not None
    }
    if catalogue.super_link is not None:
        parents = requested.select(F.col("entity_id").alias("parent_id"))
        kept["super_link"] = catalogue.super_link.join(parents, "parent_id", "left_semi")
    return replace(catalogue, **kept)
