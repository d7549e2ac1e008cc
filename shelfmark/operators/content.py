"""Images, permalinks and descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank, plain_text
from shelfmark.operators.scope import scoped_attribute, scoped_wide
from shelfmark.sources.catalogue import Catalogue, StoreView

# The stored "no image" word and the length of a description.
NO_IMAGE = "no_selection"
DESCRIPTION_CHARS = 1000


def image_url(small: Column, full: Column, media_url: str) -> Column:
    """The listing image, else the full one, as an address; null without either."""

    def usable(path: Column) -> Column:
        return F.when((path != "") & (path != NO_IMAGE), path)

    path = F.coalesce(usable(small), usable(full))
    return F.concat(F.lit(media_url.rstrip("/") + "/catalog/product/"), F.ltrim(path, F.lit("/")))


def permalink(url_key: Column, base_url: str, suffix: Column | str) -> Column:
    ending = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.concat(F.lit(base_url.rstrip("/") + "/"), null_if_blank(url_key), ending)


def images(catalogue: Catalogue, store: StoreView) -> DataFrame:
    stored = scoped_wide(catalogue.eav_varchar, catalogue.ids("small_image", "image"), store.store_id)
    return stored.select(
        "entity_id", image_url(F.col("small_image"), F.col("image"), store.media_url).alias("image")
    ).where(F.col("image").isNotNull())


def permalinks(catalogue: Catalogue, store: StoreView) -> DataFrame:
    stored = scoped_attribute(catalogue.eav_varchar, catalogue.ids("url_key")["url_key"], store.store_id)
    return stored.select(
        "entity_id", permalink(F.col("value"), store.base_url, store.url_suffix).alias("permalink")
    ).where(F.col("permalink").isNotNull())


def descriptions(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """The short description, or the long one where the short one has no words.

    Each text is cleaned whole where it is read, then cut to the length the field has, so
    that the shuffle that brings the two together carries the field and not the markup.
    """
    cleaned = catalogue.eav_text.withColumn("value", F.substring(plain_text("value"), 1, DESCRIPTION_CHARS))
    stored = scoped_wide(cleaned, catalogue.ids("short_description", "description"), store.store_id)
    text = F.coalesce(null_if_blank(F.col("short_description")), null_if_blank(F.col("description")))
    return stored.select("entity_id", text.alias("description")).where(F.col("description").isNotNull())
