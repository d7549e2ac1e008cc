"""Settings by scope: a store view's own value, else its website's, else the default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank
from shelfmark.sources.catalogue import DEFAULT_SUFFIX, SUFFIX_PATH, StoreView

# Where the settings of a store view are kept, and the scopes from near to far.
PATHS = {
    "base_url": "web/secure/base_url",
    "media_url": "web/secure/base_media_url",
    "currency": "currency/options/default",
    "url_suffix": SUFFIX_PATH,
}
SCOPES = ("stores", "websites", "default")


def scoped_settings(stores: DataFrame, config: DataFrame, paths: dict[str, str]) -> DataFrame:
    """``stores`` (store_id, website_id, ...) with a column for each name of ``paths``: the nearest scope's value.

    ``config`` is (scope, scope_id, path, value). A null value does not count; a blank one does. One
    join and one aggregate by nearness resolve all store views.
    """
    ids = (F.col("store_id"), F.col("website_id"), F.lit(0))
    chain = F.array(
        *(F.struct(F.lit(scope).alias("scope"), one.cast("bigint").alias("scope_id"), F.lit(far).alias("far")) for far, (scope, one) in enumerate(zip(SCOPES, ids, strict=True)))
    )
    asked = stores.select("store_id", F.inline(chain))
    known = config.where(F.col("path").isin(*paths.values()) & F.col("value").isNotNull())
    known = known.select("scope", F.col("scope_id").cast("bigint").alias("scope_id"), "path", "value")
    nearest = (F.min_by(F.when(F.col("path") == path, F.col("value")), F.when(F.col("path") == path, F.col("far"))).alias(name) for name, path in paths.items())
    found = asked.join(known, ["scope", "scope_id"]).groupBy("store_id").agg(*nearest)
    return stores.join(found, "store_id", "left")


def store_views(stores: DataFrame, config: DataFrame) -> DataFrame:
    """(store_id, website_id, website_code, root_category_id, base_url, media_url, currency, url_suffix) of every store view.

    Media stand beside the pages unless configured elsewhere; a blank suffix is the usual one.
    """
    rows = scoped_settings(stores, config, PATHS)
    base = F.concat(F.rtrim("base_url", F.lit("/")), F.lit("/"))
    return rows.select(
        "store_id",
        "website_id",
        "website_code",
        "root_category_id",
        base.alias("base_url"),
        F.coalesce(null_if_blank(F.col("media_url")), F.concat(base, F.lit("media/"))).alias("media_url"),
        F.upper("currency").alias("currency"),
        F.coalesce(null_if_blank(F.col("url_suffix")), F.lit(DEFAULT_SUFFIX)).alias("url_suffix"),
    )


def view_of(views: DataFrame, store_id: int) -> StoreView:
    """One store view for the document job: its row of ``store_views``."""
    row = views.where(F.col("store_id") == store_id).first()
    if row is None:
        raise ValueError(f"no store view {store_id}")
    return StoreView(**{name: value for name, value in row.asDict().items() if value is not None})
