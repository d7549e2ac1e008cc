"""Every stored value a document needs, in one pass over each value table and one placing by product."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import null_if_blank, plain_text, split_values
from shelfmark.operators.content import DESCRIPTION_CHARS
from shelfmark.operators.facets import facet_attributes, option_texts, pushed_ids
from shelfmark.operators.lookups import lookup_join
from shelfmark.operators.scope import in_scope, resolve_scope
from shelfmark.sources.catalogue import Catalogue, StoreView

# Fields by the value table that holds them, and those for which either row is enough.
INT_FIELDS = ("status", "visibility", "manufacturer")
VARCHAR_FIELDS = ("name", "url_key", "small_image", "image")
TEXT_FIELDS = ("short_description", "description")
EITHER_ROW = ("status", "visibility", "name")
BRAND = "manufacturer"


def _stored(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, attribute_id, store_id, value as text) of the fields and facets, descriptions cleaned and cut."""
    facets = pushed_ids(catalogue)
    found = []
    for backend, values, fields in (
        ("int", catalogue.eav_int, INT_FIELDS),
        ("varchar", catalogue.eav_varchar, VARCHAR_FIELDS),
        ("text", catalogue.eav_text, TEXT_FIELDS),
    ):
        ids = [one for one in catalogue.ids(*fields).values() if one is not None]
        rows = values.where(in_scope(store.store_id))
        if facets is not None:
            rows = rows.where(F.col("attribute_id").isin(sorted({*ids, *facets[backend]})))
        text = F.col("value").cast("string")
        if backend == "text":
            cleaned = F.substring(plain_text("value"), 1, DESCRIPTION_CHARS)
            text = F.when(F.col("attribute_id").isin(ids), cleaned).otherwise(text)
        found.append(rows.select("entity_id", "attribute_id", "store_id", text.alias("value")))
    return reduce(DataFrame.unionByName, found)


def product_values(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, status, visibility, name, url_key, small_image, image, description, brand, attributes) of every product with a value.

    Store and default rows of all attributes are resolved together, option ids of brand and facets are looked up
    together, and every grouping after the first stays where it placed the product.
    """
    ids = catalogue.ids(*INT_FIELDS, *VARCHAR_FIELDS, *TEXT_FIELDS)
    either = [ids[name] for name in EITHER_ROW if ids[name] is not None]
    rows = resolve_scope(
        _stored(catalogue, store).repartition("entity_id"), ["entity_id", "attribute_id"], store.store_id, F.col("attribute_id").isin(either)
    )
    metadata = [table for table in (catalogue.attribute, catalogue.attribute_label) if table is not None]
    facets = facet_attributes(catalogue, store).select("attribute_id", "label", "frontend_input")
    rows = lookup_join(rows, facets, ["attribute_id"], spread_by="entity_id", sized_by=metadata)
    if pushed_ids(catalogue) is None:
        rows = rows.where(F.col("label").isNotNull() | F.col("attribute_id").isin([one for one in ids.values() if one is not None]))

    is_brand = F.lit(False) if ids[BRAND] is None else F.col("attribute_id") == ids[BRAND]
    yes = F.when(F.try_element_at(split_values(F.col("value")), F.lit(1)) == "1", F.array(F.lit("1")))
    parts = F.when(F.col("frontend_input") == "boolean", yes).when(F.col("label").isNotNull() | is_brand, split_values(F.col("value")))
    rows = rows.select("*", F.posexplode_outer(parts).alias("position", "option"))
    texts = option_texts(catalogue, store).select("attribute_id", F.col("option_id").cast("string").alias("option"), "text", "shown")
    rows = lookup_join(rows, texts, ["attribute_id", "option"], spread_by="entity_id", sized_by=[catalogue.option, catalogue.option_value])
    shown = F.when(F.col("frontend_input") == "boolean", F.when(F.col("option") == "1", "Yes")).otherwise(null_if_blank(F.col("shown")))
    named = F.when(F.col("label").isNotNull() & shown.isNotNull(), F.struct("position", shown.alias("value")))
    chosen = F.transform(F.array_sort(F.collect_list(named)), lambda one: one["value"])
    each = rows.groupBy("entity_id", "attribute_id", "label").agg(
        F.max("value").alias("value"), F.max("text").alias("text"), F.array_distinct(chosen).alias("values")
    )

    field = lambda name: F.max(F.when(F.col("attribute_id").eqNullSafe(ids[name]), F.col("value")))
    facet = F.when(F.size("values") > 0, F.struct("label", "attribute_id", "values"))
    found = each.groupBy("entity_id").agg(
        *(field(name).alias(name) for name in ids if name != BRAND),
        F.max(F.when(is_brand & ~F.col("text").isin("", "0"), F.col("text"))).alias("brand"),
        F.array_sort(F.collect_list(facet)).alias("facets"),
    )
    # Of attributes that share a label the one with the higher id speaks for it.
    last = F.filter("facets", lambda one, at: F.coalesce(F.get("facets", at + 1)["label"] != one["label"], F.lit(True)))
    labelled = F.map_from_entries(F.transform(last, lambda one: F.struct(one["label"], one["values"])))
    return found.select(
        "entity_id",
        F.col("status").cast("int").alias("status"),
        F.col("visibility").cast("int").alias("visibility"),
        *VARCHAR_FIELDS,
        F.coalesce(null_if_blank(F.col("short_description")), null_if_blank(F.col("description"))).alias("description"),
        "brand",
        labelled.alias("attributes"),
    )
