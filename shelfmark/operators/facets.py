"""Brand and facet attributes: stored option ids to the labels a shopper reads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import plain_text, split_values
from shelfmark.operators.lookups import lookup_join
from shelfmark.operators.scope import attribute_labels, has_attribute, in_scope, own_and_default, resolve_scope, scoped_attribute
from shelfmark.sources.catalogue import Catalogue, StoreView

# Inputs that can be facets, value tables that hold them, and attributes
# that never are facets.
FACET_INPUTS = ("select", "multiselect", "boolean")
FACET_BACKENDS = ("int", "varchar", "text")
NOT_FACETS = ("price", "status", "visibility", "tax_class_id")


# The most facet ids that are worth pushing into a scan as literals.
PUSHED_IDS = 1000


def filterable(attributes: DataFrame) -> DataFrame:
    """The product attributes the shop marked filterable and that can be facets."""
    return attributes.where(
        (F.col("entity_type_code") == "catalog_product")
        & ((F.col("is_filterable") > 0) | (F.col("is_filterable_in_search") == 1))
        & F.col("frontend_input").isin(*FACET_INPUTS)
        & ~F.col("attribute_code").isin(*NOT_FACETS)
        & F.col("backend_type").isin(*FACET_BACKENDS)
    )


def pushed_ids(catalogue: Catalogue) -> dict[str, list[int]] | None:
    """The facet ids per value table, read when the plan is built, so that the scans skip
    the rest of the value tables; None when there are too many to push, and the join that
    follows does the work alone."""

    def read() -> dict[str, list[int]] | None:
        rows = filterable(catalogue.attribute).select("backend_type", "attribute_id").take(PUSHED_IDS + 1)
        if len(rows) > PUSHED_IDS:
            return None
        return {backend: [row[1] for row in rows if row[0] == backend] for backend in FACET_BACKENDS}

    return catalogue.once("facet ids", read)


def facet_attributes(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """The facets with the clean label a shopper reads."""
    labelled = attribute_labels(filterable(catalogue.attribute), catalogue.attribute_label, store.store_id)
    return labelled.select(
        "attribute_id", "attribute_code", "backend_type", "frontend_input", plain_text("label").alias("label")
    ).where(F.col("label") != "")


def option_texts(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(attribute_id, option_id, text, shown) of every option under the attribute that owns it.

    ``text`` is the store's label over the admin one, either being enough; ``shown`` is the
    same decoded, and null where there is no admin label.
    """
    values = catalogue.option_value.where(in_scope(store.store_id)).groupBy("option_id")
    has_default = F.expr("max(store_id = 0) AS _has_default")
    labels = values.agg(*own_and_default(store.store_id), has_default).selectExpr(
        "option_id", "coalesce(_own, _default) AS text", "_has_default"
    )
    return labels.join(catalogue.option, "option_id").select(
        "attribute_id", "option_id", "text", F.when(F.col("_has_default"), plain_text("text")).alias("shown")
    )


def option_labels(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(attribute_id, option_id, label): the decoded label of every option that has an admin one."""
    found = option_texts(catalogue, store)
    return found.select("attribute_id", "option_id", F.col("shown").alias("label")).where(F.col("label").isNotNull())


def brands(catalogue: Catalogue, store: StoreView, code: str = "manufacturer") -> DataFrame:
    """(entity_id, brand) through the manufacturer option's label. Either label row is
    enough, labels are not decoded, blank ones (and a bare ``0``) are dropped."""
    owner = catalogue.ids(code)[code]
    chosen = scoped_attribute(catalogue.eav_int, owner, store.store_id)
    labels = (
        catalogue.option_value.where(in_scope(store.store_id))
        .join(catalogue.option.where(has_attribute(owner)).select("option_id"), "option_id", "left_semi")
        .groupBy("option_id")
        .agg(*own_and_default(store.store_id))
        .select(F.col("option_id").alias("value"), F.coalesce("_own", "_default").alias("brand"))
        .where(~F.col("brand").isin("", "0"))
    )
    return lookup_join(
        chosen, labels, ["value"], spread_by="entity_id", how="inner", sized_by=[catalogue.option_value]
    ).select("entity_id", "brand")


def facet_rows(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """One row per product, facet and value: (entity_id, attribute_id, label, position,
    value). All attributes of all value tables are resolved together.

    The rows are placed by product once; every grouping after that stays in place.
    """
    facets = facet_attributes(catalogue, store)
    tables = {"int": catalogue.eav_int, "varchar": catalogue.eav_varchar, "text": catalogue.eav_text}
    pushed = pushed_ids(catalogue)
    stored = []
    for backend, values in tables.items():
        scanned = values.where(in_scope(store.store_id))
        if pushed is not None:
            scanned = scanned.where(F.col("attribute_id").isin(pushed[backend]))
        named = lookup_join(
            scanned,
            facets.where(F.col("backend_type") == backend),
            ["attribute_id"],
            spread_by="entity_id",
            how="inner",
            sized_by=[table for table in (catalogue.attribute, catalogue.attribute_label) if table is not None],
        )
        stored.append(
            named.select("entity_id", "attribute_id", "label", "frontend_input", "store_id", F.col("value").cast("string"))
        )
    rows = reduce(DataFrame.unionByName, stored).repartition("entity_id")
    keys = ["entity_id", "attribute_id", "label", "frontend_input"]
    parts = resolve_scope(rows, keys, store.store_id).withColumn("parts", split_values(F.col("value")))
    yes = F.when(F.try_element_at("parts", F.lit(1)) == "1", F.array(F.lit("1")))
    exploded = parts.select(
        *keys, F.posexplode(F.when(F.col("frontend_input") == "boolean", yes).otherwise(F.col("parts"))).alias(
            "position", "option"
        )
    )
    labels = option_labels(catalogue, store).select(
        "attribute_id", F.col("option_id").cast("string").alias("option"), F.col("label").alias("text")
    )
    named = lookup_join(
        exploded,
        labels.where(F.col("text") != ""),
        ["attribute_id", "option"],
        spread_by="entity_id",
        sized_by=[catalogue.option, catalogue.option_value],
    )
    value = F.when(F.col("frontend_input") == "boolean", "Yes").otherwise(F.col("text"))
    return named.select("entity_id", "attribute_id", "label", "position", value.alias("value")).where(
        F.col("value").isNotNull()
    )


def facet_lists(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, label, values): distinct values in stored order. Where two attributes
    share a label, the one with the higher id speaks for it."""
    per_attribute = (
        facet_rows(catalogue, store)
        .groupBy("entity_id", "attribute_id", "label")
        .agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("placed"))
        .withColumn("values", F.array_distinct(F.transform("placed", lambda row: row["value"])))
    )
    return per_attribute.groupBy("entity_id", "label").agg(F.max_by("values", "attribute_id").alias("values"))


def facet_maps(catalogue: Catalogue, store: StoreView) -> DataFrame:
    """(entity_id, attributes): label -> values."""
    return (
        facet_lists(catalogue, store)
        .groupBy("entity_id")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "values")))).alias("attributes"))
    )
