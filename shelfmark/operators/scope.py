"""Store-scoped attribute values: the store's own row over the default row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import label_or_code

DEFAULT_STORE = 0


def in_scope(store_id: int) -> Column:
    return F.expr(f"store_id IN ({DEFAULT_STORE}, {store_id})")


def own_and_default(store_id: int, value: str = "value") -> list[Column]:
    """Aggregates ``_own`` and ``_default``: the value of the store's row and of the default
    row. There is one row of each at most."""
    return [
        F.expr(f"max(CASE WHEN store_id = {store} THEN {value} END) AS {name}")
        for name, store in (("_own", store_id), ("_default", DEFAULT_STORE))
    ]


def resolve_scope(rows: DataFrame, keys: list[str], store_id: int, either: Column | None = None) -> DataFrame:
    """One value per ``keys``: the store's value unless that is null, then the default.

    The default row must exist: a store row alone gives nothing, except where ``either`` holds. A blank store value does
    override, because only null falls back.
    """
    has_default = F.expr(f"max(store_id = {DEFAULT_STORE}) AS _has_default")
    found = rows.groupBy(*keys).agg(*own_and_default(store_id), has_default)
    enough = F.col("_has_default") if either is None else F.col("_has_default") | either
    return found.where(enough).selectExpr(*keys, "coalesce(_own, _default) AS value")


def has_attribute(attribute_id: int | None) -> Column:
    """Rows of one attribute. The id is a literal, so it is a pushed filter and prunes
    files where the values are partitioned by it. A shop without the attribute has None,
    which matches nothing."""
    return F.expr("false" if attribute_id is None else f"attribute_id = {attribute_id}")


def scoped_attribute(values: DataFrame, attribute_id: int | None, store_id: int) -> DataFrame:
    """One attribute for every entity that has a default row of it."""
    return resolve_scope(values.where(has_attribute(attribute_id) & in_scope(store_id)), ["entity_id"], store_id)


def scoped_wide(
    values: DataFrame, attributes: dict[str, int | None], store_id: int, either: tuple[str, ...] = ()
) -> DataFrame:
    """Several attributes (name -> id) of one value table as columns, in one pass and one
    shuffle. The default row must exist, except for the names in ``either``, where one of
    the two rows is enough."""
    spread, resolved = ["entity_id"], ["entity_id"]
    for name, attribute_id in attributes.items():
        own = f"attribute_id <=> {attribute_id or 'NULL'} AND store_id = {store_id}"
        default = f"attribute_id <=> {attribute_id or 'NULL'} AND store_id = {DEFAULT_STORE}"
        spread += [f"CASE WHEN {own} THEN value END AS _{name}_own", f"CASE WHEN {default} THEN value END AS _{name}_default"]
        value = f"coalesce(_{name}_own, _{name}_default)"
        if name not in either:
            spread.append(f"CASE WHEN {default} THEN 1 END AS _{name}_has")
            value = f"CASE WHEN _{name}_has = 1 THEN {value} END"
        resolved.append(f"{value} AS {name}")
    folded = [column.rsplit(" ", 1)[-1] for column in spread[1:]]
    known = ", ".join(str(attribute_id) for attribute_id in attributes.values() if attribute_id is not None) or "NULL"
    rows = values.where(f"attribute_id IN ({known})").where(in_scope(store_id)).selectExpr(*spread)
    return rows.groupBy("entity_id").agg(*(F.expr(f"max({c}) AS {c}") for c in folded)).selectExpr(*resolved)


def attribute_labels(attributes: DataFrame, labels: DataFrame | None, store_id: int) -> DataFrame:
    """Attributes with the name a shopper reads: store label, else admin label, else code."""
    if labels is None:
        return attributes.withColumn("label", label_or_code(F.lit(""), F.col("frontend_label"), F.col("attribute_code")))
    own = labels.where(F.col("store_id") == store_id).select("attribute_id", F.col("value").alias("_own_label"))
    return (
        attributes.join(own, "attribute_id", "left")
        .withColumn("label", label_or_code(F.col("_own_label"), F.col("frontend_label"), F.col("attribute_code")))
        .drop("_own_label")
    )
