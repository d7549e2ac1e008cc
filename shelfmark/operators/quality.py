"""Checks on the data the jobs produce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reasons(checks: dict[str, Column]) -> Column:
    """The names of the checks that hold for a row."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in checks.items())))


def item_violations(items: DataFrame) -> DataFrame:
    """(id, reason): items that break the wire contract, one row per reason."""
    upsert = F.col("op") == "upsert"
    parts = [F.col(name).isNull().cast("int") for name in ("price", "currency", "price_exponent")]
    missing = reduce(lambda left, right: left + right, parts)
    checks = {
        "no id": F.col("id").isNull(),
        "no visible": F.col("visible").isNull(),
        "no in_stock": upsert & F.col("in_stock").isNull(),
        "price without currency or exponent": upsert & missing.isin(1, 2),
        "rejected price": upsert & F.col("price_reject").isNotNull(),
        "no name": upsert & (F.coalesce("name", F.lit("")) == ""),
    }
    return items.select("id", F.explode(_reasons(checks)).alias("reason"))


def stray_variants(variants: DataFrame, items: DataFrame, searchable: DataFrame) -> DataFrame:
    """Variant ids that are also sent as products of their own without being searchable."""
    sent = items.where(F.col("op") == "upsert").select("id")
    own = searchable.select(F.col("entity_id").alias("id"))
    return variants.select("id").distinct().join(sent, "id", "left_semi").join(own, "id", "left_anti")


def field_coverage(items: DataFrame, names: list[str]) -> DataFrame:
    """(field, filled, upserts): how many sent items have each field, in one pass."""
    sent = items.where(F.col("op") == "upsert")
    counted = sent.agg(F.count(F.lit(1)).alias("upserts"), *(F.count(name).alias(name) for name in names))
    pairs = F.array(*(F.struct(F.lit(name).alias("field"), F.col(name).alias("filled")) for name in names))
    return counted.select("upserts", F.inline(pairs)).select("field", "filled", "upserts")


def report_checks(reports: DataFrame) -> DataFrame:
    """(check, violations) over order reports: positive order ids, one row per order, one
    reference per order, a readable timestamp."""
    per_order = reports.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("occurred_at").isNull()).alias("undated")
    )
    per_ref = reports.groupBy("order_ref").agg(
        F.min("order_id").alias("least"), F.max("order_id").alias("greatest"), F.count(F.lit(1)).alias("n")
    )
    by_order = per_order.agg(
        F.coalesce(F.sum(F.when(F.col("order_id") <= 0, F.col("n"))), F.lit(0)).alias("bad_order_id"),
        F.count_if(F.col("n") > 1).alias("repeated_order"),
        F.coalesce(F.sum("undated"), F.lit(0)).alias("undated"),
    )
    shared = per_ref.agg(F.count_if(F.col("least") != F.col("greatest")).alias("shared"))
    names = {"order id not positive": "bad_order_id", "repeated order": "repeated_order", "no timestamp": "undated"}
    pairs = [F.struct(F.lit(k).alias("check"), F.col(v).cast("bigint").alias("violations")) for k, v in names.items()]
    pairs.append(F.struct(F.lit("shared reference").alias("check"), F.col("shared").alias("violations")))
    return by_order.withColumn("shared", shared.scalar()).select(F.inline(F.array(*pairs)))
