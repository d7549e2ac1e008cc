"""Requested ids: cleaned, unique, in the order asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_ids(rows: DataFrame, column: str = "entity_id", ordinal: str | None = None) -> DataFrame:
    """Whole numbers other than 0, once each. With ``ordinal`` the first place asked for
    is kept, so a result can be put in request order."""
    place = [F.min(ordinal).alias("ordinal")] if ordinal else []
    cleaned = rows.withColumn("entity_id", F.col(column).try_cast("bigint")).where(F.col("entity_id") != 0)
    return cleaned.groupBy("entity_id").agg(*place) if place else cleaned.select("entity_id").distinct()
