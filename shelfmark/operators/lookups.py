"""Joins of many facts to a dimension whose keys may be very unevenly used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def fits_broadcast(*tables: DataFrame) -> bool:
    """Whether Spark's own size estimate of all these tables is under its broadcast limit."""
    limit = tables[0].sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    sizes = (table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() for table in tables)
    return sum(int(str(size)) for size in sizes) <= limit


def lookup_join(
    facts: DataFrame,
    dimension: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "left",
    sized_by: list[DataFrame] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``facts`` joined to ``dimension`` on ``on``.

    A dimension whose stored tables are within the broadcast limit is broadcast. A larger
    one is joined by shuffle with the key salted by ``spread_by``, a fact column: the facts
    of one hot key spread over ``salts`` tasks, and the dimension is repeated once per salt.
    ``sized_by`` names the stored tables to measure where the dimension is made from them
    row by row or by their unique keys, so that it is no larger than they are; Spark's
    estimate of such a join would multiply its inputs.
    """
    if fits_broadcast(*(sized_by or [dimension])):
        return facts.join(F.broadcast(dimension), on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
