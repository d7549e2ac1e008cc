"""Running values over rows in order, without putting all rows of a key in one task.

Rows are cut into buckets by their order number. Windows inside buckets and over summary
rows of buckets together give what one long window would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 18


def _bucketed(rows: DataFrame, order: str, bits: int) -> DataFrame:
    return rows.withColumn("_bucket", F.shiftright(F.col(order).cast("bigint"), bits))


def _starts(sizes: DataFrame, bits: int, used: int) -> DataFrame:
    """(_bucket, _start): rows in lower buckets, from (_bucket, _size).

    Buckets are summed up in groups by their upper bits, and those among themselves in the
    same way, until a 64-bit id has at most ``bits`` bits left: no window ever orders more
    than 2**bits rows, however sparse the ids are.
    """
    earlier = (Window.unboundedPreceding, -1)
    before = lambda window: F.coalesce(F.sum("_size").over(window.orderBy("_bucket").rowsBetween(*earlier)), F.lit(0))
    if 64 - used <= bits:
        return sizes.select("_bucket", before(Window.partitionBy(F.lit(0))).alias("_start"))
    grouped = sizes.withColumn("_upper", F.shiftright("_bucket", bits))
    upper = grouped.groupBy(F.col("_upper").alias("_bucket")).agg(F.sum("_size").alias("_size"))
    above = _starts(upper, bits, used + bits).select(F.col("_bucket").alias("_upper"), F.col("_start").alias("_above"))
    inside = grouped.select("_bucket", "_upper", before(Window.partitionBy("_upper")).alias("_inside"))
    return inside.join(above, "_upper").select("_bucket", (F.col("_above") + F.col("_inside")).alias("_start"))


def with_position(rows: DataFrame, order: str, name: str = "position", bits: int = BUCKET_BITS) -> DataFrame:
    """A 0-based position in the order of ``order``, a unique whole number.

    A bucket holds at most 2**bits rows because the numbers are unique.
    """
    cut = _bucketed(rows, order, bits)
    sizes = cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    starts = _starts(sizes, bits, bits)
    inside = Window.partitionBy("_bucket").orderBy(order)
    return (
        cut.withColumn("_row", F.row_number().over(inside) - 1)
        .join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_bucket", "_row", "_start")
    )


def max_before(
    rows: DataFrame, keys: list[str], order: str, value: Column, name: str, bits: int = BUCKET_BITS
) -> DataFrame:
    """The greatest ``value`` on earlier rows of the same keys; null when there is none.

    ``order`` is a whole number, unique within the keys.
    """
    earlier = (Window.unboundedPreceding, -1)
    cut = _bucketed(rows, order, bits).withColumn("_value", value)
    tops = cut.groupBy(*keys, "_bucket").agg(F.max("_value").alias("_top"))
    carried = tops.select(
        *keys,
        "_bucket",
        F.max("_top").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(*earlier)).alias("_carried"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(*earlier)
    return (
        cut.withColumn("_inside", F.max("_value").over(inside))
        .join(carried, [*keys, "_bucket"])
        .withColumn(name, F.greatest("_carried", "_inside"))
        .drop("_bucket", "_value", "_inside", "_carried")
    )


def last_before(facts: DataFrame, changes: DataFrame, keys: list[str], at: str, name: str, bits: int = 36) -> DataFrame:
    """``facts`` with the struct ``name`` of the change in force at their time: the last one of the same keys at or
    before it, null where there is none.

    ``at`` is a timestamp of both; of changes at one time the one with the greatest further columns counts. Time is cut
    into buckets of 2**bits microseconds, so that no window holds more of a key than one bucket's rows
    or one row for each of its buckets.
    """
    others = [column for column in changes.columns if column not in (*keys, at)]
    state = F.struct(F.unix_micros(at).alias("_at"), *others)
    moment = F.unix_micros(at)
    cut = lambda rows: rows.withColumns({"_moment": moment, "_bucket": F.shiftright(moment, bits)})
    held = cut(changes).select(*keys, "_moment", "_bucket", state.alias("_state"), F.lit(False).alias("_fact"))
    rows = cut(facts).withColumns({"_state": F.lit(None).cast(held.schema["_state"].dataType), "_fact": F.lit(True)})
    both = rows.unionByName(held, allowMissingColumns=True)
    tops = both.groupBy(*keys, "_bucket").agg(F.max("_state").alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tops.select(*keys, "_bucket", F.max("_top").over(earlier).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_moment", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_inside", F.max("_state").over(inside)).where("_fact").join(carried, [*keys, "_bucket"])
    force = F.coalesce("_inside", "_carried")
    return found.select(*facts.columns, F.when(force.isNotNull(), F.struct(*(force[c].alias(c) for c in others))).alias(name))
