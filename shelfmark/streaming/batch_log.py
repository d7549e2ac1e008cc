"""State of a stream as an append-only folder: one sub-folder per micro-batch.

A micro-batch writes what it changed and nothing else, so its cost follows the batch and
not the state. Writing a batch again overwrites its own folder, so a replay after a lost
executor or a restart changes nothing. Readers fold the batches; ``compact`` writes a new
log that starts with the folded state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batch(spark: SparkSession, schema: StructType, path: str, batch_id: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/batch={batch_id}")


def read_log(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """All batches with their number in ``batch``."""
    stored = StructType([*schema.fields, StructField("batch", LongType())])
    return spark.read.schema(stored).parquet(path)


def compact(
    spark: SparkSession, schema: StructType, path: str, target: str, upto: int, fold: Callable[[DataFrame], DataFrame]
) -> None:
    """Write ``target`` as a log whose batch ``upto`` is the fold of the batches up to it.
    The old log stays as it is until the caller stops reading it."""
    old = read_log(spark, schema, path).where(F.col("batch") <= upto)
    write_batch(fold(old).select(*schema.names), target, upto)
