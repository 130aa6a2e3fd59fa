"""Even partitions and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import order


def even(frame: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``part`` (0..parts-1) and ``position`` of each row: contiguous in the order of the keys, sizes one apart at most; rows of a part stand in one partition."""
    n = frame.count()
    numbered = order.numbered(frame, keys, "position")
    return numbered.withColumn("part", F.floor(F.col("position") * parts / n).cast("int") if n else F.lit(0)).repartition("part")


def sizes(frame: DataFrame, part: str, position: str, *others: Column) -> DataFrame:
    """Rows, first and last position of each part, and further aggregates."""
    return frame.groupBy(part).agg(F.count("*").alias("n_rows"), F.min(position).alias("first"), F.max(position).alias("last"), *others)


def per_key(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each key and the number of Spark partitions that hold them."""
    placed = frame.withColumn("_p", F.spark_partition_id()).groupBy(*keys, "_p").agg(F.count("*").alias("_n"))
    return placed.groupBy(*keys).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("partitions"))
