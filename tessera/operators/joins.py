"""Joins between persons, units, geography and runs; Spark picks the strategy, sizes decide on broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_units(persons: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Persons with their unit's columns; persons without a unit are dropped."""
    return persons.join(units, key)


def attach_geography(units: DataFrame, reference: DataFrame, key: str, geocode: str) -> DataFrame:
    """Units with their geocode; a unit without one fails the query when its row is made."""
    joined = units.join(reference.select(key, geocode), key, "left")
    return joined.withColumn(geocode, F.when(F.col(geocode).isNull(), F.raise_error(F.concat(F.lit("no geocode for "), F.col(key).cast("string"))).cast("string")).otherwise(F.col(geocode)))


def outer_fill(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], how: str = "full") -> DataFrame:
    """Outer join on the keys; missing values become zero."""
    return left.join(right, keys, how).select(*keys, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def with_denominator(answers: DataFrame, denominators: DataFrame, keys: list[str], value: str, out: str = "denominator") -> DataFrame:
    """Each row with its unit's denominator; rows are kept one to one (denominators are unique by key)."""
    unique = denominators.groupBy(*keys).agg(F.max(value).alias(out))
    return answers.join(unique, keys, "left")


def parent_children(frame: DataFrame, geo: str, parent_length: int, child_length: int, level: str, values: list[str]) -> DataFrame:
    """Children rows with their parent's values beside them (``parent_`` columns)."""
    parents = frame.filter(F.col(level) == parent_length).select(F.col(geo).alias("parent"), *[F.col(v).alias(f"parent_{v}") for v in values])
    children = frame.filter(F.col(level) == child_length).withColumn("parent", F.substring(geo, 1, parent_length))
    return children.join(parents, "parent")


def compare_counts(left: DataFrame, right: DataFrame, keys: list[str], how: str = "full") -> DataFrame:
    """Counts by a compound key in two sources side by side, missing as zero, with their difference."""
    a, b = left.groupBy(*keys).agg(F.count("*").alias("n_left")), right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    j = a.join(b, keys, how).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_left", "n_right")})
    return j.withColumn("difference", F.col("n_right") - F.col("n_left"))
