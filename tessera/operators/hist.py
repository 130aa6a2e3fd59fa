"""Histograms in long form: one row per geography and cell, zeros left out unless asked for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_cell(records: DataFrame, keys: list[str], dims: list[str], out: str = "orig") -> DataFrame:
    """Records -> count per geography and cell (partial sums before the one shuffle)."""
    return records.groupBy(*keys, *dims).agg(F.count("*").alias(out))


def flat_index(dims: list[str], sizes: list[int]) -> Column:
    """Row-major cell number of coded dims."""
    return reduce(lambda acc, d: acc * d[1] + F.col(d[0]), zip(dims[1:], sizes[1:]), F.col(dims[0])).cast("int")


def unflatten(index: str, dims: list[str], sizes: list[int]) -> list[Column]:
    """Inverse of :func:`flat_index`."""
    out, below = [], 1
    for d, n in reversed(list(zip(dims, sizes))):
        out.append((F.floor(F.col(index) / below) % n).cast("int").alias(d))
        below *= n
    return out[::-1]


def sparse_vector(hist: DataFrame, keys: list[str], index: str, value: str, out: str = "cells") -> DataFrame:
    """Per geography the sorted (index, count) pairs as an array of structs."""
    return hist.filter(F.col(value) != 0).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(index, value))).alias(out))


def weighted_count(records: DataFrame, keys: list[str], weight: Column, out: str = "n") -> DataFrame:
    """Sum of per-record probabilities, rounded half up to whole numbers."""
    return records.groupBy(*keys).agg(F.floor(F.sum(weight) + 0.5).cast("long").alias(out))


def units_from_persons(records: DataFrame, keys: list[str], dims: list[str], unit: str, out: str = "n_units") -> DataFrame:
    """Distinct units per geography and cell, counted from person records."""
    return records.select(*keys, *dims, unit).distinct().groupBy(*keys, *dims).agg(F.count("*").alias(out))


def join_universes(persons: DataFrame, units: DataFrame, keys: list[str], persons_value: str, units_value: str) -> DataFrame:
    """Every geography that has units, with its person count; none counts as zero."""
    return units.join(persons, keys, "left").select(*keys, F.coalesce(persons_value, F.lit(0)).alias(persons_value), units_value)


def combine(left: DataFrame, right: DataFrame, keys: list[str], value: str, sign: int = 1) -> DataFrame:
    """Cell-wise sum (sign 1) or difference (sign -1): one union and one aggregation, no join."""
    return left.select(*keys, value).union(right.select(*keys, (F.col(value) * sign).alias(value))).groupBy(*keys).agg(F.sum(value).alias(value))


def densify(hist: DataFrame, keys: list[str], dims: list[str], sizes: list[int], value: str | list[str]) -> DataFrame:
    """Complete the cells of every geography present with zeros."""
    values = [value] if isinstance(value, str) else value
    grid = hist.select(*keys).distinct().withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(reduce(lambda a, b: a * b, sizes) - 1))))
    full = grid.select(*keys, *unflatten("_c", dims, sizes))
    return full.join(hist.select(*keys, *dims, *values), [*keys, *dims], "left").withColumns({v: F.coalesce(v, F.lit(0)) for v in values})


def roll_up(hist: DataFrame, geo: str, dims: list[str], lengths: list[int], values: list[str], level: str = "level") -> DataFrame:
    """All levels of a prefix hierarchy at once; ``level`` is the prefix length.

    ``hist`` is aggregated at the bottom first, so what is multiplied by the number
    of levels is cells, not records; one shuffle makes all levels.
    """
    bottom = hist.groupBy(geo, *dims).agg(*[F.sum(v).alias(v) for v in values])
    spread = bottom.withColumn(level, F.explode(F.array(*map(F.lit, lengths)))).withColumn(geo, F.expr(f"substr({geo}, 1, {level})"))
    return spread.groupBy(level, geo, *dims).agg(*[F.sum(v).alias(v) for v in values])


def roll_up_offspine(hist: DataFrame, crosswalk: DataFrame, geo: str, entity: str, dims: list[str], values: list[str]) -> DataFrame:
    """Roll up to areas that are not prefixes, through a table (geo, entity); a block may belong to several."""
    return hist.join(crosswalk.select(geo, entity), geo).groupBy(entity, *dims).agg(*[F.sum(v).alias(v) for v in values])
