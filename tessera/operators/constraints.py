"""Invariants (counts held fixed) and the bounds that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MOST = 99999  # fixed value: the upper bound where no facility is known


def invariants(persons: DataFrame, units: DataFrame, geo: str, unit_type: str, adult: Column) -> DataFrame:
    """(geo, name, value): total persons, adults, units, and units by type."""
    p = persons.groupBy(geo).agg(F.count("*").alias("total"), F.sum(F.when(adult, 1).otherwise(0)).alias("adults"))
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in ("total", "adults")]))
    u = units.groupBy(geo, F.concat(F.lit("units:"), F.col(unit_type)).alias("name")).agg(F.count("*").alias("value"))
    n = units.groupBy(geo).agg(F.count("*").alias("value")).select(geo, F.lit("units").alias("name"), "value")
    return p.select(geo, pairs.alias("x")).select(geo, "x.name", "x.value").unionByName(n).unionByName(u)


def facility_bounds(units: DataFrame, totals: DataFrame, geo: str, kind: str, total: str, least: int = 1) -> DataFrame:
    """Bounds of persons by facility type: at least one per facility (everyone if it is the only type), at most what the other types leave."""
    f = units.groupBy(geo, kind).agg(F.count("*").alias("n"))
    w = W.partitionBy(geo)
    f = f.withColumn("_types", F.count("*").over(w)).withColumn("_others", F.sum("n").over(w) - F.col("n")).join(totals.select(geo, total), geo)
    lower = F.when(F.col("_types") == 1, F.col(total)).otherwise(F.col("n") * least)
    upper = F.least(F.col(total) - F.col("_others") * least, F.col("n") * MOST)
    return f.select(geo, kind, "n", lower.alias("lower"), upper.alias("upper"))


def add_up(rhs: DataFrame, geo: str, length: int, keys: list[str]) -> DataFrame:
    """Right-hand sides of a level as the sums of its children's."""
    return rhs.groupBy(F.substring(geo, 1, length).alias(geo), *keys).agg(F.sum("rhs").alias("rhs"))


def tighten(own: DataFrame, summed: DataFrame, keys: list[str]) -> DataFrame:
    """Stricter of a level's own bound and the sum of its children's (sign ``ge`` or ``le``)."""
    j = own.join(summed.withColumnRenamed("rhs", "_sum"), [*keys, "sign"])
    return j.select(*keys, "sign", F.when(F.col("sign") == "ge", F.greatest("rhs", "_sum")).otherwise(F.least("rhs", "_sum")).alias("rhs"))


def structural_zeros(hist: DataFrame, keys: list[str], impossible: dict[str, Column], value: str) -> DataFrame:
    """Counts that stand in impossible cells, by rule and key."""
    hits = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in impossible.items()]))
    return hist.filter(F.col(value) > 0).select(*keys, value, F.explode(hits).alias("rule")).groupBy(*keys, "rule").agg(F.sum(value).alias(value))
