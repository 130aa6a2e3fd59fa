"""Privacy ledger: allocations of a budget to levels and queries, as tables (level, query, share)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TOLERANCE = 2.0**-23.3


def sorted_parts(query: Column) -> Column:
    """Name of a crossed query with its parts in order, so that ``b * a`` and ``a * b`` are one query."""
    return F.array_join(F.array_sort(F.split(query, r"\s*\*\s*")), " * ")


def allocation(strategy: DataFrame, level_shares: DataFrame) -> DataFrame:
    """(level, query, share of the whole) with the ledger's tests per level: shares add up to 1, none is negative, names are unique."""
    s = strategy.withColumn("query", sorted_parts(F.col("query")))
    w = W.partitionBy("level")
    s = s.withColumn("sums_to_one", F.abs(F.sum("share").over(w) - 1) <= TOLERANCE).withColumn("non_negative", F.min("share").over(w) >= 0)
    s = s.withColumn("_k", F.count("*").over(W.partitionBy("level", "query"))).withColumn("unique_names", F.max("_k").over(w) == 1).drop("_k")
    return s.join(level_shares.select("level", F.col("share").alias("_l")), "level").withColumn("whole", F.col("share") * F.col("_l")).drop("_l")


def direct_budget(budgets: DataFrame) -> DataFrame:
    """Absolute budgets (level, query, budget) -> level share, query share within the level, global scale 1 / total."""
    everything, level = W.partitionBy(F.lit(0)), W.partitionBy("level")
    total, by_level = F.sum("budget").over(everything), F.sum("budget").over(level)
    return budgets.select("level", "query", "budget", (by_level / total).alias("level_share"), F.try_divide(F.col("budget"), by_level).alias("query_share"), F.try_divide(F.lit(1.0), total).alias("scale"))


def query_variances(shares: DataFrame, scale: float) -> DataFrame:
    """Variance scale**2 / share of each (level, query); none for a zero share."""
    return shares.withColumn("variance", F.try_divide(F.lit(scale * scale), F.col("whole")))


def spent(units: DataFrame, keys: list[str]) -> DataFrame:
    """Budget per unit (level, unit, budget rows): least and most by level, whether they are equal."""
    per = units.groupBy("level", *keys).agg(F.sum("budget").alias("_b"))
    return per.groupBy("level").agg(F.count("*").alias("units"), F.min("_b").alias("least"), F.max("_b").alias("most")).withColumn("equal", F.abs(F.col("most") - F.col("least")) <= TOLERANCE)


def cell_impact(hits: DataFrame, budgets: DataFrame) -> DataFrame:
    """(query, cell) hits against (level, query, budget): most and least budget that a cell uses, by level."""
    used = hits.join(budgets, "query").groupBy("level", "cell").agg(F.sum(2 * F.col("budget")).alias("_u"))
    return used.groupBy("level").agg(F.min("_u").alias("least"), F.max("_u").alias("most"))


def query_gaps(hits: DataFrame, queries: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells that a query counts other than once: (query, cell, times). Only cells that some query misses meet the list of queries, which is of schema size."""
    times = hits.join(queries, "query", "left_semi").groupBy("query", "cell").agg(F.count("*").alias("times"))
    known = queries.distinct().agg(F.collect_set("query").alias("_all"))
    have = cells.distinct().join(times.groupBy("cell").agg(F.collect_set("query").alias("_have")), "cell", "left").withColumn("_have", F.coalesce("_have", F.array().cast("array<string>")))
    missing = have.crossJoin(F.broadcast(known)).select(F.explode(F.array_except("_all", "_have")).alias("query"), "cell", F.lit(0).cast("long").alias("times"))
    return times.join(cells.distinct(), "cell", "left_semi").filter("times <> 1").select("query", "cell", "times").unionByName(missing)


def spent_on_paths(units: DataFrame, geo: str, lengths: list[int]) -> DataFrame:
    """Budget of every root-to-block path, from units of all levels (code, share): per block the sum over the unit itself and all above it, and how many there are."""
    blocks = units.filter(F.length(geo) == lengths[-1]).select(F.col(geo).alias("block")).distinct()
    steps = blocks.select("block", F.explode(F.array(*[F.substring("block", 1, n) for n in lengths])).alias(geo)).distinct()
    return steps.join(units, geo).groupBy("block").agg(F.sum("share").alias("spent"), F.count("*").alias("units"))


def zcdp_to_eps(rho: Column, delta: float) -> Column:
    """epsilon of a rho-zCDP mechanism at delta."""
    return rho + 2 * F.sqrt(rho * -F.log(F.lit(delta)))
