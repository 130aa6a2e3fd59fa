"""Resampling of histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import noise, order
from tessera.sources import files


def bootstrap(cells: DataFrame, stratum: str, keys: list[str], count: str, seed: int = 0, block: int = 4096) -> DataFrame:
    """A histogram drawn with replacement: each record of a stratum draws a record of the same stratum, so stratum totals are kept.

    Cells hold ranges of record numbers in the order of ``keys``; a draw is a number, and its cell is the last one that begins at or
    before it, found by one sort inside blocks of ``block`` numbers, each of which also holds the cell that reaches into it.
    Returns stratum, keys, n.
    """
    ranged = files.kept(order.running(files.kept(cells.filter(F.col(count) > 0), "cells"), keys, F.col(count).cast("long"), "_lo"), "ranged")
    # written, so that Spark knows how few strata there are: records are not dealt by stratum
    span = files.kept(ranged.groupBy(stratum).agg(F.min("_lo").alias("_from"), F.sum(count).alias("_size")), "strata")
    numbers = files.expand(ranged.select(stratum, "_lo", F.col(count).alias("_n")), "_n", "_at").select(stratum, (F.col("_lo") + F.col("_at")).alias("_i"))
    number = F.col("_from") + F.floor(noise.uniform("_i", seed=seed) * F.col("_size"))
    cell = F.struct(*keys)
    draws = numbers.join(span, stratum).select(F.struct(stratum).alias("_drawn"), number.alias("_d")).withColumns({"_cell": F.lit(None).cast(ranged.select(cell.alias("c")).schema["c"].dataType), "_block": F.floor(F.col("_d") / block)})
    touched = F.sequence(F.floor(F.col("_lo") / block), F.floor((F.col("_lo") + F.col(count) - 1) / block))
    places = ranged.select("_lo", cell.alias("_cell"), F.explode(touched).alias("_block"))
    places = places.select(F.lit(None).cast(draws.schema["_drawn"].dataType).alias("_drawn"), F.greatest("_lo", F.col("_block") * block).alias("_d"), "_cell", "_block")
    # a cell comes before the draws of its first number
    upto = W.partitionBy("_block").orderBy("_d", F.col("_drawn").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = draws.unionByName(places).withColumn("_cell", F.last("_cell", ignorenulls=True).over(upto)).filter(F.col("_drawn").isNotNull())
    return hit.groupBy(F.col("_drawn")[stratum].alias(stratum), *[F.col("_cell")[k].alias(k) for k in keys]).agg(F.count("*").alias("n"))
