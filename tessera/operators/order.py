"""Numbers and running sums in a total order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_ROWS = 50_000
SIDE = 32


def cuts(df: DataFrame, column: str, bins: int) -> list:
    """Values that cut the rows into about ``bins`` ranges of equal size, ascending; a value that fills whole ranges stands repeatedly.

    Numbers: approximate quantiles. Other types: quantiles of the SAMPLE_ROWS rows with the least hashes. Cuts
    balance the work and nothing else, so a sample will do.
    """
    if bins < 2:
        return []
    if dict(df.select(F.col(column).alias("c")).dtypes)["c"] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return df.agg(F.percentile_approx(column, [i / bins for i in range(1, bins)], 10 * bins)).first()[0] or []
    others = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map")]
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("c"), F.xxhash64(*others).alias("h")).orderBy("h").limit(SAMPLE_ROWS)
    sample = sorted(r["c"] for r in rows.select("c").collect())
    return [sample[len(sample) * i // bins] for i in range(1, bins)] if sample else []


def range_number(value: Column, found: list, side: int = SIDE) -> Column:
    """Number of the distinct cuts below a value (null: 0, all others from 1), by two levels of comparisons."""
    values = sorted(set(found))
    if not values:
        return F.when(value.isNull(), 0).otherwise(1)
    groups = [values[i : i + side] for i in range(0, len(values), side)]
    below = lambda array: F.size(F.filter(array, lambda c: c < value))
    group = below(F.array(*[F.lit(g[-1]) for g in groups]))
    inside = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group)
    return F.when(value.isNull(), 0).otherwise(1 + group * side + F.when(inside.isNull(), 0).otherwise(below(inside)))


def running(df: DataFrame, order: list[str], value: Column, out: str, within: list[str] = (), bins: int = SIDE * SIDE) -> DataFrame:
    """``out``: sum of ``value`` over the rows before this one (0 for the first), in the order of the columns, nulls first.

    The first ordering column is cut into ranges; sums run inside the ranges, and the ranges' totals, at most ``bins`` for
    each key of ``within``, are added up in their order.
    """
    keys = [*within, "_range"]
    ranged = df.withColumn("_range", range_number(F.col(order[0]), cuts(df, order[0], bins))).withColumn("_v", value)
    totals = ranged.groupBy(*keys).agg(F.sum("_v").alias("_t"))
    before = W.partitionBy(*within).orderBy("_range") if within else W.partitionBy(F.lit(0)).orderBy("_range")
    totals = totals.select(*keys, (F.sum("_t").over(before) - F.col("_t")).alias("_before"))
    mine = W.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    inside = ranged.withColumn("_inside", F.coalesce(F.sum("_v").over(mine), F.lit(0)))
    same = [inside[k].eqNullSafe(totals[k]) for k in keys]
    joined = inside.join(totals if within else F.broadcast(totals), same)
    return joined.select(*[inside[c] for c in df.columns], (F.col("_before") + F.col("_inside")).alias(out))


def numbered(df: DataFrame, order: list[str], out: str, within: list[str] = ()) -> DataFrame:
    """Dense numbers from 0 in the order of the columns, for each key of ``within``; rows equal in all of them get any of their numbers."""
    return running(df, order, F.lit(1).cast("long"), out, within)
