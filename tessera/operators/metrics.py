"""Accuracy metrics of protected (``priv``) against true (``orig``) counts, as aggregations and windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def error() -> Column:
    return F.col("priv") - F.col("orig")


def l1() -> Column:
    return F.abs(error())


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def unit_sums(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Per unit: sums of true, protected and absolute error, squared error, greatest absolute error."""
    return frame.groupBy(*keys).agg(
        F.sum("orig").alias("orig"), F.sum("priv").alias("priv"), F.sum(l1()).alias("l1"), F.sum(error() * error()).alias("sq"), F.max(l1()).alias("linf"),
        F.sum(F.when(F.col("orig") != 0, 1).otherwise(0)).alias("nz_orig"), F.sum(F.when(F.col("priv") != 0, 1).otherwise(0)).alias("nz_priv"),
    )


def tvd(l1_sum: Column, orig_sum: Column) -> Column:
    """1 - L1 / (2 * true total)."""
    return 1 - ratio(l1_sum, 2 * orig_sum)


def share_gap(frame: DataFrame, keys: list[str], cell: str) -> DataFrame:
    """Per unit: gap of shares at the cell with the largest protected value (ties: lowest cell); both totals 0: 0, exactly one 0: 2."""
    top = F.max_by(F.struct("orig", "priv"), F.struct("priv", -F.col(cell)))
    s = frame.groupBy(*keys).agg(top.alias("top"), F.sum("orig").alias("n_orig"), F.sum("priv").alias("n_priv"))
    both, one = (F.col("n_orig") == 0) & (F.col("n_priv") == 0), (F.col("n_orig") == 0) | (F.col("n_priv") == 0)
    gap = F.abs(ratio(F.col("top.priv"), F.col("n_priv")) - ratio(F.col("top.orig"), F.col("n_orig")))
    return s.select(*keys, F.when(both, 0.0).when(one, 2.0).otherwise(gap).alias("gap"))


def pow10_class(value: Column) -> Column:
    """Order of magnitude as the lower bound: 0, 1, 10, 100, ..."""
    return F.when(value <= 0, 0).otherwise(F.pow(F.lit(10), F.length(F.floor(value).cast("long").cast("string")) - 1)).cast("long")


def bin_start(value: Column, width: int) -> Column:
    return (F.floor(value / width) * width).cast("long")


def range_label(value: Column, edges: list[float]) -> Column:
    """Half-open ranges [a, b), open above the last edge; below the first: null."""
    out = F.lit(None).cast("string")
    for a, b in zip(edges, [*edges[1:], None]):
        label = f"[{a}, {b})" if b is not None else f"{a}+"
        out = F.when((value >= a) & (F.lit(True) if b is None else value < b), label).otherwise(out)
    return out


def quantiles(frame: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles in long form; equal values are merged before the percentile."""
    counted = frame.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    q = counted.groupBy(*keys).agg(F.expr(f"percentile({value}, array({', '.join(map(str, probs))}), _n)").alias("_q"))
    return q.select(*keys, F.posexplode("_q").alias("_i", "value")).select(*keys, F.element_at(F.array(*map(F.lit, probs)), F.col("_i") + 1).alias("quantile"), "value")


def error_histogram(frame: DataFrame, keys: list[str], bins: int = 20) -> DataFrame:
    """Counts of absolute errors by bin; the width is the largest error // bins, at least 1. Equal errors are merged before the window."""
    counted = frame.groupBy(*keys, l1().alias("e")).agg(F.count("*").alias("n"))
    width = F.greatest(F.floor(F.max("e").over(W.partitionBy(*keys)) / bins), F.lit(1)).cast("long")
    return counted.withColumn("width", width).groupBy(*keys, "width", F.floor(F.col("e") / F.col("width")).cast("long").alias("bin")).agg(F.sum("n").alias("n"))


def diversity(frame: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Per unit 1 - sum of squared shares over the groups, true counts."""
    g = frame.groupBy(*keys, *group).agg(F.sum("orig").alias("n"), F.sum("priv").alias("m"))
    return g.groupBy(*keys).agg((1 - ratio(F.sum(F.col("n") * F.col("n")), F.pow(F.sum("n"), 2))).alias("diversity"), F.sum("n").alias("orig"), F.sum("m").alias("priv"))


def sample_variance(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(n * sum of squares - square of the sum) / (n (n - 1)) per group; null for one value."""
    n, s, q = F.count(value), F.sum(value), F.sum(F.col(value) * F.col(value))
    return frame.groupBy(*keys).agg(F.try_divide((n * q - s * s).cast("double"), (n * (n - 1)).cast("double")).alias("variance"))


def summary(frame: DataFrame, keys: list[str]) -> DataFrame:
    """MAE, RMSE, CoV (RMSE by mean true count), MAPE, MALPE, count of errors over 10 %, rows; as (name, value)."""
    e, rel = error(), ratio(error(), F.col("orig"))
    agg = frame.groupBy(*keys).agg(
        F.avg(l1().cast("double")).alias("MAE"), F.sqrt(F.avg((e * e).cast("double"))).alias("RMSE"), F.avg(F.col("orig").cast("double")).alias("_m"),
        F.avg(F.abs(rel)).alias("MAPE"), F.avg(rel).alias("MALPE"), F.sum(F.when(F.abs(rel) > 0.1, 1).otherwise(0)).cast("double").alias("OVER10"), F.count("*").cast("double").alias("ROWS"),
    )
    agg = agg.withColumn("CoV", 100 * F.try_divide(F.col("RMSE"), F.col("_m")))
    names = ["MAE", "RMSE", "CoV", "MAPE", "MALPE", "OVER10", "ROWS"]
    return agg.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])).alias("x")).select(*keys, "x.name", "x.value")


def count_quantile(frame: DataFrame, keys: list[str], level: str, count: str, prob: float, out: str) -> DataFrame:
    """Lowest level at which the running count reaches a share of the total (a quantile of persons from counts)."""
    w = W.partitionBy(*keys).orderBy(level)
    run = frame.groupBy(*keys, level).agg(F.sum(count).alias("_n")).withColumn("_run", F.sum("_n").over(w)).withColumn("_all", F.sum("_n").over(W.partitionBy(*keys)))
    return run.filter((F.col("_all") > 0) & (F.col("_run") >= prob * F.col("_all"))).groupBy(*keys).agg(F.min(level).alias(out))


#: Metrics by name: (protected, true) -> aggregate.
NAMED = {
    "l1": lambda priv, orig: F.sum(F.abs(priv - orig)),
    "l2": lambda priv, orig: F.sqrt(F.sum((priv - orig) * (priv - orig))),
    "linf": lambda priv, orig: F.max(F.abs(priv - orig)),
    "bias": lambda priv, orig: F.avg(priv - orig),
}


def by_name(frame: DataFrame, keys: list[str], names: list[str], priv: str = "priv", orig: str = "orig", own: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """The named metrics of each group, in one aggregation; ``own`` adds the user's to those of the library."""
    known = NAMED | (own or {})
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown metrics: {unknown}")
    return frame.groupBy(*keys).agg(*[known[n](F.col(priv), F.col(orig)).alias(n) for n in names])
