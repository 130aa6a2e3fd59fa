"""Validation jobs: each gives a row per finding or a row with the outcome, never an exception in a task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failing_rules(records: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """Records that break a rule (columns that are true for a break), with the sorted names of the broken rules."""
    broken = F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])))
    return records.select(*keys, broken.alias("_b")).filter(F.size("_b") > 0).select(*keys, F.array_join("_b", ",").alias("broken"))


def legal(column: str, allowed: str) -> Column:
    """Whether a value is in a comma list of values and inclusive ranges, as in ``0-5,9``; strings compare by length and order."""
    out = F.lit(False)
    for part in allowed.split(","):
        lo, _, hi = part.strip().partition("-")
        hi = hi or lo
        c = F.col(column).cast("string")
        out = out | ((F.length(c) == len(lo)) & c.between(lo, hi) if len(lo) == len(hi) else F.expr(f"try_cast({column} as bigint)").between(int(lo), int(hi)))
    return F.coalesce(out, F.lit(False))


def layout_counts(records: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Number of illegal values by column, in one pass."""
    sums = records.agg(*[F.sum(F.when(legal(c, a), 0).otherwise(1)).alias(c) for c, a in layout.items()])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(a).alias("allowed"), F.col(c).alias("illegal")) for c, a in layout.items()])).alias("x")).select("x.*")


def equal_frames(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: number of rows (with their multiplicity) that only one side has; both zero for equal multisets. One aggregation instead of two differences."""
    cols = left.columns
    both = left.withColumn("_s", F.lit(1)).unionByName(right.select(*cols).withColumn("_s", F.lit(-1)))
    d = both.groupBy(*cols).agg(F.sum("_s").alias("_d"))
    zero = lambda c: F.coalesce(F.sum(F.when(c, F.abs("_d")).otherwise(0)), F.lit(0))
    return d.agg(zero(F.col("_d") > 0).alias("only_left"), zero(F.col("_d") < 0).alias("only_right"))


def constraint_failures(answers: DataFrame, rhs: DataFrame, keys: list[str], tolerance: float = 0.001) -> DataFrame:
    """Answers (keys, value) against right-hand sides (keys, rhs, sign in =, ge, le): the rows that fail."""
    j = rhs.join(answers, keys, "left").withColumn("value", F.coalesce("value", F.lit(0)))
    gap = F.col("value") - F.col("rhs")
    bad = F.when(F.col("sign") == "=", F.abs(gap) > tolerance).when(F.col("sign") == "ge", gap < -tolerance).otherwise(gap > tolerance)
    return j.filter(bad).select(*keys, "value", "rhs", "sign")


def must_differ(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Number of keys whose values differ; zero is the failure (the counts would then have been held fixed)."""
    a, b = left.withColumnRenamed(value, "_a"), right.withColumnRenamed(value, "_b")
    j = a.join(b, keys, "full")
    n = F.sum(F.when(F.coalesce("_a", F.lit(0)) != F.coalesce("_b", F.lit(0)), 1).otherwise(0))
    return j.agg(F.coalesce(n, F.lit(0)).alias("n_different")).withColumn("ok", F.col("n_different") > 0)


def totals(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Row counts by key, one column per source, and whether all agree."""
    parts = [f.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("source", F.lit(s)) for s, f in frames.items()]
    wide = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(*[F.sum(F.when(F.col("source") == s, F.col("n")).otherwise(0)).alias(s) for s in frames])
    names = list(frames)
    return wide.withColumn("ok", reduce(lambda a, b: a & b, [F.col(n) == F.col(names[0]) for n in names[1:]]))
