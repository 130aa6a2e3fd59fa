"""Consistent, non-negative, whole-number tables from noisy ones: closed forms per parent and cell, as windows.

A variance of zero says that a value is known: it stays as it is, within its bounds, and the others share what is left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def part(value: Column, whole: Column, none: Column | None = None) -> Column:
    """value / whole; ``none`` (default 0) where the whole is zero."""
    return F.coalesce(F.try_divide(value, whole), F.lit(0.0) if none is None else none)


def pool(own: DataFrame, summed: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse-variance mean of a unit's own answers and the sums of its children's (keys, y, v); where both are known, its own."""
    j = own.join(summed.select(*keys, F.col("y").alias("_y"), F.col("v").alias("_v")), keys)
    weight = F.col("v") + F.col("_v")
    return j.select(*keys, part(F.col("y") * F.col("_v") + F.col("_y") * F.col("v"), weight, F.col("y")).alias("y"), part(F.col("v") * F.col("_v"), weight).alias("v"))


def rescale(children: DataFrame, parent: list[str]) -> DataFrame:
    """Variances over the least positive one among siblings."""
    return children.withColumn("v", part(F.col("v"), F.min(F.when(F.col("v") > 0, F.col("v"))).over(W.partitionBy(*parent))))


def weighted_ls(children: DataFrame, parent: list[str], total: str) -> DataFrame:
    """Least-squares children that add up to the parent: x = y + v / sum(v) * (total - sum(y))."""
    w = W.partitionBy(*parent)
    return children.withColumn("x", F.col("y") + part(F.col("v"), F.sum("v").over(w)) * (F.col(total) - F.sum("y").over(w)))


def nonneg(children: DataFrame, parent: list[str], total: str, order: list[str]) -> DataFrame:
    """As :func:`weighted_ls` with x >= 0: the weighted projection onto the simplex.

    Sorted by y / v from the top, t = (running y - total) / running v; the last row
    with y / v > t gives the t at which the clipped children add up. Total 0: all 0. Known children (v = 0)
    come last in that order; where they leave nothing, the others are 0.
    """
    w = W.partitionBy(*parent)
    known = F.when(F.col("v") <= 0, F.greatest(F.col("y"), F.lit(0.0))).otherwise(F.lit(0.0))
    height = F.try_divide(F.col("y"), F.col("v"))
    run = w.orderBy(height.desc_nulls_last(), *order).rowsBetween(W.unboundedPreceding, 0)
    c = children.withColumn("_left", F.col(total) - F.sum(known).over(w))
    c = c.withColumn("_t", F.try_divide(F.sum("y").over(run) - F.col("_left"), F.sum("v").over(run))).withColumn("_ok", height > F.col("_t"))
    # the active set is a prefix of the order, t grows along it: the last active t is the largest
    c = c.withColumn("_t", F.max(F.when(F.col("_ok"), F.col("_t"))).over(w))
    shared = F.when(F.col("_left") <= 0, 0.0).otherwise(F.greatest(F.col("y") - F.col("_t") * F.col("v"), F.lit(0.0)))
    x = F.when(F.col(total) <= 0, 0.0).when(F.col("v") <= 0, known).otherwise(shared)
    return c.withColumn("x", x).drop("_left", "_t", "_ok")


def round_controlled(fitted: DataFrame, parent: list[str], total: str, order: list[str], value: str = "x") -> DataFrame:
    """Whole numbers that add up to the parent: floors, and one more for the largest remainders (ties by ``order``)."""
    w = W.partitionBy(*parent)
    base = F.floor(F.col(value) + 1e-9).cast("long")
    r = fitted.withColumn("_f", base).withColumn("_more", F.col(total) - F.sum("_f").over(w))
    rank = F.row_number().over(w.orderBy(F.desc(F.round(F.col(value) - F.col("_f"), 9)), *order))
    return r.withColumn("n", F.col("_f") + F.when(rank <= F.col("_more"), 1).otherwise(0)).drop("_f", "_more")


def group_total(parts: DataFrame, group: list[str], total: Column) -> DataFrame:
    """Shift the parts of a split area in proportion to their variances so that they add up to the group's total."""
    w = W.partitionBy(*group)
    return parts.withColumn("x", F.col("y") + part(F.col("v"), F.sum("v").over(w)) * (total - F.sum("y").over(w)))


def zero_mask(children: DataFrame, parents: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Children of non-zero parent cells only: the others are zero and need no variable."""
    return children.join(parents.filter(F.col(value) != 0).select(*keys), keys, "left_semi")


def bounded(fitted: DataFrame, parent: list[str], total: str, lower: str, upper: str, order: list[str], y: str = "y", v: str = "v") -> DataFrame:
    """Weighted least-squares children within [lower, upper] that add up to the parent: ``x``, and ``met`` where the bounds leave room for the total.

    x = clip(y - t * v) for the one t of the parent at which the clipped children add up. Their sum falls with t and bends
    only where a child leaves its upper or meets its lower bound: the bends are sorted, the sum at each is a running
    one, and t lies behind the last bend at which the sum is still the total or more. Out of reach: the nearest bounds, ``met`` false.
    """
    at = lambda bound: F.try_divide(F.col(y) - F.col(bound), F.col(v))
    within = lambda x: F.greatest(F.least(x, F.col(upper).cast("double")), F.col(lower).cast("double"))
    known = F.when(F.col(v) <= 0, within(F.col(y).cast("double")))
    # a known child has no slope: its bends have no t, stand first and add its value
    bends = F.array(F.struct(at(upper).alias("t"), F.col(v).alias("slope"), F.coalesce(known, F.col(upper).cast("double")).alias("start")), F.struct(at(lower).alias("t"), (-F.col(v)).alias("slope"), F.lit(0.0).alias("start")))
    b = fitted.select(*parent, *order, F.col(total).cast("double").alias("_total"), F.explode(bends).alias("_b")).select(*parent, *order, "_total", "_b.*")
    w = W.partitionBy(*parent).orderBy("t", F.desc("slope"), *order)
    # sum at a bend: all upper bounds, less what the open slopes have taken off so far
    b = b.withColumn("_s", F.sum("slope").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_d", F.col("t") - F.lag("t", 1).over(w))
    b = b.withColumn("_off", F.coalesce(F.lag("_s", 1).over(w) * F.col("_d"), F.lit(0.0)))
    sum_at = F.sum("start").over(W.partitionBy(*parent)) - F.sum("_off").over(w.rowsBetween(W.unboundedPreceding, 0))
    b = b.withColumn("_sum", sum_at)
    held = b.filter(F.col("_sum") >= F.col("_total") - 1e-9).groupBy(*parent).agg(F.max(F.struct("t", "_s", "_sum", "_total")).alias("_last"))
    t = F.col("_last.t") + F.when(F.col("_last._s") > 1e-12, (F.col("_last._sum") - F.col("_last._total")) / F.col("_last._s")).otherwise(F.lit(0.0))
    every = W.partitionBy(*parent)
    room = (F.sum(F.coalesce(known, F.col(lower))).over(every) <= F.col(total)) & (F.sum(F.coalesce(known, F.col(upper))).over(every) >= F.col(total))
    j = fitted.withColumn("met", room).join(held.select(*parent, t.alias("_t")), parent, "left")
    # no bend has enough: even the upper bounds fall short
    x = F.when(F.col(v) <= 0, known).when(F.col("_t").isNull(), F.col(upper).cast("double")).otherwise(within(F.col(y) - F.col("_t") * F.col(v)))
    return j.withColumn("x", x).drop("_t")


def marginal_pass(cells: DataFrame, group: list[str], query: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Cells (y, v) and the noisy answers of one query (group, q, qv) by inverse variance: y takes the gap in proportion to v.

    Gaps within ``tolerance`` leave the cells as they are; ``v`` is the cell's variance afterwards.
    """
    w = W.partitionBy(*group)
    j = cells.join(query.select(*group, "q", "qv"), group, "left")
    gap, spread = F.col("q") - F.sum("y").over(w), F.sum("v").over(w) + F.col("qv")
    apart = F.col("q").isNotNull() & (F.abs(gap) > tolerance)
    j = j.withColumn("_y", F.when(apart, F.col("y") + part(F.col("v") * gap, spread)).otherwise(F.col("y"))).withColumn("_v", F.when(apart, F.col("v") - part(F.col("v") * F.col("v"), spread)).otherwise(F.col("v")))
    return j.drop("y", "v", "q", "qv").withColumnsRenamed({"_y": "y", "_v": "v"})


def multi_query(cells: DataFrame, passes: list[tuple[list[str], DataFrame, float]]) -> DataFrame:
    """Fit cells to several noisy queries one after the other (group, answers (q, qv), tolerance); what comes later moves what came before.

    Where earlier answers have to stay, use :func:`tessera.operators.passes.fit_passes`.
    """
    return reduce(lambda c, p: marginal_pass(c, *p), passes, cells)


def round_nested(fitted: DataFrame, parent: list[str], cell: list[str], value: str = "x") -> DataFrame:
    """Whole numbers by the query hierarchy total -> first column -> ... -> cell: each query is rounded within the rounded one above it.

    Sums are taken to 9 places before they are rounded, so that the order of summation decides nothing.
    """
    summed = F.round(F.sum(value), 9).alias("_s")
    total = fitted.groupBy(*parent).agg(summed).select(*parent, F.greatest(F.round("_s").cast("long"), F.lit(0)).alias("_total"))
    for k in range(1, len(cell) + 1):
        sums = fitted.groupBy(*parent, *cell[:k]).agg(summed)
        above = [*parent, *cell[: k - 1]]
        total = round_controlled(sums.join(total, above), above, "_total", cell[:k], "_s").select(*parent, *cell[:k], F.col("n").alias("_total"))
    return total.withColumnRenamed("_total", "n")


def swap_repair(cells: DataFrame, unit: list[str], attribute: str, to: int, from_: int, rest: list[str], least: Column, n: str = "n", y: str = "y") -> DataFrame:
    """Move records of each unit from level ``from_`` of an attribute to level ``to`` until ``to`` has ``least`` records or ``from_`` has none.

    A record keeps its other levels ``rest``. Records move in the order of the squared change to the measured ``y``:
    the j-th from a cell of n to one of m changes it by 2 * (m - y_m) - 2 * (n - y_n) + 4 * j - 2, so they are ranked one
    by one, up to the lack for each cell. Returns unit, attribute, rest, n.
    """
    side = lambda level, as_n, as_y: cells.filter(F.col(attribute) == level).select(*unit, *rest, F.col(n).alias(as_n), F.col(y).alias(as_y))
    pairs = side(from_, "_n", "_yn").join(side(to, "_m", "_ym"), [*unit, *rest], "full")
    pairs = pairs.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_n", "_yn", "_m", "_ym")})
    w = W.partitionBy(*unit)
    pairs = pairs.withColumn("_lack", least - F.sum("_m").over(w))
    records = pairs.filter("_lack > 0 and _n > 0").withColumn("_j", F.explode(F.sequence(F.lit(1).cast("long"), F.least("_n", "_lack"))))
    cost = 2 * (F.col("_m") - F.col("_ym")) - 2 * (F.col("_n") - F.col("_yn")) + 4 * F.col("_j") - 2
    rank = F.row_number().over(w.orderBy(F.round(cost, 6), *rest, "_j"))
    moved = records.withColumn("_r", rank).filter("_r <= _lack").groupBy(*unit, *rest).agg(F.count("*").alias("_k"))
    changed = moved.withColumn(attribute, F.lit(to)).unionByName(moved.withColumn(attribute, F.lit(from_)).withColumn("_k", -F.col("_k")))
    j = cells.select(*unit, attribute, *rest, n).join(changed, [*unit, attribute, *rest], "full")
    return j.select(*unit, attribute, *rest, (F.coalesce(n, F.lit(0)) + F.coalesce("_k", F.lit(0))).cast("long").alias(n))


def top_down(levels: list[DataFrame], geo: str, lengths: list[int], cell: list[str], kept: Callable[[DataFrame], DataFrame] = lambda f: f) -> list[DataFrame]:
    """Fit measured levels (geo, cells, y, v), top first: non-negative whole numbers, children adding up to their fitted parent.

    The top is clipped and rounded by itself. Each level is one join with its parents
    and windows over (parent, cell); a single child gets its parent's count. ``kept`` writes and rereads a fitted level, so
    that no level is fitted again for those below it.
    """
    first = levels[0].withColumn("n", F.greatest(F.round("y").cast("long"), F.lit(0)))
    out = [kept(first.select(geo, *cell, "n"))]
    for frame, above in zip(levels[1:], lengths):
        parent = F.substring(geo, 1, above)
        up = out[-1].select(F.col(geo).alias("_parent"), *cell, F.col("n").alias("_total"))
        j = frame.withColumn("_parent", parent).join(up, ["_parent", *cell])
        keys = ["_parent", *cell]
        fitted = round_controlled(nonneg(j, keys, "_total", [geo]), keys, "_total", [geo])
        out.append(kept(fitted.select(geo, *cell, "n")))
    return out
