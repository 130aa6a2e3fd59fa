"""Noise mechanisms. Column versions hash their keys for uniforms: whoever knows the keys knows the noise, so they are for experiments and tests only.

Releases use :func:`secure_by_row`, :func:`secure_geometric` and :func:`secure_gaussian`, which draw whole numbers with the operating system's randomness inside the tasks and
whole-number arithmetic only. A task that runs again draws again: write the result once and read only what was written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def uniform(*keys: str, seed: int = 0) -> Column:
    """Uniform in (0, 1), fixed by the keys (whole numbers or strings) and the seed, whatever the partitioning: 52 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def geometric_difference(u: Column, v: Column, q: Column) -> Column:
    """Difference of two geometric numbers of failures, of chance ``q`` each: P(x) proportional to q**abs(x)."""
    side = lambda x: F.floor(F.log(x) / F.log(q)).cast("long")
    return side(u) - side(v)


def double_geometric(keys: list[str], epsilon: float, sensitivity: int = 1, seed: int = 0) -> Column:
    """Whole-number noise with P(x) proportional to exp(-epsilon * abs(x) / sensitivity)."""
    return geometric_difference(uniform(*keys, seed=seed), uniform(*keys, seed=seed + 1), F.lit(math.exp(-epsilon / sensitivity)))


def geometric_variance(epsilon: float, sensitivity: int = 1) -> float:
    p = 1 - math.exp(-epsilon / sensitivity)
    return 2 * (1 - p) / (p * p)


def rounded_normal(u: Column, v: Column, variance: Column) -> Column:
    """Rounded normal noise from two uniforms."""
    return F.round(F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v) * F.sqrt(variance)).cast("long")


def rounded_gaussian(keys: list[str], variance: float, seed: int = 0) -> Column:
    """Rounded normal noise by Box-Muller, for experiments."""
    return rounded_normal(uniform(*keys, seed=seed), uniform(*keys, seed=seed + 1), F.lit(float(variance)))


def laplace(u: Column, scale: Column | float) -> Column:
    """Laplace noise from one uniform by inversion."""
    scale = scale if isinstance(scale, Column) else F.lit(float(scale))
    return -scale * F.signum(u - 0.5) * F.log(1 - 2 * F.abs(u - 0.5))


def log_laplace(x: Column, u: Column, scale: float, alpha: float) -> Column:
    """exp(ln(x + g) + Laplace) - g with g = 1 / alpha."""
    return F.exp(F.log(x + 1 / alpha) + laplace(u, scale)) - 1 / alpha


def smooth_laplace(x: Column, u: Column, largest: Column, alpha: float, epsilon: float, delta: float) -> Column:
    """x + max(largest * alpha, 1) * (2 / epsilon) * Laplace(1); null where alpha + 1 > exp(epsilon / (2 ln(1 / delta)))."""
    fits = alpha + 1 <= math.exp(epsilon / (2 * math.log(1 / delta)))
    value = x + F.greatest(largest * alpha, F.lit(1.0)) * (2 / epsilon) * laplace(u, 1.0)
    return value if fits else F.lit(None).cast("double")


def randomized_response(level: Column, size: int, epsilon: float, keys: list[str], seed: int = 0) -> Column:
    """Keep the true level with chance e**epsilon / (e**epsilon + size - 1), else a uniform other level."""
    keep = math.exp(epsilon) / (math.exp(epsilon) + size - 1)
    other = F.floor(uniform(*keys, seed=seed + 1) * (size - 1)).cast("int")
    return F.when(uniform(*keys, seed=seed) < keep, level).otherwise(F.when(other >= level, other + 1).otherwise(other))


def zero_budget(value: Column, budget: Column) -> tuple[Column, Column]:
    """Answer and variance under no budget: null and infinity, so the query has no weight."""
    none = budget <= 0
    return F.when(~none, value), F.when(none, F.lit(float("inf")))


def bernoulli_exp(a: int, b: int) -> bool:
    """True with chance exp(-a / b), exactly, for whole numbers a >= 0 and b > 0."""
    from secrets import randbelow

    while a > b:  # whole steps of exp(-1)
        if not bernoulli_exp(1, 1):
            return False
        a -= b
    # the alternating series of exp: k uniform products below a / b in a row, an odd number of trials wins
    k = 1
    while randbelow(b * k) < a:
        k += 1
    return k % 2 == 1


def discrete_laplace(num: int, den: int) -> int:
    """Whole number with P(x) proportional to exp(-abs(x) * num / den), exactly."""
    from secrets import randbelow

    while True:
        u = randbelow(den)
        if not bernoulli_exp(u, den):
            continue
        v = 0
        while bernoulli_exp(1, 1):
            v += 1
        y = (u + den * v) // num
        if not randbelow(2):
            return y
        if y:
            return -y


def discrete_gaussian(num: int, den: int) -> int:
    """Whole number with P(x) proportional to exp(-x**2 / (2 * num / den)), exactly: discrete Laplace draws, of which the right share is kept."""
    t = math.isqrt(num // den) + 1
    while True:
        y = discrete_laplace(1, t)
        # chance exp(-(abs(y) - s / t)**2 / (2 s)) with s = num / den, over one denominator
        if bernoulli_exp((abs(y) * t * den - num) ** 2, 2 * num * t * t * den):
            return y


def secure(frame: DataFrame, value: str, draw, out: str) -> DataFrame:
    """``out``: the value plus a draw for each row. Marked as not deterministic, so that Spark evaluates it once for each row of a run."""

    @F.pandas_udf("long")
    def add(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in values:
            yield s + pd.Series([draw() for _ in range(len(s))], index=s.index, dtype="int64")

    return frame.withColumn(out, add.asNondeterministic()(F.col(value).cast("long")))


def secure_by_row(frame: DataFrame, value: str, num: str, den: str, out: str, gaussian: bool = False) -> DataFrame:
    """``out``: the whole-number value plus an exact draw at the row's own ratio num / den of whole numbers above 0; any of them null: null.

    P(x) proportional to exp(-abs(x) * num / den), or with ``gaussian`` to exp(-x**2 / (2 * num / den)). From the operating system's randomness, and not
    deterministic: write the result once and read only what was written.
    """

    @F.pandas_udf("long")
    def add(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        draw = discrete_gaussian if gaussian else discrete_laplace
        for values, nums, dens in parts:
            rows = zip(values.astype("Int64"), nums.astype("Int64"), dens.astype("Int64"))
            yield pd.Series([None if pd.isna(x) or pd.isna(a) or pd.isna(b) else int(x) + draw(int(a), int(b)) for x, a, b in rows], index=values.index, dtype="Int64")

    return frame.withColumn(out, add.asNondeterministic()(F.col(value).cast("long"), F.col(num).cast("long"), F.col(den).cast("long")))


def secure_geometric(frame: DataFrame, value: str, epsilon_num: int, epsilon_den: int, out: str) -> DataFrame:
    """Exact whole-number noise with P(x) proportional to exp(-abs(x) * num / den) from the operating system's randomness; null values stay null."""
    return secure(frame, value, lambda: discrete_laplace(epsilon_num, epsilon_den), out)


def secure_gaussian(frame: DataFrame, value: str, variance_num: int, variance_den: int, out: str) -> DataFrame:
    """Exact discrete Gaussian noise, P(x) proportional to exp(-x**2 * den / (2 * num)), from the operating system's randomness; null values stay null."""
    return secure(frame, value, lambda: discrete_gaussian(variance_num, variance_den), out)


def gaussian_moment(variance: float) -> float:
    """Variance of the discrete Gaussian by its series."""
    reach = math.ceil(14 * variance**0.5) + 2
    weights = [(x, math.exp(-x * x / (2 * variance))) for x in range(-reach, reach + 1)]
    return sum(x * x * w for x, w in weights) / sum(w for _, w in weights)


def count_below(values: list[float], u: Column) -> Column:
    """Number of the ascending values below ``u`` by binary search; ``u`` is evaluated once for a row, however often it is compared."""
    known = F.array(*map(F.lit, values))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(values).bit_length()))])
    search = lambda x: F.aggregate(steps, F.lit(0), lambda found, step: F.when(F.get(known, found + step - 1) < x, found + step).otherwise(found))
    return F.get(F.transform(F.array(u), search), F.lit(0))


def gaussian_steps(u: Column, variance: float, reach: int | None = None) -> Column:
    """Discrete Gaussian from one uniform by inversion over a fixed table of cumulative chances; the tails beyond ``reach`` (12 sd) have no mass in a double."""
    reach = reach if reach is not None else max(2, math.ceil(12 * variance**0.5))
    weights = [math.exp(-x * x / (2 * variance)) for x in range(-reach, reach + 1)]
    total, run, cumulative = sum(weights), 0.0, []
    for w in weights:
        run += w
        cumulative.append(run / total)
    return (count_below(cumulative, u) - reach).cast("long")


def float_gaussian(u: Column, v: Column, variance: float) -> Column:
    """Fast approximation of the discrete Gaussian for experiments: a rounded normal with the variance less 1/12."""
    return F.round(F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v) * max(variance - 1 / 12, 0.0) ** 0.5).cast("long")


def smooth_gamma(x: Column, u: Column, largest: Column, alpha: float, epsilon: float, points: int = 2001) -> Column:
    """x + max(largest * alpha, 1) * (5 / epsilon) * Z, density of Z proportional to 1 / (1 + z**4), by inversion on a fixed grid in z = tan."""
    grid = [math.tan(math.pi * (i / (points - 1) - 0.5) * 0.999) for i in range(points)]
    run, cumulative = 0.0, [0.0]
    for a, b in zip(grid, grid[1:]):
        run += (b - a) * (1 / (1 + a**4) + 1 / (1 + b**4)) / 2
        cumulative.append(run)
    index = F.greatest(count_below([c / run for c in cumulative], u) - 1, F.lit(0))
    return x + F.greatest(largest * alpha, F.lit(1.0)) * (5 / epsilon) * F.get(F.array(*map(F.lit, grid)), index)
