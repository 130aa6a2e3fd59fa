"""Noisy measurements by a strategy: every budgeted query of several histograms, with its variance and its budget.

:func:`answers` hashes row keys for its noise: reproducible, for experiments only. What leaves the house goes through :func:`release`.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import hist, noise, query
from tessera.sources import files


def pure_geometric(keys: list[str], budget: Column, sensitivity: Column, seed: int) -> tuple[Column, Column]:
    """Whole-number noise for a pure budget and its variance: P(x) proportional to exp(-abs(x) * budget / sensitivity)."""
    q = F.exp(-budget / sensitivity)
    u, v = noise.uniform(*keys, seed=seed), noise.uniform(*keys, seed=seed + 1)
    return noise.geometric_difference(u, v, q), 2 * q / ((1 - q) * (1 - q))


def zcdp_gaussian(keys: list[str], budget: Column, sensitivity: Column, seed: int) -> tuple[Column, Column]:
    """Rounded normal noise for a zCDP budget rho: variance sensitivity**2 / (2 * rho)."""
    variance = sensitivity * sensitivity / (2 * budget)
    return noise.rounded_normal(noise.uniform(*keys, seed=seed), noise.uniform(*keys, seed=seed + 1), variance), variance


def answers(histograms: dict[str, tuple[DataFrame, query.Schema, list[str], str]], shares: DataFrame, total: float, keys: list[str], mechanism=pure_geometric, seed: int = 0) -> DataFrame:
    """(histogram, *keys, query, cell, answer, variance, budget) of every query with a share.

    ``histograms``: name -> (cells of all levels, schema, queries, value column); ``keys`` hold ``level``.
    ``shares``: (histogram, level, query, whole), the share of the budget ``total`` that the query has at its level. Queries without a share are not answered; true values do not leave the function.
    """
    out = None
    for name, (cells, schema, queries, value) in histograms.items():
        found = query.answer_many(cells, schema, queries, keys, [value], "cell")
        most = F.create_map(*[x for q in queries for x in (F.lit(q), F.lit(float(schema.sensitivity(q))))])
        found = found.select(F.lit(name).alias("histogram"), *keys, "query", "cell", F.col(value).alias("_true"), most[F.col("query")].alias("_most"))
        out = found if out is None else out.unionByName(found)
    joined = out.join(shares.select("histogram", "level", "query", "whole"), ["histogram", "level", "query"]).withColumn("budget", F.col("whole") * total)
    x, variance = mechanism(["histogram", *keys, "query", "cell"], F.col("budget"), F.col("_most"), seed)
    return joined.select("histogram", *keys, "query", "cell", (F.col("_true") + x).alias("answer"), variance.alias("variance"), "budget")


Share = tuple[str, int, str, Fraction]


def committed(noisy: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """What was written of a frame with fresh draws: it is evaluated once, for the write, and only committed files are read after."""
    path = path or files.scratch(noisy.sparkSession, name)
    noisy.write.parquet(path)
    return noisy.sparkSession.read.parquet(path)


def release(histograms: dict[str, tuple[DataFrame, query.Schema, list[str], str]], shares: list[Share], total: Fraction, keys: list[str], units: DataFrame, gaussian: bool = False, path: str | None = None) -> DataFrame:
    """(histogram, *keys, query, cell, answer, variance, budget) for publication, drawn exactly and written once to ``path`` (default: a new one in the shared folder).

    ``shares``: (histogram, level, query, share of ``total``) as exact fractions that add up to at most 1 over the levels and queries. ``units`` lists the ``keys`` (with ``level``) to be
    answered, known without looking at the data: each gets every level of each of its queries, so that no answer is missing where the
    truth is zero. Pure budgets: P(x) proportional to exp(-abs(x) * budget / sensitivity). ``gaussian``: zCDP budgets, discrete Gaussian of
    variance 1 / (2 * budget), for queries in which each record counts in one row at most; others are refused. A query without a share, or with a share of 0, is not
    answered. Neither true values nor which of them are zero can be read from the result.
    """
    if any(s < 0 for *_, s in shares) or sum((s for *_, s in shares), Fraction(0)) > 1:
        raise ValueError("shares are negative or exceed the whole")
    out = None
    for name, (cells, schema, queries, value) in histograms.items():
        own = [(level, q, Fraction(s) * total) for h, level, q, s in shares if h == name and s > 0]
        if unknown := {q for _, q, _ in own} - set(queries):
            raise ValueError(f"{name} has no queries {sorted(unknown)}")
        if gaussian and any(schema.sensitivity(q) > 1 for _, q, _ in own):
            raise ValueError("a Gaussian release asks for queries in which a record counts once")
        for level in sorted({level for level, *_ in own}):
            asked = {q: b for at, q, b in own if at == level}
            found = query.answer_many(cells.filter(F.col("level") == level), schema, list(asked), keys, [value], "cell")
            full = query.fill_missing(found, schema, list(asked), keys, [value], units.filter(F.col("level") == level), "cell")
            ratio = {q: 1 / (2 * b) if gaussian else b / schema.sensitivity(q) for q, b in asked.items()}
            spread = {q: noise.gaussian_moment(float(r)) if gaussian else noise.geometric_variance(float(r)) for q, r in ratio.items()}
            lookup = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("query")]
            one = full.select(
                F.lit(name).alias("histogram"), *keys, "query", "cell", F.col(value).alias("_true"), lookup({q: r.numerator for q, r in ratio.items()}).alias("_num"), lookup({q: r.denominator for q, r in ratio.items()}).alias("_den"),
                lookup(spread).alias("variance"), lookup({q: float(b) for q, b in asked.items()}).alias("budget"),
            )
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no query has a share")
    noisy = noise.secure_by_row(out, "_true", "_num", "_den", "answer", gaussian)
    return committed(noisy.select("histogram", *keys, "query", "cell", "answer", "variance", "budget"), "release", path)


def strategy_norm(factors: dict[str, list[list[int]]]) -> int:
    """Sensitivity of a product of whole-number matrices: the most that a record adds up to over the rows, by dim and multiplied."""
    return math.prod(int(np.abs(np.array(m)).sum(axis=0).max()) for m in factors.values())


def strategy_answers(frame: DataFrame, keys: list[str], factors: dict[str, list[list[int]]], value: str, budget: Fraction | None, units: DataFrame | None = None, per: int = 1, seed: int | None = None, path: str | None = None) -> DataFrame:
    """Answers to a strategy, the product over dims of whole-number matrices (rows x levels) over ``per``: keys, <dim>_row, answer, variance.

    Every combination of matrix rows is answered for each of the ``units`` (default: keys that have cells), also where the truth is zero. Noise is geometric on the whole numbers at
    budget / :func:`strategy_norm`: fresh exact draws, written once; with a ``seed`` hashed ones, for experiments; none for a budget of None.
    """
    rows = [f"{d}_row" for d in factors]
    found = query.kron(frame, keys, {d: [[float(x) for x in r] for r in m] for d, m in factors.items()}, value, "_true")
    there = found if units is None else units.select(*keys).distinct().join(found, keys, "left").withColumns({r: F.coalesce(r, F.lit(0)) for r in rows})
    full = hist.densify(there.withColumn("_true", F.coalesce("_true", F.lit(0.0))), keys, rows, [len(m) for m in factors.values()], "_true").withColumn("_true", F.round("_true").cast("long"))
    if budget is None:
        return full.select(*keys, *rows, (F.col("_true") / per).alias("answer"), F.lit(0.0).alias("variance"))
    ratio = Fraction(budget) / strategy_norm(factors)
    variance = F.lit(noise.geometric_variance(float(ratio)) / per**2)
    if seed is not None:
        x = noise.double_geometric([*keys, *rows], float(ratio), seed=seed)
        return full.select(*keys, *rows, ((F.col("_true") + x) / per).alias("answer"), variance.alias("variance"))
    noisy = noise.secure_by_row(full.withColumns({"_num": F.lit(ratio.numerator), "_den": F.lit(ratio.denominator)}), "_true", "_num", "_den", "_noisy")
    return committed(noisy.select(*keys, *rows, (F.col("_noisy") / per).alias("answer"), variance.alias("variance")), "strategy", path)


def reconstruct(answers: DataFrame, keys: list[str], factors: dict[str, list[list[int]]], per: dict[str, int] | None = None) -> DataFrame:
    """Least-squares cells behind a strategy's answers: keys, dims, x, variance; no matrix over all cells is made.

    The pseudo-inverse of a product is the product of the pseudo-inverses, so one dim after the other is turned from matrix rows to levels, each by
    one aggregation. Answers are independent, so variances follow with squared weights. ``per`` divides a dim's matrix, as it did for the answers.
    """
    done = answers
    left = list(factors)
    for d, m in factors.items():
        left = left[1:]
        inverse = np.linalg.pinv(np.array(m, float) / (per or {}).get(d, 1))
        weights = F.array(*[F.array(*[F.struct(F.lit(level).alias("level"), F.lit(float(w)).alias("w")) for level, w in enumerate(column) if abs(w) > 1e-14]) for column in inverse.T])
        spread = done.withColumn("_w", F.explode(F.get(weights, F.col(f"{d}_row"))))
        others = [c for c in done.columns if c not in ("answer", "variance", f"{d}_row")]
        done = spread.groupBy(*others, F.col("_w.level").alias(d)).agg(F.sum(F.col("answer") * F.col("_w.w")).alias("answer"), F.sum(F.col("variance") * F.col("_w.w") * F.col("_w.w")).alias("variance"))
    return done.select(*keys, *factors, F.col("answer").alias("x"), "variance")
