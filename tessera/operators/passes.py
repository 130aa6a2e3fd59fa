"""Fits of cells to several noisy queries at once, under sums that must hold and bounds on query rows.

The cells of one parent (its children's cells) are fitted together: the least squared distance to the measured cells and to the
noisy answers, each over its variance, with x >= 0, sums kept and query rows within bounds. The rows of a query without overlaps are
disjoint sets of cells, so Dykstra's projections take one query at a time exactly: a sum, its correction, and the
correction dealt to the cells by variance. Parents are independent, and a parent's cells are what its task holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SWEEPS, EPS = 20_000, 1e-10


@dataclass
class Query:
    """Noisy answers to sums of cells: ``by`` names columns of the cells (a cell with a null among them is in no row), ``answers`` has those, the parent's, and ``q`` and ``qv`` (variance).

    ``turn`` is the pass in which the query is fitted; later passes keep its fitted rows within the tolerance. A recode whose groups overlap is
    several queries, one for each set of disjoint groups.
    """

    name: str
    by: list[str]
    answers: DataFrame
    turn: int = 1


@dataclass
class Rows:
    """Sums over disjoint sets of cells: each cell's row (-1: none), and of each row the bounds, or the answer ``lower`` with its variance ``slack``."""

    of: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    slack: np.ndarray | None = None

    def sums(self, x: np.ndarray) -> np.ndarray:
        inside = self.of >= 0
        return np.bincount(self.of[inside], x[inside], len(self.lower))


def project(y: np.ndarray, v: np.ndarray, parts: list[Rows], sweeps: int = SWEEPS, eps: float = EPS) -> tuple[np.ndarray, int, float]:
    """x >= 0 nearest to y over v (and, where rows have a variance, to their answers) that meets all parts; sweeps taken; greatest violation left.

    Cells of variance 0 stay at y. Stops when a sweep moves no cell by more than ``eps`` (relative to the largest) and nothing is violated by more.
    """
    x, sign = y.astype(float).copy(), np.zeros(len(y))
    price = [np.zeros(len(p.lower)) for p in parts]
    weight = [p.sums(v) for p in parts]
    done, worst = 0, 0.0
    for done in range(1, sweeps + 1):
        before = x.copy()
        for k, p in enumerate(parts):
            s = p.sums(x)
            if p.slack is not None:
                step = (p.lower - s - p.slack * price[k]) / np.maximum(weight[k] + p.slack, 1e-300)
            else:
                free = s - weight[k] * price[k]
                step = np.where(weight[k] > 0, (np.clip(free, p.lower, p.upper) - free) / np.maximum(weight[k], 1e-300), 0.0) - price[k]
            price[k] += step
            x += v * np.append(step, 0.0)[p.of]
        free = x - v * sign
        held = np.where(v > 0, np.maximum(free, 0.0), x)
        sign = np.where(v > 0, (held - free) / np.where(v > 0, v, 1.0), 0.0)
        x = held
        scale = 1.0 + np.abs(x).max(initial=0.0)
        worst = max([0.0, *(float(np.maximum(p.lower - s, s - p.upper).max(initial=0.0)) for p in parts if p.slack is None for s in [p.sums(x)])])
        if np.abs(x - before).max(initial=0.0) <= eps * scale and worst <= 10 * eps * scale:
            break
    return x, done, worst


def row_numbers(frame: pd.DataFrame, by: list[str]) -> tuple[np.ndarray, int]:
    """Number of each cell's row by the columns ``by`` (none: one row of all cells); -1 where one of them is null."""
    if not by:
        return np.zeros(len(frame), np.int64), min(1, len(frame))
    codes = frame.groupby(by, sort=False, dropna=True).ngroup().to_numpy()
    codes = np.where(frame[by].isna().any(axis=1), -1, codes).astype(np.int64)
    return codes, int(codes.max(initial=-1)) + 1


def value_of(frame: pd.DataFrame, of: np.ndarray, n: int, column: str) -> np.ndarray:
    """A column that is equal in all cells of a row, by row."""
    out = np.full(n, np.nan)
    inside = of >= 0
    out[of[inside]] = frame[column].to_numpy(float)[inside]
    return out


def fit_passes(cells: DataFrame, parent: list[str], queries: list[Query], kept: dict[str, list[str]], tolerance: float = 0.0, sweeps: int = SWEEPS) -> DataFrame:
    """Cells (parent, their own keys, y, v, and the columns that queries and sums name) with x_1, x_2, ... after each pass, ``sweeps`` and ``violation``.

    ``kept``: column with the sum -> columns ``by`` whose rows must have it (a parent cell's count over its children). Pass t is nearest to
    the measured cells and to the answers of the queries with turn t, and holds the rows of each earlier query within ``tolerance`` of what that query's own pass fitted, so a
    feasible point exists: the fit of the pass before. ``sweeps`` and ``violation`` are the most of all passes, so a fit that did not settle shows. Queries without an answer for
    a row have no say there. A null y counts as unmeasured: 0 with the greatest variance of the parent. No cells: none.
    """
    turns = sorted({q.turn for q in queries})
    joined = cells
    for i, q in enumerate(queries):
        # answers have a row for each query row: never more than the cells
        own = q.answers.select(*parent, *q.by, F.col("q").cast("double").alias(f"_q{i}"), F.col("qv").cast("double").alias(f"_v{i}"))
        joined = joined.join(own, [*parent, *q.by], "left")
    specs = [(q.by, q.turn, f"_q{i}", f"_v{i}") for i, q in enumerate(queries)]
    drop = {c for _, _, *pair in specs for c in pair}
    names = [c for c in cells.columns]
    out = T.StructType([*cells.schema.fields, *[T.StructField(f"x_{t}", T.DoubleType()) for t in turns], T.StructField("sweeps", T.IntegerType()), T.StructField("violation", T.DoubleType())])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        v = frame["v"].to_numpy(float)
        v = np.where(frame["y"].isna(), np.nanmax(v), v)
        y = frame["y"].fillna(0.0).to_numpy(float)
        hard = []
        for column, by in kept.items():
            of, n = row_numbers(frame, by)
            total = value_of(frame, of, n, column)
            hard.append(Rows(of, total, total))
        took, worst, result = 0, 0.0, frame.drop(columns=list(drop)).copy()
        for t in turns:
            soft, settled = [], []
            for by, turn, q, qv in specs:
                of, n = row_numbers(frame, by)
                if turn == t:
                    answer, slack = value_of(frame, of, n, q), value_of(frame, of, n, qv)
                    soft.append(Rows(np.where(np.append(np.isnan(answer), True)[of], -1, of), np.nan_to_num(answer), np.nan_to_num(answer), np.nan_to_num(slack, nan=1.0)))
                elif turn < t:
                    was = Rows(of, np.zeros(n), np.zeros(n)).sums(result[f"x_{turn}"].to_numpy())
                    settled.append(Rows(of, was - tolerance, was + tolerance))
            x, done, left = project(y, v, [*soft, *settled, *hard], sweeps)
            result[f"x_{t}"] = x
            took, worst = max(took, done), max(worst, left)
        result["sweeps"], result["violation"] = took, worst
        return result[[*names, *[f"x_{t}" for t in turns], "sweeps", "violation"]]

    return joined.groupBy(*parent).applyInPandas(fit, out)


def kept_rows(fitted: DataFrame, parent: list[str], queries: list[Query], tolerance: float, eps: float = 1e-6) -> DataFrame:
    """By query and later pass: how many rows it has and how many lie further from their own pass's fit than the tolerance."""
    turns = sorted({q.turn for q in queries})
    out = None
    for q in queries:
        sums = fitted.na.drop(subset=q.by).groupBy(*parent, *q.by).agg(*[F.sum(f"x_{t}").alias(f"x_{t}") for t in turns if t >= q.turn])
        for t in (t for t in turns if t > q.turn):
            far = F.abs(F.col(f"x_{t}") - F.col(f"x_{q.turn}")) > tolerance + eps
            one = sums.agg(F.count("*").alias("n_rows"), F.count_if(far).alias("n_far")).select(F.lit(q.name).alias("query"), F.lit(t).alias("pass"), "n_rows", "n_far")
            out = one if out is None else out.unionByName(one)
    return out


@dataclass
class Bound:
    """Bounds on sums of cells: ``by`` as in :class:`Query`, ``limits`` with those columns, the parent's, ``lower`` and ``upper`` (null: none)."""

    name: str
    by: list[str]
    limits: DataFrame


def fit_bounds(cells: DataFrame, parent: list[str], bounds: list[Bound], kept: dict[str, list[str]], sweeps: int = SWEEPS) -> DataFrame:
    """Nearest x >= 0 to the cells (y, v) with all query rows within their bounds and all kept sums: x, ``met``, ``sweeps``, ``violation``.

    ``met`` is false in parents whose bounds and sums leave no point, as far as the sweeps tell: their x is a compromise, and ``violation`` is the most that is missed.
    """
    joined = cells
    for i, b in enumerate(bounds):
        own = b.limits.select(*parent, *b.by, F.coalesce(F.col("lower").cast("double"), F.lit(0.0)).alias(f"_l{i}"), F.coalesce(F.col("upper").cast("double"), F.lit(float("inf"))).alias(f"_u{i}"))
        joined = joined.join(own, [*parent, *b.by], "left")
    names = list(cells.columns)
    specs = [(b.by, f"_l{i}", f"_u{i}") for i, b in enumerate(bounds)]
    out = T.StructType([*cells.schema.fields, T.StructField("x", T.DoubleType()), T.StructField("met", T.BooleanType()), T.StructField("sweeps", T.IntegerType()), T.StructField("violation", T.DoubleType())])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for by, low, high in specs:
            of, n = row_numbers(frame, by)
            parts.append(Rows(of, np.nan_to_num(value_of(frame, of, n, low), nan=0.0), np.nan_to_num(value_of(frame, of, n, high), nan=np.inf, posinf=np.inf)))
        for column, by in kept.items():
            of, n = row_numbers(frame, by)
            total = value_of(frame, of, n, column)
            parts.append(Rows(of, total, total))
        x, done, worst = project(frame["y"].to_numpy(float), frame["v"].to_numpy(float), parts, sweeps)
        result = frame[names].copy()
        result["x"], result["met"], result["sweeps"], result["violation"] = x, bool(worst <= 1e-6), done, worst
        return result

    return joined.groupBy(*parent).applyInPandas(fit, out)


def bound_conflicts(parents: DataFrame, nested: list[tuple[list[str], DataFrame]], parent: list[str], total: str) -> DataFrame:
    """Parents whose nested bounds cannot hold: parent, ``least`` and ``most`` that they leave, the total and ``room``.

    ``nested``: (columns, lower and upper by them), finest first, each a refinement of the next. From the bottom up a set needs at least the greater of its own lower bound and its parts' sum,
    and can take at most the lesser of its own upper bound and its parts' sum; a set is in conflict where the least exceeds the most.
    """
    below = None
    for i, (by, limits) in enumerate(nested):
        own = limits.select(*parent, *by, F.coalesce(F.col("lower").cast("double"), F.lit(0.0)).alias("_l"), F.coalesce(F.col("upper").cast("double"), F.lit(float("inf"))).alias("_u"), F.lit(True).alias("_c"))
        if below is not None:
            up = below.groupBy(*parent, *by).agg(F.sum("_l").alias("_bl"), F.sum("_u").alias("_bu"), F.min("_c").alias("_bc"))
            own = own.join(up, [*parent, *by], "full").select(*parent, *by, F.greatest(F.coalesce("_l", F.lit(0.0)), F.coalesce("_bl", F.lit(0.0))).alias("_l"), F.least(F.coalesce("_u", F.lit(float("inf"))), F.coalesce("_bu", F.lit(float("inf")))).alias("_u"), F.coalesce("_bc", F.lit(True)).alias("_c"))
        below = own.withColumn("_c", F.col("_c") & (F.col("_l") <= F.col("_u")))
    ends = below.groupBy(*parent).agg(F.sum("_l").alias("least"), F.sum("_u").alias("most"), F.min("_c").alias("_c"))
    room = F.coalesce(F.col("_c") & (F.col(total) >= F.col("least")) & (F.col(total) <= F.col("most")), F.lit(True))
    return parents.select(*parent, total).join(ends, parent, "left").select(*parent, total, "least", "most", room.alias("room"))
