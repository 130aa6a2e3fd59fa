"""Fits to several queries and within bounds on query rows: optimality, kept tolerances, conflicts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import fit, passes


def problem(rng):
    """Cells of a 3 x 4 table with noisy rows and columns, a kept total, and bounds on pairs of rows."""
    y, v = rng.normal(4, 5, 12), rng.uniform(0.2, 3, 12)
    a, b = np.repeat(np.arange(3), 4), np.tile(np.arange(4), 3)
    total = np.array([max(0.0, round(y.sum()))])
    rows = passes.Rows(a, *[rng.normal(14, 5, 3)] * 2, rng.uniform(0.1, 2, 3))
    low = rng.uniform(0, 0.2, 4) * total
    bounds = passes.Rows(np.where(b < 3, b, -1), low[:3], low[:3] + rng.uniform(0.05, 0.3, 3) * (total + 1))
    return y, v, rows, bounds, passes.Rows(np.zeros(12, int), total, total)


def cost(x, y, v, rows):
    return ((x - y) ** 2 / v).sum() + ((rows.sums(x) - rows.lower) ** 2 / rows.slack).sum()


def test_projection_is_the_least_among_feasible_points():
    rng = np.random.default_rng(6)
    for _ in range(10):
        y, v, rows, bounds, total = problem(rng)
        x, sweeps, worst = passes.project(y, v, [rows, bounds, total])
        assert worst < 1e-6 and x.min() >= 0 and sweeps < passes.SWEEPS
        best = cost(x, y, v, rows)
        # the segment to any other feasible point goes uphill at once
        for _ in range(8):
            z, _, far = passes.project(rng.normal(4, 8, 12), rng.uniform(0.2, 3, 12), [bounds, total])
            assert far < 1e-6
            for step in (1.0, 1e-2, 1e-4):
                assert cost(x + step * (z - x), y, v, rows) >= best - 1e-6 * (1 + abs(best))


def test_projection_onto_simplex_equals_closed_form(spark):
    rng = np.random.default_rng(3)
    rows = [(p, i, float(rng.normal(3, 6)), float(rng.uniform(0.5, 3)), float(rng.integers(1, 30))) for p in range(30) for i in range(6)]
    rows = [(p, i, y, v, rows[p * 6][4]) for p, i, y, v, _ in rows]
    df = spark.createDataFrame(rows, "p int, i int, y double, v double, total double")
    want = {(r.p, r.i): r.x for r in fit.nonneg(df, ["p"], "total", ["i"]).collect()}
    got = passes.fit_passes(df, ["p"], [passes.Query("none", [], df.select("p", F.lit(0.0).alias("q"), F.lit(1e18).alias("qv")).distinct())], {"total": []}).collect()
    assert all(abs(want[r.p, r.i] - r.x_1) < 1e-6 for r in got) and max(r.violation for r in got) < 1e-6


def two_levels(spark):
    rng = np.random.default_rng(9)
    cells = [(p, g, a, b, float(rng.normal(3, 6)) if rng.random() < 0.95 else None, float(rng.uniform(0.5, 3))) for p in range(12) for g in range(4) for a in range(3) for b in range(2)]
    df = spark.createDataFrame(cells, "p int, g int, a int, b int, y double, v double")
    total = spark.createDataFrame([(p, a, b, float(rng.integers(0, 25))) for p in range(12) for a in range(3) for b in range(2)], "p int, a int, b int, total double")
    by = {"total": ["g"], "a": ["g", "a"], "b": ["g", "b"]}
    ask = {n: spark.createDataFrame([tuple(map(int, k)) + (float(rng.normal(20, 9)), 0.5) for k in df.select("p", *c).distinct().collect()], ", ".join(f"{x} int" for x in ["p", *c]) + ", q double, qv double") for n, c in by.items()}
    return df.join(total, ["p", "a", "b"]), [passes.Query("total", by["total"], ask["total"], 1), passes.Query("a", by["a"], ask["a"], 2), passes.Query("b", by["b"], ask["b"], 3)]


@pytest.mark.parametrize("tolerance", [0.0, 0.5])
def test_later_passes_keep_earlier_answers(spark, tolerance):
    cells, queries = two_levels(spark)
    got = passes.fit_passes(cells, ["p"], queries, {"total": ["a", "b"]}, tolerance).cache()
    assert got.count() == cells.count() and got.agg(F.max("violation")).first()[0] < 1e-6
    assert got.filter("x_1 < 0 or x_2 < 0 or x_3 < 0").count() == 0
    sums = got.groupBy("p", "a", "b").agg(F.first("total").alias("t"), *[F.sum(f"x_{k}").alias(f"s{k}") for k in (1, 2, 3)])
    assert sums.filter("abs(s1 - t) > 1e-6 or abs(s2 - t) > 1e-6 or abs(s3 - t) > 1e-6").count() == 0
    kept = {(r.query, r["pass"]): (r.n_rows, r.n_far) for r in passes.kept_rows(got, ["p"], queries, tolerance).collect()}
    assert kept == {("total", 2): (48, 0), ("total", 3): (48, 0), ("a", 3): (144, 0)}
    # without the passes the same answers move
    loose = passes.fit_passes(cells, ["p"], [passes.Query(q.name, q.by, q.answers, 1) for q in queries], {"total": ["a", "b"]})
    apart = loose.groupBy("p", "g").agg(F.sum("x_1").alias("s")).join(got.groupBy("p", "g").agg(F.sum("x_1").alias("t")), ["p", "g"])
    assert apart.filter("abs(s - t) > 0.01").count() > 0
    again = passes.fit_passes(cells.repartition(7), ["p"], queries, {"total": ["a", "b"]}, tolerance)
    assert again.join(got.select("p", "g", "a", "b", F.col("x_3").alias("w")), ["p", "g", "a", "b"]).filter("abs(x_3 - w) > 1e-6").count() == 0


def test_bounds_on_query_rows_and_conflicts(spark):
    rows = [(1, a, b, y, 1.0, 10.0) for a, b, y in ((0, 0, 9.0), (0, 1, 3.0), (1, 0, -2.0), (1, 1, 0.5))] + [(2, a, b, 1.0, 1.0, 10.0) for a in (0, 1) for b in (0, 1)]
    cells = spark.createDataFrame(rows, "p int, a int, b int, y double, v double, total double")
    limits = spark.createDataFrame([(1, 0, None, 7.0), (1, 1, 2.0, None), (2, 0, 0.0, 3.0), (2, 1, 1.0, 4.0)], "p int, a int, lower double, upper double")
    got = passes.fit_bounds(cells, ["p"], [passes.Bound("a", ["a"], limits)], {"total": []}, sweeps=3000).collect()
    s = {(p, a): sum(r.x for r in got if (r.p, r.a) == (p, a)) for p in (1, 2) for a in (0, 1)}
    assert all(r.met for r in got if r.p == 1) and abs(s[1, 0] - 7) < 1e-6 and abs(s[1, 1] - 3) < 1e-6
    assert not any(r.met for r in got if r.p == 2)
    fine = spark.createDataFrame([(1, 0, 0, 0.0, 3.0), (1, 0, 1, 1.0, 9.0)], "p int, a int, b int, lower double, upper double")
    parents = spark.createDataFrame([(1, 10), (2, 10), (3, 4)], "p int, total int")
    found = {r.p: (r.least, r.most, r.room) for r in passes.bound_conflicts(parents, [(["a", "b"], fine), (["a"], limits)], ["p"], "total").collect()}
    assert found == {1: (3.0, float("inf"), True), 2: (1.0, 7.0, False), 3: (None, None, True)}


def test_nested_rounding_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(p, a, b, float(rng.integers(0, 400)) / 8) for p in range(30) for a in range(3) for b in range(5)]
    df = spark.createDataFrame(rows, "p int, a int, b int, x double")
    found = [sorted(map(tuple, fit.round_nested(df.repartition(n, F.rand(n)), ["p"], ["a", "b"]).collect())) for n in (1, 4, 7)]
    assert found[0] == found[1] == found[2]
