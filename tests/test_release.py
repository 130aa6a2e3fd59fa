"""Measurements for publication: dense, exact, written once; strategies and what is rebuilt from them."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import measure, noise, query, sqlnoise

SCHEMA = query.Schema({"a": 3, "b": 2}, {"wide": ("a", {"x": [0, 1], "y": [1, 2]})})


def cells(spark):
    return spark.createDataFrame([(1, "1", 0, 0, 5), (1, "1", 2, 1, 7), (1, "2", 1, 1, 1), (0, "", 0, 0, 5), (0, "", 2, 1, 7), (0, "", 1, 1, 1)], "level int, geocode string, a int, b int, n long")


def public(spark):
    return spark.createDataFrame([(0, ""), (1, "1"), (1, "2"), (1, "3")], "level int, geocode string")


def test_draws_follow_each_rows_own_ratio(spark):
    df = spark.range(12000).select(F.lit(10).alias("x"), F.when(F.col("id") % 2 == 0, 1).otherwise(4).alias("num"), F.lit(3).alias("den"))
    for gaussian, want in ((False, {1: noise.geometric_variance(1 / 3), 4: noise.geometric_variance(4 / 3)}), (True, {1: noise.gaussian_moment(1 / 3), 4: noise.gaussian_moment(4 / 3)})):
        got = noise.secure_by_row(df, "x", "num", "den", "y", gaussian).groupBy("num").agg(F.avg("y").alias("m"), F.var_pop("y").alias("v")).collect()
        for r in got:
            assert abs(r.m - 10) < 6 * (want[r.num] / 6000) ** 0.5 and abs(r.v / want[r.num] - 1) < 6 * (9 / 6000) ** 0.5
    odd = spark.createDataFrame([(None, 1, 2), (3, None, 2), (2**60, 10**9, 1)], "x long, num long, den long")
    assert [r.y for r in noise.secure_by_row(odd, "x", "num", "den", "y").collect()] == [None, None, 2**60]


def test_release_is_dense_fixed_and_without_truth(spark):
    shares = [("p", 0, "total", Fraction(1, 4)), ("p", 1, "wide", Fraction(1, 4)), ("p", 1, "a * b", Fraction(1, 2)), ("p", 0, "a", Fraction(0))]
    out = measure.release({"p": (cells(spark), SCHEMA, ["total", "a", "wide", "a * b"], "n")}, shares, Fraction(10**9), ["level", "geocode"], public(spark))
    assert out.columns == ["histogram", "level", "geocode", "query", "cell", "answer", "variance", "budget"]
    rows = out.collect()
    assert sorted(map(str, rows)) == sorted(map(str, out.collect()))
    assert len(rows) == 1 + 3 * (2 + 6)  # also units and cells without records
    got = {(r.level, r.geocode, r["query"], r.cell): r.answer for r in rows}
    # at this budget a draw other than 0 has a chance below exp(-10**8)
    assert got[0, "", "total", "total"] == 13 and got[1, "1", "wide", "x"] == 5 and got[1, "1", "wide", "y"] == 7 and got[1, "2", "a * b", "1 BY 1"] == 1 and got[1, "3", "a * b", "0 BY 0"] == 0
    assert {(r["query"], r.budget) for r in rows} == {("total", 2.5e8), ("wide", 2.5e8), ("a * b", 5e8)}


def test_release_refuses(spark):
    given = {"p": (cells(spark), SCHEMA, ["total", "wide"], "n")}
    for shares, gaussian in (([("p", 0, "total", Fraction(2))], False), ([("p", 0, "total", Fraction(-1))], False), ([("p", 0, "a", Fraction(1))], False), ([("p", 0, "wide", Fraction(1))], True), ([], False)):
        with pytest.raises(ValueError):
            measure.release(given, shares, Fraction(1), ["level", "geocode"], public(spark), gaussian)


def test_strategy_comes_back_and_errors_have_the_stated_variance(spark):
    rng = np.random.default_rng(2)
    table = {(g, a, b): int(rng.integers(0, 20)) for g in range(200) for a in range(3) for b in range(2) if rng.random() < 0.5}
    df = spark.createDataFrame([(*k, n) for k, n in table.items()], "g int, a int, b int, n long")
    units = spark.range(203).select(F.col("id").cast("int").alias("g"))
    factors = {"a": [[1, 0, 0], [0, 1, 0], [0, 0, 1], [1, 1, 1]], "b": [[3, 0], [0, 3], [1, -1]]}
    assert measure.strategy_norm(factors) == 2 * 4
    exact = measure.reconstruct(measure.strategy_answers(df, ["g"], factors, "n", None, units, per=3), ["g"], factors, {"b": 3}).collect()
    assert len(exact) == 203 * 6 and all(abs(r.x - table.get((r.g, r.a, r.b), 0)) < 1e-9 for r in exact)
    for seed in (None, 5):
        x = measure.reconstruct(measure.strategy_answers(df, ["g"], factors, "n", Fraction(2), units, per=3, seed=seed), ["g"], factors, {"b": 3}).collect()
        ratio = [(r.x - table.get((r.g, r.a, r.b), 0)) ** 2 / r.variance for r in x]
        assert abs(np.mean(ratio) - 1) < 0.35
    # the pseudo-inverse of the whole matrix gives the same variances
    whole = np.linalg.pinv(np.kron(np.array(factors["a"]), np.array(factors["b"]) / 3))
    want = (whole**2).sum(axis=1) * noise.geometric_variance(2 / 8) / 9
    assert all(abs(r.variance - want[r.a * 2 + r.b]) < 1e-9 for r in x)


def test_levels_made_in_the_plan(spark):
    keys = spark.createDataFrame([("x",), ("y",)], "k string")
    for q in ("total", "a", "wide * b", "detailed"):
        got = sorted(r.level for r in query.with_levels(keys, SCHEMA, [q]).filter("k = 'x'").collect())
        assert got == sorted(SCHEMA.levels(q))


def test_composition_is_checked_before_noise_is_drawn(spark):
    lap = sqlnoise.laplace_measure
    t = spark.createDataFrame([("x", 1.0, 2.0, 3.0)], "k string, a double, b double, c double")
    plan = {"t": [[lap("a", 0.5), lap("b", 0.2)], [lap("c", 0.3)]]}
    assert sqlnoise.composed(plan) == ({"t": [[0.5, 0.5], [0.3]]}, {"t": 0.8}, 0.8)
    got = sqlnoise.apply({"t": t, "u": t}, plan, 0.8, {"t": ["k"]}, as_they_are=("u",))
    assert got["t"].first().epsilon == 0.8 and got["u"] is t
    # a and b are drawn at the same budget
    at = lambda e: t.select((F.col("b") + noise.laplace(noise.uniform("k", seed=1), 1 / e)).alias("b")).first().b
    assert got["t"].first().b == at(0.5) != at(0.2)
    for bad, whole, tables in ((plan, 1.0, {"t": t}), (plan, 0.8, {"t": t, "u": t}), ({"t": [[lap("z", 1.0)]]}, 1.0, {"t": t}), ({"t": [[lap("a", 0.5)], [lap("a", 0.5)]]}, 1.0, {"t": t}), ({"t": [[lap("a", 0.0)]]}, 0.0, {"t": t}), ({"t": [[]]}, 0.0, {"t": t})):
        with pytest.raises(ValueError):
            sqlnoise.apply(tables, bad, whole, {"t": ["k"]})


def test_uniforms_follow_the_row_number_and_nothing_else(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 1000).alias("k"))
    found = []
    for parts in (1, 6):
        given = sqlnoise.uniforms(spark, 500, ["u", "v"], seed=3).repartition(parts)
        found.append(sorted(map(tuple, sqlnoise.with_uniforms(df.repartition(parts), ["k"], given).collect())))
    assert found[0] == found[1] and len(found[0]) == 500
    assert all(0 < u < 1 and u != v for _, u, v in found[0]) and abs(np.mean([u for _, u, _ in found[0]]) - 0.5) < 0.06
    with pytest.raises(Exception, match="more rows than uniforms"):
        sqlnoise.with_uniforms(df, ["k"], sqlnoise.uniforms(spark, 400, ["u"])).collect()
