"""Properties of operators that one stand-in table can't show."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import recode
from tessera.operators import checks, constraints, fit, hist, noise, order, query
from tessera.sources import files


def test_nonneg_projection_is_the_closest_point(spark):
    rng = np.random.default_rng(1)
    rows = []
    for p in range(40):
        n, total = int(rng.integers(1, 8)), int(rng.integers(0, 30))
        rows += [(p, i, float(rng.normal(3, 6)), float(rng.uniform(0.5, 3)), total) for i in range(n)]
    df = spark.createDataFrame(rows, "p int, i int, y double, v double, total int")
    got = fit.nonneg(df, ["p"], "total", ["i"]).toPandas()
    for p, g in got.groupby("p"):
        total, y, v = g.total.iloc[0], g.y.values, g.v.values
        if total == 0:
            assert (g.x == 0).all()
            continue
        lo, hi = -1e4, 1e4
        for _ in range(200):
            t = (lo + hi) / 2
            lo, hi = (t, hi) if np.maximum(0, y - t * v).sum() > total else (lo, t)
        assert np.allclose(g.x, np.maximum(0, y - lo * v), atol=1e-6)


def test_rounding_adds_up(spark):
    df = spark.createDataFrame([(1, i, x, 7) for i, x in enumerate([0.4, 1.6, 2.5, 2.5])] + [(2, 0, 5.0, 5)], "p int, i int, x double, total int")
    got = fit.round_controlled(df, ["p"], "total", ["i"]).groupBy("p").agg(F.sum("n").alias("n"), F.max("total").alias("t")).collect()
    assert all(r.n == r.t for r in got)


def test_empty_histograms(spark):
    empty = spark.createDataFrame([], "geocode string, a int, n long")
    assert hist.roll_up(empty, "geocode", ["a"], [0, 1], ["n"]).count() == 0
    assert hist.densify(empty, ["geocode"], ["a"], [3], "n").count() == 0
    assert query.answer_many(empty, query.Schema({"a": 3}), ["total", "a"], ["geocode"], ["n"]).count() == 0


def test_schema_names_and_errors():
    s = query.Schema({"a": 2, "b": 3}, {"g": ("b", {"x": [0, 1], "y": [1]})})
    assert s.names() == ["total", "detailed", "a", "b", "g", "a * b", "a * g"]
    assert s.sensitivity("a * g") == 2 and s.sensitivity("total") == 1
    with pytest.raises(ValueError):
        s.parse("b * g")
    with pytest.raises(ValueError):
        s.parse("c")


def test_unflatten_inverts(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("i")).select("i", *hist.unflatten("i", ["a", "b", "c"], [2, 3, 4]))
    assert df.filter(hist.flat_index(["a", "b", "c"], [2, 3, 4]) != F.col("i")).count() == 0


def test_uniform_does_not_depend_on_partitions(spark):
    df = spark.range(1000).select("id", noise.uniform("id", seed=3).alias("u"))
    again = spark.range(1000).repartition(7).select("id", noise.uniform("id", seed=3).alias("u"))
    assert df.exceptAll(again).count() == 0
    assert df.filter("u <= 0 or u >= 1").count() == 0


def test_smooth_laplace_condition(spark):
    df = spark.range(1).select(noise.smooth_laplace(F.lit(1.0), F.lit(0.6), F.lit(2.0), 5.0, 0.1, 0.01).alias("x"))
    assert df.first().x is None


def test_legal_values(spark):
    df = spark.createDataFrame([("1",), ("05",), ("9",), (None,), ("x",)], "a string")
    assert sorted(r.a for r in df.filter(checks.legal("a", "0-5,9")).collect()) == ["1", "9"]


def test_equal_frames_counts_duplicates(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "a int"), spark.createDataFrame([(1,), (2,), (2,)], "a int")
    assert tuple(checks.equal_frames(a, b).first()) == (1, 1)


def test_combination_index_unknown(spark):
    df = spark.createDataFrame([(0, 0), (1, 1)], "a int, b int")
    assert [r.i for r in df.select(recode.combination_index(["a", "b"]).alias("i")).collect()] == [None, 2]


def test_only_type_of_facility_gets_everyone(spark):
    u = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "g string, k string")
    t = spark.createDataFrame([("a", 5), ("b", 9)], "g string, t int")
    got = {(r.g, r.k): (r.lower, r.upper) for r in constraints.facility_bounds(u, t, "g", "k", "t").collect()}
    assert got == {("a", "x"): (5, 5), ("b", "x"): (1, 8), ("b", "y"): (1, 8)}


def test_secure_geometric_distribution(spark):
    got = noise.secure_geometric(spark.range(20000).select(F.lit(0).alias("z")), "z", 1, 1, "x").groupBy("x").count().toPandas().set_index("x")["count"]
    p = (1 - math.exp(-1)) / (1 + math.exp(-1))
    assert abs(got[0] / 20000 - p) < 0.02 and abs(got[1] / 20000 - p * math.exp(-1)) < 0.02


def test_discrete_gaussian_distribution():
    draws = np.array([noise.discrete_gaussian(7, 2) for _ in range(8000)])
    weight = {x: math.exp(-x * x / 7) for x in range(-30, 31)}
    for x in range(-4, 5):
        p = weight[x] / sum(weight.values())
        assert abs((draws == x).mean() - p) < 5 * math.sqrt(p * (1 - p) / len(draws))
    assert abs(draws.var() / noise.gaussian_moment(3.5) - 1) < 0.1


def test_secure_gaussian_keeps_nulls_and_is_not_deterministic(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x long")
    got = noise.secure_gaussian(df, "x", 1, 1000, "y").collect()
    assert [r.y for r in got] == [1, None, 3]


def test_bounded_fit_is_the_closest_within_bounds(spark):
    rng = np.random.default_rng(2)
    rows = []
    for p in range(60):
        n, total = int(rng.integers(1, 7)), int(rng.integers(-3, 30))
        for i in range(n):
            lo = float(rng.integers(-2, 4))
            rows.append((p, i, float(rng.normal(3, 6)), float(rng.uniform(0.5, 3)), total, lo, lo + float(rng.integers(0, 9))))
    df = spark.createDataFrame(rows, "p int, i int, y double, v double, total int, lo double, hi double")
    for _, g in fit.bounded(df, ["p"], "total", "lo", "hi", ["i"]).toPandas().groupby("p"):
        total, x = g.total.iloc[0], g.x.values
        assert (x >= g.lo - 1e-9).all() and (x <= g.hi + 1e-9).all()
        assert g.met.all() == (g.lo.sum() <= total <= g.hi.sum())
        if not g.met.all():
            assert np.allclose(x, g.lo if total < g.lo.sum() else g.hi, atol=1e-6)
            continue
        a, b = -1e4, 1e4
        for _ in range(200):
            t = (a + b) / 2
            a, b = (t, b) if np.clip(g.y - t * g.v, g.lo, g.hi).sum() > total else (a, t)
        assert np.allclose(x, np.clip(g.y - a * g.v, g.lo, g.hi), atol=1e-5) and abs(x.sum() - total) < 1e-6


def test_numbers_and_running_sums(spark):
    rng = np.random.default_rng(3)
    rows = [(None if k % 11 == 0 else f"k{int(rng.integers(0, 40)):02d}" if k % 3 else "hot", int(rng.integers(0, 5)), int(rng.integers(0, 2))) for k in range(900)]
    df = spark.createDataFrame(rows, "a string, b int, g int")
    for within in ([], ["g"]):
        got = order.running(df, ["a", "b"], F.col("b").cast("long"), "s", within, bins=9).collect()
        for key in {tuple(r[w] for w in within) for r in got}:
            mine = sorted((r for r in got if tuple(r[w] for w in within) == key), key=lambda r: (r.a is not None, r.a or "", r.b, r.s))
            total = 0
            for r in mine:
                assert r.s == total
                total += r.b
        numbers = order.numbered(df, ["a", "b"], "i", within)
        assert numbers.select("i", *within).distinct().count() == len(rows)
    assert order.numbered(df.limit(0), ["a"], "i").count() == 0


def test_counts_beyond_a_block_are_expanded(spark):
    df = spark.createDataFrame([("a", 2500), ("b", 0), ("c", 1)], "k string, n long")
    assert sorted((r.k, r.i) for r in files.expand(df, "n", "i").collect()) == [*(("a", i) for i in range(2500)), ("c", 0)]
    assert [r.epnum for r in files.numbered_records(df, "n", ["k"]).orderBy("epnum").collect()] == list(range(2501))


def test_reingest_refuses_nulls_and_other_counts(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, x int")
    saved = spark.createDataFrame([("a", 2), ("b", 1)], "g string, n long")
    assert files.read_as_raw(rows, ["g", "x"], ["g"], saved, "n").count() == 3
    with pytest.raises(ValueError):
        files.read_as_raw(rows, ["g"], ["g"], saved.filter("g = 'a'"), "n")
    with pytest.raises(ValueError):
        files.read_as_raw(rows.withColumn("x", F.when(F.col("x") > 1, F.col("x"))), ["x"], ["g"], saved, "n")


def test_swaps_move_the_least_changed_records(spark):
    # two donors: the one whose measured count is lower gives first
    rows = [(1, 1, 0, 5, 5), (1, 1, 1, 5, 1), (1, 0, 0, 0, 0), (2, 1, 0, 1, 1), (2, 0, 1, 9, 9)]
    df = spark.createDataFrame(rows, "u int, f int, c int, n long, y long")
    got = {(r.u, r.f, r.c): r.n for r in fit.swap_repair(df, ["u"], "f", 0, 1, ["c"], F.lit(2)).collect()}
    assert got == {(1, 1, 0): 5, (1, 1, 1): 3, (1, 0, 0): 0, (1, 0, 1): 2, (2, 1, 0): 1, (2, 0, 1): 9}


def test_required_columns_and_paired_reallocation_fail_on_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, c string")
    assert files.required(df.filter("k = 1"), ["k", "c"]).collect() == [(1, "a")]
    with pytest.raises(Exception, match="null in c"):
        files.required(df, ["k", "c"]).collect()
    units = spark.createDataFrame([("x", "own", i) for i in range(3)] + [("x", "rent", i) for i in range(2)] + [("y", "none", 0)], "g string, kind string, u int")
    pairs = {"own": ("mortgage", "clear"), "rent": ("paid", "free")}

    def split(*targets):
        return files.reallocate_pairs(units, ["g"], "kind", spark.createDataFrame(targets, "g string, kind string, k int, left int"), pairs, ["u"], "t").collect()

    got = {(r.kind, r.u): r.t for r in split(("x", "own", 1, 2), ("x", "rent", 2, None))}
    assert got == {("own", 0): "mortgage", ("own", 1): "clear", ("own", 2): "clear", ("rent", 0): "paid", ("rent", 1): "paid", ("none", 0): None}
    for bad in (("x", "own", 4, None), ("x", "own", 1, 1)):
        with pytest.raises(Exception, match="do not add up in x"):
            split(bad)


def test_household_flags_of_one_person_and_nulls(spark):
    df = spark.createDataFrame([(3, 1, 1, 1, 3), (0, 3, 0, 2, 1), (None, None, None, None, None)], "c int, p int, r int, s int, g int")
    f = recode.household_flags(*[F.col(x) for x in "cprsg"])
    one, two, none = df.select(*[c.alias(n) for n, c in f.items()]).collect()
    assert one.alone == 1 and one.family == one.married == one.child_both == 0 and one.no_partner == one.no_child == 1
    assert two.cohabiting == two.cohabiting_opposite == two.couple_without_child == 1 and two.others_only == two.family == 0
    assert all(v is None for v in none)


def test_known_children_keep_their_value(spark):
    """A variance of zero: the value stays, within its bounds, and the others share what is left."""
    rows = [("p", "a", 5.0, 0.0, 12), ("p", "b", 4.0, 1.0, 12), ("p", "c", 1.0, 1.0, 12), ("q", "d", 9.0, 0.0, 6), ("q", "e", 2.0, 1.0, 6), ("r", "f", 3.0, 0.0, 3), ("r", "g", 0.0, 0.0, 3)]
    c = spark.createDataFrame(rows, "parent string, cell string, y double, v double, total long")
    x = lambda df: {r["cell"]: round(r["x"], 9) for r in df.collect()}
    assert x(fit.nonneg(c, ["parent"], "total", ["cell"])) == {"a": 5.0, "b": 5.0, "c": 2.0, "d": 9.0, "e": 0.0, "f": 3.0, "g": 0.0}
    assert x(fit.weighted_ls(c, ["parent"], "total")) == {"a": 5.0, "b": 5.0, "c": 2.0, "d": 9.0, "e": -3.0, "f": 3.0, "g": 0.0}
    limits = c.withColumn("lower", F.lit(0)).withColumn("upper", F.when(F.col("cell") == "b", 4).otherwise(20))
    got = fit.bounded(limits, ["parent"], "total", "lower", "upper", ["cell"])
    assert x(got) == {"a": 5.0, "b": 4.0, "c": 3.0, "d": 9.0, "e": 0.0, "f": 3.0, "g": 0.0}
    assert {r["parent"]: r["met"] for r in got.collect()} == {"p": True, "q": False, "r": True}
    assert {r["cell"]: r["v"] for r in fit.rescale(c, ["parent"]).collect()} == {"a": 0.0, "b": 1.0, "c": 1.0, "d": 0.0, "e": 1.0, "f": 0.0, "g": 0.0}
    own = spark.createDataFrame([("k", 3.0, 0.0)], "cell string, y double, v double")
    assert [tuple(r) for r in fit.pool(own, own.withColumn("y", F.lit(7.0)), ["cell"]).collect()] == [("k", 3.0, 0.0)]


def test_count_below_evaluates_its_argument_once_a_row(spark):
    values = [0.0, 0.1, 0.1, 0.4, 0.5, 0.9, 1.0]
    asked = [-1.0, 0.0, 0.05, 0.1, 0.11, 0.5, 0.95, 1.0, 2.0, float("nan"), None]
    frame = spark.createDataFrame([(x,) for x in asked], "u double")
    got = frame.select("u", noise.count_below(values, F.col("u")).alias("n"), noise.count_below(values[:1], F.col("u")).alias("one")).collect()
    assert [r.n for r in got] == [0, 0, 1, 1, 3, 4, 6, 6, 7, 7, 0]
    assert [r.one for r in got] == [0, 0, 1, 1, 1, 1, 1, 1, 1, 1, 0]
    # the expression stands in the plan once, and in no function that is run for each value
    plan = frame.select(noise.count_below(values, noise.uniform("u")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.index("md5(") < plan.index("lambdafunction")


def test_gaussian_steps_hash_their_uniform_once_a_row(spark):
    frame = spark.range(200).select(noise.gaussian_steps(noise.uniform("id", seed=4), 9.0).alias("x"))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    assert 1.0 < np.var([r.x for r in frame.collect()]) < 25.0


def test_levels_looked_up_are_those_put_together(spark, monkeypatch):
    """The lookup of a small schema's levels against labels made in each row: overlaps, levels in no group, values outside their dim, nulls, a query asked twice."""
    s = query.Schema({"a": 2, "b": 3, "c": 4}, {"g": ("b", {"x": [0, 1], "y": [1]})})
    values = [0, 1, 2, 3, 5, -1, None]
    cells = spark.createDataFrame([(str(a), a, b, i + 1) for i, (a, b) in enumerate((a, b) for a in values for b in values)], "geocode string, a int, b int, n long")
    queries = ["total", "a", "g", "a * g", "b", "b", "a * b"]
    found = lambda frame: sorted(map(tuple, query.answer_many(frame, s, queries, ["geocode"], ["n"]).collect()), key=str)
    listed = found(cells)
    assert "from_json" in str(query.hits(cells, s, queries)) and "from_json" not in str(query.hits(cells.withColumn("b", F.col("b").cast("string")), s, queries))
    monkeypatch.setattr(query, "LISTED", 0)
    assert listed == found(cells)
    assert ("1", "b", "2", 2 * 10) in listed and ("0", "a * g", "0 BY x", 1 + 2) in listed
