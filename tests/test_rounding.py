"""Crossing roundings and moves under kept bounds, against enumeration."""

import itertools
import math

import numpy as np

from tessera.operators import rounding


def near(n, x):
    return math.floor(x + 1e-9) <= n <= math.ceil(x - 1e-9)


def test_crossing_sums_are_rounded_for_any_partitioning(spark):
    rng = np.random.default_rng(7)
    rows = [(p, a, b, k, float(rng.integers(0, 90)) / (7 if p % 3 else 1)) for p in range(25) for a in range(int(rng.integers(1, 7))) for b in range(5) for k in range(2) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "p int, a int, b int, k int, x double")
    found = []
    for parts in (1, 5):
        got = rounding.round_crossing(df.repartition(parts), ["p"], ["a"], ["b"], ["a", "b", "k"]).collect()
        found.append(sorted(map(tuple, got)))
        sums = {}
        for r in got:
            assert near(r.n, r.x)
            for key in (("a", r.p, r.a), ("b", r.p, r.b), ("p", r.p)):
                n, x = sums.get(key, (0, 0.0))
                sums[key] = n + r.n, x + r.x
        assert all(near(n, x) for n, x in sums.values())
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_rounding_costs_no_more_than_the_fractions():
    rng = np.random.default_rng(1)
    for _ in range(200):
        rows, cols = np.repeat(np.arange(4), 3), np.tile(np.arange(3), 4)
        parts = rng.integers(0, rounding.UNIT, 12)
        got = rounding.settle(rows, cols, parts)
        for by in (rows, cols):
            assert all(near(n, x) for n, x in zip(np.bincount(by, got), np.bincount(by, parts / rounding.UNIT)))
    assert (rounding.settle(rows, cols, np.zeros(12, np.int64)) == 0).all()


def brute(first, lower, upper):
    """Least squared change over all tables with the same column sums whose row sums are within bounds."""
    best = None
    columns = [[c for c in itertools.product(range(s + 1), repeat=len(first)) if sum(c) == s] for s in first.sum(axis=0)]
    for choice in itertools.product(*columns):
        n = np.array(choice).T
        if ((n.sum(axis=1) >= lower) & (n.sum(axis=1) <= upper)).all():
            cost = ((n - first) ** 2).sum()
            best = cost if best is None else min(best, cost)
    return best


def test_moves_are_the_cheapest_and_keep_bounds():
    rng = np.random.default_rng(3)
    solved = 0
    for _ in range(150):
        first = rng.integers(0, 4, (3, 2))
        lower, upper = rng.integers(0, 4, 3).astype(float), np.full(3, np.inf)
        if rng.random() < 0.4:
            upper = lower + rng.integers(0, 4, 3)
        sums = first.sum(axis=1)
        held = (sums >= lower) & (sums <= upper)
        n, met = rounding.cheapest_moves(first, lower, upper)
        best = brute(first, lower, upper)
        after = n.sum(axis=1)
        assert (n >= 0).all() and (n.sum(axis=0) == first.sum(axis=0)).all()
        assert ((after >= lower) & (after <= upper))[held].all()
        assert met == (best is not None)
        if met:
            assert ((n - first) ** 2).sum() >= best
            # one kind of fault: the paths add up to the least cost
            if not ((sums < lower).any() and (sums > upper).any()):
                solved += 1
                assert ((n - first) ** 2).sum() == best
    assert solved > 40


def test_swap_within_on_tables(spark):
    cells = spark.createDataFrame([("u", 0, 0, 1), ("u", 1, 0, 4), ("u", 1, 1, 2), ("v", 1, 0, 1), ("w", 0, 3, 2)], "g string, a int, r int, n long")
    bounds = spark.createDataFrame([("u", 0, 3, None), ("u", 2, 1, 1), ("u", 1, 3, None), ("v", 0, 1, None), ("v", 1, 1, None), ("x", 0, 1, None)], "g string, a int, lower int, upper int")
    got = {}
    for r in rounding.swap_within(cells, ["g"], "a", ["r"], bounds).collect():
        got.setdefault(r.g, {})[r.a, r.r] = (r.n, r.met)
    sums = lambda g, a: sum(n for (x, _), (n, _) in got[g].items() if x == a)
    assert (sums("u", 0), sums("u", 1), sums("u", 2)) == (3, 3, 1) and all(m for _, m in got["u"].values())
    # v cannot have one of each with a single record, and keeps what held
    assert got["v"] == {(1, 0): (1, False)} and got["w"] == {(0, 3): (2, True)} and "x" not in got
    assert rounding.swap_within(cells.limit(0), ["g"], "a", ["r"], bounds.limit(0)).count() == 0


def test_swap_within_takes_many_units_in_one_call(spark, monkeypatch, tmp_path):
    """Units of several sizes, of one level, without bounds and without cells, dealt over partitions at random: each as by itself, in few calls."""
    rng = np.random.default_rng(6)
    rows = [(f"u{k % 2000}", k // 2000 % (1 + k % 4), f"r{k % 5}" if k % 7 else None, int(rng.integers(0, 6))) for k in range(16000)]
    cells = spark.createDataFrame(rows, "g string, a int, r string, n long").groupBy("g", "a", "r").sum("n").withColumnRenamed("sum(n)", "n").repartition(7)
    bounds = spark.createDataFrame([(f"u{k}", a, 1.0 + k % 3, 40.0) for k in range(3, 2010) for a in range(3)], "g string, a int, lower double, upper double").repartition(5)
    path, plain = str(tmp_path / "calls"), rounding.cheapest_moves

    def counted(*given):
        with open(path, "a") as f:
            f.write("x")
        return plain(*given)

    monkeypatch.setattr(rounding, "cheapest_moves", counted)
    frame = rounding.swap_within(cells, ["g"], "a", ["r"], bounds).toPandas()
    monkeypatch.undo()
    with open(path) as f:
        assert len(f.read()) < 200
    was, b = cells.toPandas().fillna({"r": ""}), bounds.toPandas()
    frame = frame.fillna({"r": ""})
    assert set(frame["g"]) == set(was["g"])
    assert (frame.groupby(["g", "r"])["n"].sum() == was.groupby(["g", "r"])["n"].sum()).all()
    for g in [f"u{k}" for k in range(0, 2000, 41)]:
        mine, first = frame[frame["g"] == g], was[was["g"] == g]
        # null comes last
        levels, rest = sorted({*first["a"], *b[b["g"] == g]["a"]}), sorted(set(first["r"]), key=lambda r: (r == "", r))
        counts, limits = np.zeros((len(levels), len(rest)), np.int64), b[b["g"] == g].set_index("a")
        for a, r, n in first[["a", "r", "n"]].itertuples(index=False):
            counts[levels.index(a), rest.index(r)] = n
        lower, upper = (np.array([limits[c].get(a, none) for a in levels]) for c, none in (("lower", 0.0), ("upper", np.inf)))
        one, met = plain(counts, lower, upper)
        got = {(a, r): n for a, r, n in mine[["a", "r", "n"]].itertuples(index=False)}
        assert all(got.get((a, r), 0) == one[i, j] for i, a in enumerate(levels) for j, r in enumerate(rest)) and set(mine["met"]) == {met}
        assert not met or ((one.sum(axis=1) >= lower) & (one.sum(axis=1) <= upper)).all()
