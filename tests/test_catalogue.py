"""Catalogues: what loaders refuse, and flags against a table with entries for any value."""

import itertools
import random

import pytest

from tessera.operators import catalogue, hist, query

DIMS, GROUPS = "dim string, place int, size int", "recode string, dim string, place int, label string, level int"


def test_schema_from_tables_and_what_is_refused(spark):
    dims = [("b", 1, 2), ("a", 0, 4)]
    groups = [("g", "a", 2, "low", 0), ("g", "a", 2, "low", 1), ("g", "a", 1, "odd", 1), ("g", "a", 1, "odd", 3)]
    load = lambda d, g: catalogue.load_schema(spark.createDataFrame(d, DIMS), spark.createDataFrame(g, GROUPS))
    assert load(dims, groups) == query.Schema({"a": 4, "b": 2}, {"g": ("a", {"odd": [1, 3], "low": [0, 1]})})
    for d, g in (
        ([*dims, ("a", 2, 3)], groups), ([*dims, ("c", 1, 3)], groups), ([("a", 0, 0)], []), (dims, [("g", "x", 0, "l", 0)]), (dims, [("g", "a", 0, "l", 4)]), (dims, [("b", "a", 0, "l", 0)]),
        (dims, [*groups, ("g", "b", 3, "l", 0)]), (dims, [*groups, ("g", "a", 2, "low", 0)]), (dims, [*groups, ("g", "a", 3, "low", 2)]), (dims, [("g", None, 0, "l", 0)]),
    ):
        with pytest.raises(ValueError):
            load(d, g)


def test_workloads_layouts_and_rules(spark):
    schema = query.Schema({"a": 4, "b": 2}, {"g": ("a", {"odd": [1, 3], "low": [0, 1]})})
    work = "workload string, place int, query string"
    assert catalogue.load_workloads(spark.createDataFrame([("w", 2, "total"), ("w", 1, "b * g")], work), schema) == {"w": ["g * b", "total"]}
    for bad in ([("w", 0, "c")], [("w", 0, "a * g")], [("w", 0, "g * b"), ("w", 1, "b * g")]):
        with pytest.raises(ValueError):
            catalogue.load_workloads(spark.createDataFrame(bad, work), schema)
    layout = "layout string, place int, field string, width int, type string, legal string"
    got = catalogue.load_layouts(spark.createDataFrame([("l", 2, "y", 3, "int", "0-9"), ("l", 1, "x", 2, "string", "a")], layout))
    assert got == {"l": ([("x", 1, 2, "string"), ("y", 3, 3, "int")], {"x": "a", "y": "0-9"})}
    with pytest.raises(ValueError):
        catalogue.load_layouts(spark.createDataFrame([("l", 1, "x", 0, "int", "0")], layout))
    rules = catalogue.load_zeros(spark.createDataFrame([("r", "g", "odd"), ("r", "b", "0")], "rule string, part string, label string"), schema)
    cells = hist.densify(spark.createDataFrame([("k", 0, 0, 1)], "k string, a int, b int, n int"), ["k"], ["a", "b"], [4, 2], "n")
    assert sorted((r.a, r.b) for r in cells.filter(rules["r"]).collect()) == [(1, 0), (3, 0)]
    with pytest.raises(ValueError):
        catalogue.load_zeros(spark.createDataFrame([("r", "g", "high")], "rule string, part string, label string"), schema)


def test_flags_take_the_most_specific_row(spark):
    random.seed(6)
    names = ["f", "g", "h", "i"]
    table = [(random.randint(0, 40), *[random.choice([None, 0, 1, 2]) for _ in names]) for _ in range(25)]
    rows = [(k, *c) for k, c in enumerate(itertools.product(range(3), repeat=4))] * 2
    types = "t int, " + ", ".join(f"{x} int" for x in names)
    got = catalogue.by_flags(spark.createDataFrame(rows, "k int, " + ", ".join(f"{x} int" for x in names)), names, spark.createDataFrame(table, types), "t").collect()
    assert len(got) == len(rows)
    for r in got:
        fits = [(sum(v is None for v in f), t) for t, *f in table if all(v is None or v == r[x] for v, x in zip(f, names))]
        assert r.t == (min(fits)[1] if fits else None)
    empty = catalogue.by_flags(spark.createDataFrame(rows[:2], "k int, " + ", ".join(f"{x} int" for x in names)), names, spark.createDataFrame([], types), "t")
    assert [r.t for r in empty.collect()] == [None, None]
