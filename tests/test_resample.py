"""Resampled histograms: cells of draws in small blocks, and records that are not dealt by stratum."""

import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import noise, resample

CELLS = [(s, f"{s}{g}", n) for s, counts in {"a": [1, 9, 0, 2, 17], "b": [40], "c": [3, 1, 1, 1, 5]}.items() for g, n in enumerate(counts)]


def test_draws_find_their_cells_in_any_block(spark):
    cells = spark.createDataFrame(CELLS, "s string, g string, n long")
    places = [(s, g) for s, g, n in CELLS for _ in range(n)]
    first, size = {}, Counter(s for s, _ in places)
    for i, (s, _) in enumerate(places):
        first.setdefault(s, i)
    u = [r.u for r in spark.range(len(places)).select("id", noise.uniform("id", seed=5).alias("u")).orderBy("id").collect()]
    want = Counter((s, *places[first[s] + int(u[i] * size[s])]) for i, (s, _) in enumerate(places))
    for block in (4, 4096):
        got = resample.bootstrap(cells, "s", ["g"], "n", seed=5, block=block)
        assert {(r.s, r.s, r.g): r.n for r in got.collect()} == want


def test_records_are_not_dealt_by_stratum(spark):
    cells = spark.range(40_000).select(F.floor(F.col("id") / 20_000).alias("s"), F.col("id").alias("g"), F.lit(5).alias("n"))
    plan = resample.bootstrap(cells, "s", ["g"], "n").select("g", "n")._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if re.search(r"hashpartitioning\(s#\d+L?, ", line) and "g#" not in line]
