"""Multi-index hashing: probing against all codes, and the query against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import entry, neighbours
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, key string, ids int"


def near(q, x):
    return math.fsum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(q, x))


def brute(rows, asks, k):
    """{query_id: [(vec_id, score)]} over rows (id, vector)."""
    out = {}
    for i, q in rows:
        if asks(i):
            out[i] = sorted({(o, near(q, x)) for o, x in rows if o != i}, key=lambda p: (-p[1], p[0]))[:k]
    return out


def check(got, want, k, least=0.9):
    """Ranks and scores are right for what was found, and enough was found."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i, w in want.items() if w}
    hits = total = 0
    for i, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(want[i]) + 1))
        order = [(-r.score, r.vec_id) for r in found]
        assert order == sorted(order) and len({r.vec_id for r in found}) == len(found)
        hits += len({r.vec_id for r in found} & {o for o, _ in want[i]})
        total += len(want[i])
    assert hits >= least * total
    return hits / total


def test_probing_finds_all_codes_within_the_radius():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 24))
    codes = neighbours.learn(x, float(np.linalg.norm(x, axis=1).max()), 10)
    block, queries = neighbours.Block(codes, x), codes.of_queries(x[:25])
    for radius in (0, 3, 7, 8, 20, 41, 56, 64, 100, 128):
        for q in queries:
            apart = np.unpackbits((block.rows ^ q).view(np.uint8), axis=1).sum(axis=1)
            assert (block.probe(q, radius) == np.flatnonzero(apart <= radius)).all()


def test_rotations_are_orthogonal_and_bring_signs_nearer():
    x = np.random.default_rng(2).normal(size=(500, 12)) * np.linspace(1, 3, 12)
    turn = neighbours.rotation(x - x.mean(axis=0), 0)
    assert np.allclose(turn.T @ turn, np.eye(12))
    loss = lambda t: ((np.sign(x @ t) - x @ t) ** 2).sum()
    assert loss(turn) < loss(np.linalg.qr(np.random.default_rng(0).normal(size=(12, 12)))[0])


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert check(entry.op13_neighbours(spark, SF).collect(), brute(rows, lambda i: i % 20 == 0, 20), 20) >= 0.95


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_odd_rows_blocks_and_lots(spark, spread):
    """Copies in a third of the rows, norms that differ, vectors that take no part, clashing columns, several blocks and lots."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16)) * np.exp(spread * rng.normal(size=(600, 1)))
    good = [(i, [float(np.float32(v)) for v in x[i if i % 3 else 0]]) for i in range(600)]
    nan, inf = float("nan"), float("inf")
    bad = [(1000, None), (1001, [0.0] * 16), (1002, [nan] * 16), (1003, [1.0] * 15 + [None]), (1004, [inf] * 16), (1005, [1.0, 2.0]), (1006, []), (None, [1.0] * 16)]
    table = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in [*good, *bad, good[7], good[20]]], SCHEMA).repartition(5)
    got = neighbours.nearest_neighbours(table, F.col("vec_id") % 10 == 0, k=12, block_rows=90, query_rows=15).collect()
    check(got, brute(good, lambda i: i % 10 == 0, 12), 12)
    score = {(r.query_id, r.vec_id): r.score for r in got}
    vector = dict(good)
    assert all(abs(s - near(vector[a], vector[b])) <= 1e-12 * max(1, abs(s)) for (a, b), s in score.items())
    # equal vectors: in order of the id, as many as are asked for
    copies = sorted((r["rank"], r.vec_id) for r in got if r.query_id == 30 and r.vec_id % 3 == 0)
    assert copies[0][1] == 0 or vector[copies[0][1]] != vector[0]


def test_few_rows_and_none(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    got = neighbours.nearest_neighbours(table, F.lit(True), k=20).collect()
    want = brute(rows, lambda i: True, 20)
    assert {i: [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == i] for i in want} == want
    assert neighbours.nearest_neighbours(table.limit(1), F.lit(True)).count() == 0
    assert neighbours.nearest_neighbours(table.limit(0), F.lit(True)).count() == 0
    doubles = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    assert neighbours.nearest_neighbours(doubles, F.col("vec_id") == 0, k=1).first().vec_id == 4
