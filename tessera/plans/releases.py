"""Registered queries: measurements for publication, by strategies that are products of matrices, and of SQL tables under one budget."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import measure, noise, sqlnoise
from tessera.plans.base import DIMS, SCHEMA, frame, register, table, units
from tessera.plans.privacy import uniform_sql

QUERIES = ["total", "flag * status", "any_band"]
SHARES = [("person", level, q, Fraction(w, 64)) for level in (1, 3, 5) for q, w in (("total", 2), ("flag * status", 8), ("any_band", 4))]
CELLS = {"total": 1, "flag * status": 6, "any_band": 2}


def levels_of_units(spark, sf):
    """Every unit of the hierarchy as (level, geocode), from the list of units and not from the counts."""
    at = F.explode(F.array(*map(F.lit, (1, 3, 5)))).alias("level")
    return units(spark, sf).select("geocode", at).select("level", F.expr("substr(geocode, 1, level)").alias("geocode")).distinct()


PUBLIC = "SELECT level, substr(geocode,1,level) AS geocode FROM units, (SELECT unnest([1,3,5]) AS level) GROUP BY ALL"


@register("measure_release", f", g AS ({PUBLIC}), q AS (SELECT * FROM (VALUES ('total',1,2.0/64,1.0),('flag * status',6,8.0/64,1.0),('any_band',2,4.0/64,2.0)) v(query,k,share,most)) SELECT level, query, count(*)*max(k) AS n, round(max(share)*8,9) AS budget, true AS centred, true AS spread FROM g, q GROUP BY ALL")
def measure_release(spark, sf):
    """Exact draws for all units, queries and cells at a pure budget of 8, zeros included: how many there are of each, and whether their errors have the stated mean and variance.

    Errors are within 6 standard deviations of what the draws' number allows; only this test looks at the truth.
    """
    f = frame(spark, sf)
    out = measure.release({"person": (f, SCHEMA, QUERIES, "orig")}, SHARES, Fraction(8), ["level", "geocode"], levels_of_units(spark, sf))
    if {"_true", "orig", "priv"} & set(out.columns):
        raise ValueError("true columns remain")
    return error_test(out, f)


def error_test(out, f):
    from tessera.operators import query

    truth = query.answer_many(f, SCHEMA, QUERIES, ["level", "geocode"], ["orig"], "cell")
    e = out.join(truth, ["level", "geocode", "query", "cell"], "left").withColumn("e", F.col("answer") - F.coalesce("orig", F.lit(0)))
    s = e.groupBy("level", "query").agg(F.count("*").alias("n"), F.max("budget").alias("budget"), F.max("variance").alias("v"), F.sum("e").alias("s"), F.sum(F.col("e") * F.col("e")).alias("ss"))
    # fourth moments of these laws are at most 10 squared variances
    return s.select("level", "query", "n", F.round("budget", 9).alias("budget"), (F.abs("s") <= 6 * F.sqrt(F.col("n") * F.col("v")) + 1).alias("centred"), (F.abs(F.col("ss") - F.col("n") * F.col("v")) <= 6 * F.sqrt(9 * F.col("n")) * F.col("v") + 1).alias("spread"))


@register("measure_release_zcdp", f", g AS ({PUBLIC}), q AS (SELECT * FROM (VALUES ('total',1,2.0/64),('flag * status',6,8.0/64)) v(query,k,share)) SELECT level, query, count(*)*max(k) AS n, round(max(share)*4,9) AS budget, true AS centred, true AS spread FROM g, q GROUP BY ALL")
def measure_release_zcdp(spark, sf):
    """The same under a zCDP budget of 4 with discrete Gaussian draws, for the queries in which a record counts once."""
    f = frame(spark, sf)
    out = measure.release({"person": (f, SCHEMA, QUERIES, "orig")}, [s for s in SHARES if s[2] != "any_band"], Fraction(4), ["level", "geocode"], levels_of_units(spark, sf), gaussian=True)
    return error_test(out, f)


#: A weighted strategy: each flag and twice their sum, both statuses, running sums of bands.
STRATEGY = {"flag": [[1, 0, 0], [0, 1, 0], [0, 0, 1], [2, 2, 2]], "status": [[1, 0], [0, 1]], "band": [[1, 0, 0, 0, 0], [1, 1, 0, 0, 0], [1, 1, 1, 0, 0], [1, 1, 1, 1, 0], [1, 1, 1, 1, 1]]}
RATIO = 3 / 15


def values_sql(matrix) -> str:
    return ", ".join(f"({r},{k},CAST({float(w)!r} AS DOUBLE))" for r, row in enumerate(matrix) for k, w in enumerate(row) if abs(w) > 1e-14)


SIDE = lambda seed: f"floor(ln({uniform_sql(seed, 'geocode', 'flag_row', 'status_row', 'band_row')})/ln(exp(-{RATIO!r})))"
ANSWERS = f""", fw AS (SELECT * FROM (VALUES {values_sql(STRATEGY['flag'])}) x(r,k,w)), sw AS (SELECT * FROM (VALUES {values_sql(STRATEGY['status'])}) x(r,k,w)), bw AS (SELECT * FROM (VALUES {values_sql(STRATEGY['band'])}) x(r,k,w)),
 t AS (SELECT geocode, fw.r AS flag_row, sw.r AS status_row, bw.r AS band_row, sum(orig*fw.w*sw.w*bw.w) AS t FROM frame JOIN fw ON flag=fw.k JOIN sw ON status=sw.k JOIN bw ON band=bw.k WHERE level=3 GROUP BY ALL),
 full_rows AS (SELECT * FROM (SELECT DISTINCT geocode FROM t), (SELECT unnest([0,1,2,3]) AS flag_row), (SELECT unnest([0,1]) AS status_row), (SELECT unnest([0,1,2,3,4]) AS band_row)),
 a AS (SELECT geocode, flag_row, status_row, band_row, coalesce(t,0)+CAST({SIDE(60)}-{SIDE(61)} AS BIGINT) AS answer FROM full_rows LEFT JOIN t USING (geocode, flag_row, status_row, band_row)) """


def strategy(spark, sf, budget):
    return measure.strategy_answers(frame(spark, sf).filter("level = 3"), ["geocode"], STRATEGY, "orig", budget, seed=60)


@register("measure_strategy_noisy", ANSWERS + "SELECT geocode, flag_row, status_row, band_row, CAST(answer AS DOUBLE) AS answer FROM a")
def measure_strategy_noisy(spark, sf):
    """A product of weighted matrices answered with noise at a budget of 3 over its sensitivity of 15."""
    return strategy(spark, sf, Fraction(3)).drop("variance")


INVERSE = {d: np.linalg.pinv(np.array(m, float)).T for d, m in STRATEGY.items()}


@register("measure_strategy_cells", ANSWERS + f", fi AS (SELECT * FROM (VALUES {values_sql(INVERSE['flag'])}) x(r,k,w)), si AS (SELECT * FROM (VALUES {values_sql(INVERSE['status'])}) x(r,k,w)), bi AS (SELECT * FROM (VALUES {values_sql(INVERSE['band'])}) x(r,k,w)) SELECT geocode, fi.k AS flag, si.k AS status, bi.k AS band, round(sum(answer*fi.w*si.w*bi.w),6) AS x, round(sum(power(fi.w*si.w*bi.w,2))*2*exp(-{RATIO!r})/power(1-exp(-{RATIO!r}),2),6) AS variance FROM a JOIN fi ON flag_row=fi.r JOIN si ON status_row=si.r JOIN bi ON band_row=bi.r GROUP BY ALL")
def measure_strategy_cells(spark, sf):
    """Cells and their variances from the noisy answers, one dim after the other."""
    x = measure.reconstruct(strategy(spark, sf, Fraction(3)), ["geocode"], STRATEGY)
    return x.select("geocode", *DIMS, F.round("x", 6).alias("x"), F.round("variance", 6).alias("variance"))


@register("measure_strategy_round_trip", ", g AS (SELECT * FROM (SELECT DISTINCT geocode FROM frame WHERE level=3), (SELECT unnest([0,1,2]) AS flag), (SELECT unnest([0,1]) AS status), (SELECT unnest([0,1,2,3,4]) AS band)) SELECT geocode, flag, status, band, CAST(coalesce(orig,0) AS DOUBLE) AS x FROM g LEFT JOIN (SELECT * FROM frame WHERE level=3) f USING (geocode, flag, status, band)")
def measure_strategy_round_trip(spark, sf):
    """Without noise the cells come back."""
    x = measure.reconstruct(strategy(spark, sf, None), ["geocode"], STRATEGY)
    return x.select("geocode", *DIMS, (F.round("x", 6) + 0.0).alias("x"))


def laplace_sql(value: str, u: str, scale: float) -> str:
    return f"round({value}-{scale!r}*sign({u}-0.5)*ln(1-2*abs({u}-0.5)),4)"


KIND = [uniform_sql(70 + k, "event_type") for k in range(3)]
STATUS = uniform_sql(73, "o_orderstatus")


@register("sqlnoise_composed", f"SELECT event_type AS key, 0.75::DOUBLE AS epsilon, {laplace_sql('sum(value)', KIND[0], 20.0)} AS a, {laplace_sql('count(*)', KIND[1], 2.0)} AS b, {laplace_sql('count(DISTINCT user_id)', KIND[2], 4.0)} AS c FROM events GROUP BY 1 UNION ALL SELECT o_orderstatus, 0.25, {laplace_sql('count(*)', STATUS, 4.0)}, NULL, NULL FROM orders GROUP BY 1", base=False)
def sqlnoise_composed(spark, sf):
    """Two tables under a whole of 1: two measures that share the greater of their budgets, one beside them, and one in the other table."""
    kinds = table(spark, sf, "events").groupBy(F.col("event_type")).agg(F.sum("value").alias("a"), F.count("*").alias("b"), F.countDistinct("user_id").alias("c"))
    states = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("a"))
    lap = sqlnoise.laplace_measure
    plan = {"kinds": [[lap("a", 0.5, 10.0), lap("b", 0.25)], [lap("c", 0.25)]], "states": [[lap("a", 0.25)]]}
    out = sqlnoise.apply({"kinds": kinds, "states": states}, plan, 1.0, {"kinds": ["event_type"], "states": ["o_orderstatus"]}, seed=70)
    k, s = out["kinds"].withColumnRenamed("event_type", "key"), out["states"].withColumnRenamed("o_orderstatus", "key")
    return k.unionByName(s, allowMissingColumns=True).select("key", "epsilon", *[F.round(c, 4).alias(c) for c in "abc"])


@register("sqlnoise_by_number", f"SELECT o_orderkey AS id, round(x-2.0*sign(u-0.5)*ln(1-2*abs(u-0.5)),6) AS x, round(v,9) AS v FROM (SELECT o_orderkey, o_totalprice AS x, {uniform_sql(80, 'n', '0')} AS u, {uniform_sql(80, 'n', '1')} AS v FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey)-1 AS n FROM orders))", base=False)
def sqlnoise_by_number(spark, sf):
    """Two uniforms for each order from a counter-based table, joined by the order's number."""
    o = table(spark, sf, "orders")
    given = sqlnoise.uniforms(spark, o.count(), ["u", "v"], seed=80)
    j = sqlnoise.with_uniforms(o.select("o_orderkey", "o_totalprice"), ["o_orderkey"], given)
    return j.select(F.col("o_orderkey").alias("id"), F.round(F.col("o_totalprice") + noise.laplace(F.col("u"), 2.0), 6).alias("x"), F.round("v", 9).alias("v"))
