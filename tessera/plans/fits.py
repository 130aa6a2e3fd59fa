"""Registered queries: fits in passes and within bounds on query rows, crossing roundings, moves under kept bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import fit, passes, rounding
from tessera.plans.base import DIMS, frame, register
from tessera.plans.privacy import FAMILY, PROJ, children
from tessera.plans.tabulation import D

LIFT = 1000  # far from zero, so that the fit has a closed form
LIFTED = f""", m AS (SELECT geocode, {D}, CAST(priv+{LIFT} AS DOUBLE) AS y, CAST(1+band AS DOUBLE) AS v, orig+{LIFT} AS o FROM frame WHERE level=3),
 g AS (SELECT geocode, sum(y) AS y, sum(v) AS v, CAST(sum(o)+(max(length(geocode))*5+7)%9-4 AS DOUBLE) AS q FROM m GROUP BY 1),
 f AS (SELECT geocode, flag, sum(y) AS y, sum(v) AS v, CAST(sum(o)+(max(length(geocode))*5+max(flag)*7)%9-4 AS DOUBLE) AS q FROM m GROUP BY ALL),
 p1 AS (SELECT geocode, y+v*(q-y)/(v+0.25) AS t FROM g),
 w AS (SELECT geocode, flag, y, v, (y*0.5+q*v)/(v+0.5) AS mid, v*0.5/(v+0.5) AS wide FROM f),
 p2 AS (SELECT w.geocode, (greatest(least(sum(mid), max(t)+1), max(t)-1)-sum(mid))/sum(wide) AS push FROM w JOIN p1 ON w.geocode=p1.geocode GROUP BY 1) """


@register("fit_multi_pass", LIFTED + "SELECT m.geocode, m.flag, m.status, m.band, round(m.y+m.v*(p1.t-g.y)/g.v,4) AS x_1, round(m.y+m.v*(w.mid+push*w.wide-w.y)/w.v,4) AS x_2 FROM m JOIN g ON m.geocode=g.geocode JOIN p1 ON m.geocode=p1.geocode JOIN p2 ON m.geocode=p2.geocode JOIN w ON m.geocode=w.geocode AND m.flag=w.flag")
def fit_multi_pass(spark, sf):
    """Noisy cells and a noisy total, then a noisy marginal, with the fitted total kept within 1."""
    f = frame(spark, sf).filter("level = 3")
    cells = f.select("geocode", *DIMS, (F.col("priv") + LIFT).cast("double").alias("y"), (1.0 + F.col("band")).alias("v"))
    shift = lambda k: (F.length("geocode") * 5 + k * 7) % 9 - 4
    sums = lambda by: f.groupBy("geocode", *by).agg(F.sum(F.col("orig") + LIFT).alias("s"))
    total = sums([]).select("geocode", (F.col("s") + shift(F.lit(1))).alias("q"), F.lit(0.25).alias("qv"))
    flag = sums(["flag"]).select("geocode", "flag", (F.col("s") + shift(F.col("flag"))).alias("q"), F.lit(0.5).alias("qv"))
    x = passes.fit_passes(cells, ["geocode"], [passes.Query("total", [], total, 1), passes.Query("flag", ["flag"], flag, 2)], {}, 1.0)
    return x.select("geocode", *DIMS, F.round("x_1", 4).alias("x_1"), F.round("x_2", 4).alias("x_2"))


KEPT = f""", c AS (SELECT substr(geocode,1,1) AS parent, geocode, {D} FROM frame WHERE level=3),
 n AS (SELECT count(*) AS cells, count(DISTINCT (parent,{D})) AS sums, count(DISTINCT geocode) AS total, count(DISTINCT (geocode,flag)) AS flag FROM c) """


@register("fit_multi_pass_kept", KEPT + "SELECT 'cells below zero' AS what, 0 AS pass, cells AS n_rows, 0 AS n_far FROM n UNION ALL SELECT 'sums', 0, sums, 0 FROM n UNION ALL SELECT 'total', 2, total, 0 FROM n UNION ALL SELECT 'total', 3, total, 0 FROM n UNION ALL SELECT 'flag', 3, flag, 0 FROM n")
def fit_multi_pass_kept(spark, sf):
    """Children of a region in three passes under their parents' counts: of each thing that has to hold, how many rows there are and how many are off."""
    f = frame(spark, sf).filter("level = 3").withColumn("parent", F.substring("geocode", 1, 1))
    total = f.groupBy("parent", *DIMS).agg(F.sum("orig").cast("double").alias("total"))
    cells = f.select("parent", "geocode", *DIMS, F.col("priv").cast("double").alias("y"), (1.0 + F.col("band")).alias("v")).join(total, ["parent", *DIMS])
    asked = lambda by: f.groupBy("parent", *by).agg((F.sum("priv") + F.length(F.max("geocode")) - 5).alias("q")).withColumn("qv", F.lit(0.5))
    queries = [passes.Query(name, by, asked(by), turn) for turn, (name, by) in enumerate((("total", ["geocode"]), ("flag", ["geocode", "flag"]), ("band", ["geocode", "band"])), 1)]
    x = passes.fit_passes(cells, ["parent"], queries, {"total": DIMS}, 0.5)
    below = x.agg(F.count("*").alias("n_rows"), F.count_if(F.expr("least(x_1, x_2, x_3) < 0")).alias("n_far")).select(F.lit("cells below zero").alias("what"), F.lit(0).alias("pass"), "n_rows", "n_far")
    off = " or ".join(f"abs(s{t} - total) > 1e-6" for t in (1, 2, 3))
    sums = x.groupBy("parent", *DIMS).agg(F.first("total").alias("total"), *[F.sum(f"x_{t}").alias(f"s{t}") for t in (1, 2, 3)]).agg(F.count("*").alias("n_rows"), F.count_if(F.expr(off)).alias("n_far"))
    sums = sums.select(F.lit("sums").alias("what"), F.lit(0).alias("pass"), "n_rows", "n_far")
    return below.unionByName(sums).unionByName(passes.kept_rows(x, ["parent"], queries, 0.5).withColumnRenamed("query", "what"))


#: Bounds by flag: a share of the unit's count, from a part that the noisy cells would miss, and in some units more than there is.
LIMITS = """, f AS (SELECT geocode, flag, count(*) AS k FROM frame WHERE level=5 GROUP BY ALL), s AS (SELECT geocode, sum(orig) AS total FROM frame WHERE level=5 GROUP BY 1),
 b AS (SELECT f.geocode, flag, total, CAST(floor(total*(1+flag)*0.1) AS DOUBLE) AS lower, CAST(floor(total*0.5)+flag AS DOUBLE) AS upper FROM f JOIN s ON f.geocode=s.geocode),
 r AS (SELECT geocode, max(total) AS total, sum(lower) AS least, sum(upper) AS most, min(CASE WHEN lower<=upper THEN 1 ELSE 0 END)=1 AND sum(lower)<=max(total) AND max(total)<=sum(upper) AS room FROM b GROUP BY 1) """


def limits(spark, sf):
    f = frame(spark, sf).filter("level = 5")
    total = f.groupBy("geocode").agg(F.sum("orig").alias("total"))
    own = f.select("geocode", "flag").distinct().join(total, "geocode")
    return f, total, own.select("geocode", "flag", F.floor(F.col("total") * (1 + F.col("flag")) * 0.1).cast("double").alias("lower"), (F.floor(F.col("total") * 0.5) + F.col("flag")).cast("double").alias("upper"))


@register("fit_bound_conflicts", LIMITS + "SELECT geocode, CAST(total AS BIGINT) AS total, least, most, room FROM r")
def fit_bound_conflicts(spark, sf):
    """Units whose bounds on query rows leave no table with their total."""
    _, total, b = limits(spark, sf)
    return passes.bound_conflicts(total, [(["flag"], b)], ["geocode"], "total")


@register("fit_query_bounds", LIMITS + "SELECT b.geocode, b.flag, lower, upper, true AS within, true AS met FROM b JOIN r ON b.geocode=r.geocode WHERE room")
def fit_query_bounds(spark, sf):
    """Cells fitted within bounds on their sums by flag and with the unit's total, where :func:`fit_bound_conflicts` finds room."""
    f, total, b = limits(spark, sf)
    room = passes.bound_conflicts(total, [(["flag"], b)], ["geocode"], "total").filter("room").select("geocode", F.col("total").cast("double").alias("total"))
    cells = f.select("geocode", *DIMS, F.col("priv").cast("double").alias("y"), (1.0 + F.col("band")).alias("v")).join(room, "geocode")
    x = passes.fit_bounds(cells, ["geocode"], [passes.Bound("flag", ["flag"], b)], {"total": []})
    sums = x.groupBy("geocode", "flag").agg(F.sum("x").alias("s"), F.min("met").alias("met"), F.min("x").alias("least"))
    within = (F.col("s") >= F.col("lower") - 1e-6) & (F.col("s") <= F.col("upper") + 1e-6) & (F.col("least") >= 0)
    return sums.join(b, ["geocode", "flag"]).select("geocode", "flag", "lower", "upper", within.alias("within"), "met")


CROSSED = PROJ + """, s AS (SELECT 'geocode' AS along, parent, geocode AS part, round(sum(x),6) AS x FROM x GROUP BY ALL UNION ALL SELECT 'flag', parent, CAST(flag AS VARCHAR), round(sum(x),6) FROM x GROUP BY ALL UNION ALL SELECT 'all', parent, '', round(sum(x),6) FROM x GROUP BY ALL) """


@register("fit_round_crossing", CROSSED + "SELECT along, parent, part, CAST(floor(x) AS BIGINT) AS low, CAST(ceil(x) AS BIGINT) AS high, true AS within FROM s")
def fit_round_crossing(spark, sf):
    """Fitted cells of a parent rounded so that the sums by child and by flag, which do not nest, are roundings as well: for each sum its floor, its ceiling, and whether the rounded sum is one of them."""
    x = fit.nonneg(children(spark, sf), FAMILY, "total", ["geocode"])
    n = rounding.round_crossing(x.select("parent", "geocode", *DIMS, "x"), ["parent"], ["geocode"], ["flag"], ["geocode", *DIMS])
    out = None
    for by, part in (("geocode", F.col("geocode")), ("flag", F.col("flag").cast("string")), ("all", F.lit(""))):
        s = n.groupBy("parent", part.alias("part")).agg(F.round(F.sum("x"), 6).alias("x"), F.sum("n").alias("n"), F.max(F.abs(F.col("n") - F.col("x"))).alias("far"))
        within = (F.abs(F.col("n") - F.col("x")) < 1 - 1e-9) & (F.col("far") < 1)
        one = s.select(F.lit(by).alias("along"), "parent", "part", F.floor("x").alias("low"), F.ceil("x").alias("high"), within.alias("within"))
        out = one if out is None else out.unionByName(one)
    return out


@register("fit_swap_within", ", s AS (SELECT geocode, CAST(sum(priv) AS BIGINT) AS total FROM frame WHERE level=10 GROUP BY 1) SELECT geocode, total, 7<=total AND total<=3*greatest(9, ceil(total*0.35)) AS met, 0::BIGINT AS n_broken FROM s WHERE total>0")
def fit_swap_within(spark, sf):
    """At least 4, 2 and 1 records of the flags and at most a share of all: whether a unit's bounds can be met, and how many of those that held are broken after."""
    f = frame(spark, sf).filter("level = 10")
    total = f.groupBy("geocode").agg(F.sum("priv").alias("total")).filter("total > 0")
    upper = F.greatest(F.lit(9.0), F.ceil(F.col("total") * 0.35))
    bounds = total.select("geocode", F.posexplode(F.array(F.lit(4), F.lit(2), F.lit(1))).alias("flag", "lower"), upper.alias("upper"))
    after = rounding.swap_within(f.select("geocode", *DIMS, "priv").join(total.select("geocode"), "geocode"), ["geocode"], "flag", ["status", "band"], bounds, "priv")
    was = f.groupBy("geocode", "flag").agg(F.sum("priv").alias("was"))
    now = after.groupBy("geocode", "flag").agg(F.sum("n").alias("now"), F.min("met").alias("met"))
    j = bounds.join(was, ["geocode", "flag"], "left").join(now, ["geocode", "flag"], "left").na.fill(0, ["was", "now"])
    held = lambda c: (F.col(c) >= F.col("lower")) & (F.col(c) <= F.col("upper"))
    found = j.groupBy("geocode").agg(F.min("met").alias("met"), F.count_if(held("was") & ~held("now")).alias("n_broken"))
    return total.join(found, "geocode").select("geocode", "total", "met", "n_broken")
