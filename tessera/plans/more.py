"""Registered queries: further layouts, noise, fits and constraints."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import checks, constraints, fit, noise, query
from tessera.plans.base import DIMS, cells, frame, persons, register, table, units
from tessera.plans.privacy import CH, FAMILY, KEYS, MEAS, PROJ, ROW, children, fitted_levels, fitted_sql, measured, normal_sql, row_noise, uniform_sql
from tessera.plans.records import PERSON
from tessera.plans.relational import FAC, tract_bounds
from tessera.plans.tabulation import D
from tessera.sources import files


@register("io_empty_source", "SELECT geocode, flag, status, band, orig FROM cells WHERE geocode IS NOT NULL")
def io_empty_source(spark, sf):
    """A source without files is an empty table of the declared schema and joins the others without changing the result."""
    c = cells(spark, sf)
    return c.unionByName(files.read_delimited(spark, [], ", ".join(f"{n} {t}" for n, t in c.dtypes)))


CHOSEN = "CAST('0x'||substr(md5(concat_ws('|','50',unit)),1,13) AS BIGINT)+0.5<4503599627370496.0/3"


@register("io_sample_linked_tables", f"SELECT geocode, unit, 'unit' AS kind, NULL::BIGINT AS orderkey, NULL::INTEGER AS run FROM units WHERE {CHOSEN} AND unit IN (SELECT unit FROM persons) UNION ALL SELECT geocode, unit, 'person', orderkey, run FROM persons WHERE {CHOSEN} UNION ALL SELECT * FROM (SELECT geocode, unit, 'vacant', NULL::BIGINT, NULL::INTEGER FROM units WHERE unit NOT IN (SELECT unit FROM persons) ORDER BY unit LIMIT 5) UNION ALL SELECT * FROM (SELECT geocode, unit, 'facility', NULL::BIGINT, NULL::INTEGER FROM units WHERE unit_type='MACHINERY' ORDER BY unit LIMIT 7)")
def io_sample_linked_tables(spark, sf):
    """A sample of units with all their persons, and five vacant units and seven facilities appended: tables stay linked because the unit's key decides for both."""
    p, u = persons(spark, sf), units(spark, sf)
    both = files.linked_sample(u.select("geocode", "unit", "unit_type"), p.select("geocode", "unit", "orderkey", "run"), "unit", noise.uniform("unit", seed=50) < 1 / 3, 5, F.col("unit_type") == "MACHINERY", 7)
    return both.drop("unit_type")


@register("sink_pl94_person_layout", f"SELECT 'P' AS schema_type, substr(geocode,1,1) AS tabblkst, substr(geocode,2,2) AS tabblkcou, substr(geocode,4,2) AS tabtractce, substr(geocode,6,5) AS tabblk, row_number() OVER (ORDER BY geocode, {D})-1 AS epnum, lpad(CAST(flag AS VARCHAR),2,'0') AS gqtype, CAST(1+status AS VARCHAR) AS voting_age, lpad(CAST(band+1 AS VARCHAR),2,'0') AS cenrace FROM persons")
def sink_pl94_person_layout(spark, sf):
    r = files.numbered_records(cells(spark, sf), "orig", ["geocode", *DIMS])
    part = lambda a, n: F.substring("geocode", a, n)
    return r.select(
        F.lit("P").alias("schema_type"), part(1, 1).alias("tabblkst"), part(2, 2).alias("tabblkcou"), part(4, 2).alias("tabtractce"), part(6, 5).alias("tabblk"), "epnum",
        F.lpad(F.col("flag").cast("string"), 2, "0").alias("gqtype"), (1 + F.col("status")).cast("string").alias("voting_age"), F.lpad((F.col("band") + 1).cast("string"), 2, "0").alias("cenrace"),
    )


OCC = "SELECT geocode, CASE WHEN unit IN (SELECT o_custkey FROM orders WHERE o_orderstatus='P') THEN '1' ELSE '2' END AS hh_status FROM units"


@register("sink_occupancy_units", OCC)
def sink_occupancy_units(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("unit")).distinct().withColumn("o", F.lit(1))
    return units(spark, sf).join(o, "unit", "left").select("geocode", F.when(F.col("o") == 1, "1").otherwise("2").alias("hh_status"))


@register("sink_unit_residual_rows", "SELECT t.geocode, 'facility' AS kind, n-coalesce(h,0) AS n FROM (SELECT substr(geocode,1,5) AS geocode, count(*) AS n FROM units WHERE unit_type IN ('BUILDING','MACHINERY') GROUP BY 1) t LEFT JOIN (SELECT substr(geocode,1,5) AS geocode, count(DISTINCT unit) AS h FROM persons WHERE unit_type IN ('BUILDING','MACHINERY') AND flag=0 GROUP BY 1) p ON t.geocode=p.geocode WHERE n-coalesce(h,0)>0 UNION ALL SELECT t.geocode, 'vacant', n-coalesce(h,0) FROM (SELECT substr(geocode,1,5) AS geocode, count(*) AS n FROM units WHERE unit_type NOT IN ('BUILDING','MACHINERY') GROUP BY 1) t LEFT JOIN (SELECT substr(geocode,1,5) AS geocode, count(DISTINCT unit) AS h FROM persons WHERE unit_type NOT IN ('BUILDING','MACHINERY') AND flag=0 GROUP BY 1) p ON t.geocode=p.geocode WHERE n-coalesce(h,0)>0")
def sink_unit_residual_rows(spark, sf):
    """Rows for units that no record stands for: facilities without persons and vacant units, as many as are lacking by tract."""
    tract, is_facility = F.substring("geocode", 1, 5).alias("geocode"), F.col("unit_type").isin("BUILDING", "MACHINERY")
    p, u = persons(spark, sf).filter("flag = 0"), units(spark, sf)

    def lacking(kind, own):
        there = p.filter(own).select(tract, "unit").distinct()
        total = u.filter(own).groupBy(tract).agg(F.count("*").alias("t"))
        return files.expand(files.residual_units(there, total, ["geocode"], "t"), "n").withColumn("kind", F.lit(kind))

    rows = lacking("facility", is_facility).unionByName(lacking("vacant", ~is_facility))
    return rows.groupBy("geocode", "kind").agg(F.count("*").alias("n"))


@register("sink_ipums_persons", "SELECT substr(geocode,1,1) AS supdist, substr(geocode,2,4) AS enumdist, CASE WHEN prio=0 THEN 1 ELSE 2 END AS qsex, least(qty,40) AS qage, count(*) AS n FROM persons GROUP BY ALL")
def sink_ipums_persons(spark, sf):
    return persons(spark, sf).groupBy(F.substring("geocode", 1, 1).alias("supdist"), F.substring("geocode", 2, 4).alias("enumdist"), F.when(F.col("prio") == 0, 1).otherwise(2).alias("qsex"), F.least("qty", F.lit(40)).alias("qage")).agg(F.count("*").alias("n"))


@register("sink_multi", "SELECT geocode, flag, status, band FROM persons WHERE flag=0")
def sink_multi(spark, sf):
    """Two sinks from one frame; the delimited one and the Parquet one must agree."""
    p = persons(spark, sf).filter("flag = 0").select("geocode", *DIMS)
    a, b = files.scratch(spark, "text"), files.scratch(spark, "parquet")
    files.write_delimited(p, a)
    p.write.parquet(b)
    return files.read_delimited(spark, a, PERSON).intersectAll(spark.read.parquet(b))


@register("sink_header_metadata", "SELECT 'geocode|flag|status|band' AS header, count(*) AS n_rows, '0.50 to persons, 0.50 to units' AS allocation, true AS dated FROM persons")
def sink_header_metadata(spark, sf):
    """A file with its sidecar: header line, time, row count counted while writing, and the text of the allocation, read back."""
    path = files.scratch(spark, "with-header")
    files.write_with_metadata(persons(spark, sf).select("geocode", *DIMS), path, "0.50 to persons, 0.50 to units")
    m = files.read_metadata(spark, path)
    return m.select("header", F.col("n_rows").cast("long").alias("n_rows"), "allocation", F.to_timestamp("written").isNotNull().alias("dated"))


REACH = 36
STEPS = f"WITH w AS (SELECT x, exp(-x*x/18.0) AS p FROM (SELECT unnest(generate_series(-{REACH},{REACH})) AS x)), cum AS (SELECT x, sum(p) OVER (ORDER BY x)/sum(p) OVER () AS c FROM w) "


@register("noise_discrete_gaussian", STEPS + f"SELECT {ROW}, (SELECT count(*) FROM cum WHERE c<u)-{REACH} AS x FROM (SELECT *, {uniform_sql(4, *KEYS)} AS u FROM lineitem)", base=False)
def noise_discrete_gaussian(spark, sf):
    """For experiments, from keyed uniforms; releases take :func:`noise.secure_gaussian`."""
    return row_noise(spark, sf, noise.gaussian_steps(noise.uniform(*KEYS, seed=4), 9.0))


@register("noise_float_discrete_gaussian", f"SELECT {ROW}, {normal_sql('9.0-1.0/12', 6, *KEYS)} AS x FROM lineitem", base=False)
def noise_float_discrete_gaussian(spark, sf):
    return row_noise(spark, sf, noise.float_gaussian(noise.uniform(*KEYS, seed=6), noise.uniform(*KEYS, seed=7), 9.0))


GRID = "WITH g AS (SELECT i, tan(pi()*(i/2000.0-0.5)*0.999) AS z FROM (SELECT unnest(generate_series(0,2000)) AS i)), a AS (SELECT i, z, coalesce((z-lag(z) OVER (ORDER BY i))*(1/(1+power(lag(z) OVER (ORDER BY i),4))+1/(1+power(z,4)))/2,0) AS m FROM g), cum AS (SELECT i, z, sum(m) OVER (ORDER BY i)/sum(m) OVER () AS c FROM a), below AS (SELECT c, z, lead(c) OVER (ORDER BY c) AS up FROM cum)"


@register("sqlnoise_smooth_gamma", GRID + f" SELECT {ROW}, round(l_quantity+greatest(l_quantity*0.1,1.0)*z,6) AS x FROM (SELECT *, {uniform_sql(8, *KEYS)} AS u FROM lineitem) JOIN below ON u>c AND u<=up", base=False)
def sqlnoise_smooth_gamma(spark, sf):
    """Quantities with noise of the density 1 / (1 + z**4), scaled by a tenth of the value."""
    quantity = F.col("l_quantity").cast("double")
    return row_noise(spark, sf, F.round(noise.smooth_gamma(quantity, noise.uniform(*KEYS, seed=8), quantity, 0.1, 5.0), 6))


U9 = "(l_discount*9+0.05)"


@register("sqlnoise_seeded", f"SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, round(l_quantity-sign({U9}-0.5)*ln(1-2*abs({U9}-0.5)),6) AS x FROM lineitem", base=False)
def sqlnoise_seeded(spark, sf):
    """Uniforms joined by the rows' keys."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    li = table(spark, sf, "lineitem")
    u = li.groupBy(*keys).agg(F.first("l_discount").alias("u"))
    j = li.join(u, keys)
    return j.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.round(F.col("l_quantity") + noise.laplace(F.col("u") * 9 + 0.05, 1.0), 6).alias("x"))


def laplace_sql(scale, seed, key):
    u = uniform_sql(seed, key)
    return f"-{scale}*sign({u}-0.5)*ln(1-2*abs({u}-0.5))"


@register("sqlnoise_apply", f"SELECT event_type, 0.75::DOUBLE AS epsilon, round(sum(value){laplace_sql(2.0, 20, 'event_type')},4) AS total, round(count(*){laplace_sql(4.0, 21, 'event_type')},4) AS n FROM events GROUP BY 1", base=False)
def sqlnoise_apply(spark, sf):
    """Two measures of one table with their own budgets, which add up."""
    budgets = {"total": 0.5, "n": 0.25}
    t = table(spark, sf, "events").groupBy("event_type").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    noisy = [F.round(F.col(c) + noise.laplace(noise.uniform("event_type", seed=20 + i), 1 / e), 4).alias(c) for i, (c, e) in enumerate(budgets.items())]
    return t.select("event_type", F.lit(sum(budgets.values())).alias("epsilon"), *noisy)


@register("measure_strategy_matrix", "SELECT geocode, f.r AS flag_row, CAST(sum(priv*f.w) AS DOUBLE) AS answer FROM frame JOIN (VALUES (0,0,1.0),(0,1,1.0),(0,2,1.0),(1,0,1.0),(1,2,-1.0)) f(r,k,w) ON flag=f.k WHERE level=3 GROUP BY ALL")
def measure_strategy_matrix(spark, sf):
    return query.kron(frame(spark, sf).filter("level = 3"), ["geocode"], {"flag": [[1, 1, 1], [1, 0, -1]]}, "priv", "answer")


# noisy answers in place of truth: a fixed disturbance of each true one
NOISY = "CAST(s+(length(geocode)*5+{}*7)%9-4 AS DOUBLE)"
MULTI = f""", m AS (SELECT geocode, {D}, CAST(priv AS DOUBLE) AS y, CAST(1+band AS DOUBLE) AS v FROM frame WHERE level=3), q1 AS (SELECT geocode, flag, {NOISY.format('flag')} AS q FROM (SELECT geocode, flag, sum(orig) AS s FROM frame WHERE level=3 GROUP BY ALL)), q2 AS (SELECT geocode, {NOISY.format('1')} AS q FROM (SELECT geocode, sum(orig) AS s FROM frame WHERE level=3 GROUP BY ALL)),
 s1 AS (SELECT m.*, q-sum(y) OVER w AS gap, sum(v) OVER w+0.5 AS spread FROM m JOIN q1 ON m.geocode=q1.geocode AND m.flag=q1.flag WINDOW w AS (PARTITION BY m.geocode, m.flag)),
 f1 AS (SELECT geocode, {D}, CASE WHEN abs(gap)>1 THEN y+v*gap/spread ELSE y END AS y, CASE WHEN abs(gap)>1 THEN v-v*v/spread ELSE v END AS v FROM s1),
 s2 AS (SELECT f1.*, q-sum(y) OVER w AS gap, sum(v) OVER w+0.25 AS spread FROM f1 JOIN q2 ON f1.geocode=q2.geocode WINDOW w AS (PARTITION BY f1.geocode)) """


@register("fit_multi_query", MULTI + f"SELECT geocode, {D}, round(CASE WHEN abs(gap)>0.001 THEN y+v*gap/spread ELSE y END,6) AS y, round(CASE WHEN abs(gap)>0.001 THEN v-v*v/spread ELSE v END,6) AS v FROM s2")
def fit_multi_query(spark, sf):
    """Noisy cells, a noisy marginal (kept where it is within 1) and a noisy total, in two passes."""
    m = measured(spark, sf, 3).drop("orig")
    f = frame(spark, sf).filter("level = 3")
    noisy = lambda group, k, v: f.groupBy(*group).agg(F.sum("orig").alias("s")).select(*group, (F.col("s") + (F.length("geocode") * 5 + k * 7) % 9 - 4).cast("double").alias("q"), F.lit(v).alias("qv"))
    x = fit.multi_query(m, [(["geocode", "flag"], noisy(["geocode", "flag"], F.col("flag"), 0.5), 1.0), (["geocode"], noisy(["geocode"], F.lit(1), 0.25), 0.001)])
    return x.select("geocode", *DIMS, F.round("y", 6).alias("y"), F.round("v", 6).alias("v"))


def nested_sql(value: str) -> str:
    """Rounded total, flags within it, and (status, band) one after the other within those."""
    out, cols = f", n0 AS (SELECT geocode, CAST(greatest(round(round(sum({value}),9)),0) AS BIGINT) AS t FROM x GROUP BY 1)", []
    for k, d in enumerate(DIMS, 1):
        up, cols = ", ".join(["geocode", *cols]), [*cols, d]
        on = " AND ".join(f"s.{c}=p.{c}" for c in ["geocode", *cols[:-1]])
        p = ", ".join(f"s.{c}" for c in ["geocode", *cols])
        out += f", s{k} AS (SELECT geocode, {', '.join(cols)}, round(sum({value}),9) AS s FROM x GROUP BY ALL), j{k} AS (SELECT {p}, s.s, p.t, CAST(floor(s.s+1e-9) AS BIGINT) AS f FROM s{k} s JOIN n{k - 1} p ON {on}), r{k} AS (SELECT *, t-sum(f) OVER (PARTITION BY {up}) AS more, row_number() OVER (PARTITION BY {up} ORDER BY round(s-f,9) DESC, {', '.join(cols)}) AS rk FROM j{k}), n{k} AS (SELECT geocode, {', '.join(cols)}, CAST(f+CASE WHEN rk<=more THEN 1 ELSE 0 END AS BIGINT) AS t FROM r{k})"
    return out


@register("fit_round_by_query", PROJ + nested_sql("x") + f" SELECT geocode, {D}, t AS n FROM n3")
def fit_round_by_query(spark, sf):
    """Fitted cells rounded down the query hierarchy: total, flag, status within flag, band within both."""
    x = fit.nonneg(children(spark, sf), FAMILY, "total", ["geocode"])
    return fit.round_nested(x, ["geocode"], DIMS)


SWAP = MEAS + f""", k AS (SELECT geocode, {D}, CAST(y AS BIGINT) AS n, orig AS y FROM m WHERE level=10), pr AS (SELECT coalesce(a.geocode,b.geocode) AS geocode, coalesce(a.status,b.status) AS status, coalesce(a.band,b.band) AS band, coalesce(a.n,0) AS n, coalesce(a.y,0) AS yn, coalesce(b.n,0) AS m, coalesce(b.y,0) AS ym FROM (SELECT * FROM k WHERE flag=1) a FULL JOIN (SELECT * FROM k WHERE flag=0) b ON a.geocode=b.geocode AND a.status=b.status AND a.band=b.band),
 lk AS (SELECT *, 3-sum(m) OVER (PARTITION BY geocode) AS lack FROM pr), rec AS (SELECT *, unnest(generate_series(1,CAST(least(n,lack) AS BIGINT))) AS j FROM lk WHERE lack>0 AND n>0),
 rk AS (SELECT *, row_number() OVER (PARTITION BY geocode ORDER BY 2*(m-ym)-2*(n-yn)+4*j-2, status, band, j) AS r FROM rec), mv AS (SELECT geocode, status, band, count(*) AS c FROM rk WHERE r<=lack GROUP BY ALL),
 ch AS (SELECT geocode, 0 AS flag, status, band, c FROM mv UNION ALL SELECT geocode, 1, status, band, -c FROM mv) """


@register("fit_swap_repair", SWAP + "SELECT coalesce(k.geocode,ch.geocode) AS geocode, coalesce(k.flag,ch.flag) AS flag, coalesce(k.status,ch.status) AS status, coalesce(k.band,ch.band) AS band, coalesce(n,0)+coalesce(c,0) AS n FROM k FULL JOIN ch ON k.geocode=ch.geocode AND k.flag=ch.flag AND k.status=ch.status AND k.band=ch.band")
def fit_swap_repair(spark, sf):
    """At least three records of flag 0 per unit where flag 1 can give them, moved in the order of the least squared change."""
    c = frame(spark, sf).filter("level = 10").select("geocode", *DIMS, F.col("priv").alias("n"), F.col("orig").alias("y"))
    return fit.swap_repair(c, ["geocode"], "flag", 0, 1, ["status", "band"], F.lit(3))


@register("fit_resume", fitted_sql() + f"SELECT geocode, {D}, CAST(n AS BIGINT) AS n FROM f5")
def fit_resume(spark, sf):
    """The level below a saved one, from a fit restarted there: the SQL fits all levels in one go."""
    lengths, out = fitted_levels(spark, sf)
    path = files.scratch(spark, "fitted")
    out[2].write.parquet(path)
    again = fit.top_down([spark.read.parquet(path).withColumns({"y": F.col("n").cast("double"), "v": F.lit(1.0)}).drop("n"), measured(spark, sf, 5).drop("orig")], "geocode", [3], DIMS)
    return again[1].select("geocode", *DIMS, "n")


@register("cons_facility_age_bounds", FAC + ", a AS (SELECT substr(geocode,1,5) AS geocode, CAST(sum(CASE WHEN qty>=18 THEN 1 ELSE 0 END) AS BIGINT) AS adults FROM persons GROUP BY 1) SELECT b.geocode, unit_type, CAST(greatest(lower-(total-adults),0) AS BIGINT) AS lower_adults, least(upper, adults) AS upper_adults FROM b JOIN a ON a.geocode=b.geocode JOIN t ON t.geocode=b.geocode")
def cons_facility_age_bounds(spark, sf):
    """Adults by facility type: minors fill the least number first, so adults are at least what is then lacking."""
    a = persons(spark, sf).groupBy(F.substring("geocode", 1, 5).alias("geocode")).agg(F.sum(F.when(F.col("qty") >= 18, 1).otherwise(0)).alias("adults"), F.count("*").alias("total"))
    j = tract_bounds(spark, sf).join(a, "geocode")
    lower = F.greatest(F.col("lower") - (F.col("total") - F.col("adults")), F.lit(0))
    return j.select("geocode", "unit_type", lower.alias("lower_adults"), F.least("upper", "adults").alias("upper_adults"))


@register("cons_structural_zeros_household", "SELECT unit_type, 'alone' AS rule, count(*) AS n FROM (SELECT unit, max(unit_type) AS unit_type, count(*) AS c FROM persons GROUP BY 1) WHERE c<=5 GROUP BY ALL UNION ALL SELECT unit_type, 'crowded', count(*) FROM (SELECT unit, max(unit_type) AS unit_type, count(*) AS c FROM persons GROUP BY 1) WHERE c>=50 GROUP BY ALL")
def cons_structural_zeros_household(spark, sf):
    h = persons(spark, sf).groupBy("unit").agg(F.max("unit_type").alias("unit_type"), F.count("*").alias("c")).withColumn("n", F.lit(1))
    return constraints.structural_zeros(h, ["unit_type"], {"alone": F.col("c") <= 5, "crowded": F.col("c") >= 50}, "n")


@register("cons_cross_histogram", "SELECT u.geocode, coalesce(p.n,0) AS value, u.m AS rhs, '=' AS sign FROM (SELECT substr(geocode,1,5) AS geocode, count(*) AS m FROM units GROUP BY 1) u LEFT JOIN (SELECT substr(geocode,1,5) AS geocode, count(DISTINCT unit) AS n FROM persons WHERE ostatus='P' GROUP BY 1) p ON p.geocode=u.geocode WHERE coalesce(p.n,0)<>u.m")
def cons_cross_histogram(spark, sf):
    tract = F.substring("geocode", 1, 5).alias("geocode")
    rhs = units(spark, sf).groupBy(tract).agg(F.count("*").alias("rhs")).withColumn("sign", F.lit("="))
    active = persons(spark, sf).filter("ostatus = 'P'").select(tract, "unit").distinct().groupBy("geocode").agg(F.count("*").alias("value"))
    return checks.constraint_failures(active, rhs, ["geocode"])


@register("udf_query_udf_hook", "SELECT event_type, CAST(sum(user_id % 7) AS BIGINT) AS n FROM events GROUP BY 1", base=False)
def udf_query_udf_hook(spark, sf):
    """A user's scalar function registered as SQL, so it stays inside generated code."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tessera_mod7(x BIGINT) RETURNS BIGINT RETURN x % 7")
    return spark.sql("SELECT event_type, sum(tessera_mod7(user_id)) AS n FROM {t} GROUP BY event_type", t=table(spark, sf, "events"))
