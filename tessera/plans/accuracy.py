"""Registered queries: accuracy metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import hist, order, query
from tessera.operators import metrics as m
from tessera.plans.base import DIMS, SCHEMA, SIZES, frame, persons, register, table
from tessera.plans.tabulation import ANY_BAND, GEO, answers

R = 6
UNIT = """, us AS (SELECT level, geocode, CAST(sum(orig) AS BIGINT) AS orig, CAST(sum(priv) AS BIGINT) AS priv, CAST(sum(abs(priv-orig)) AS BIGINT) AS l1, CAST(sum((priv-orig)*(priv-orig)) AS BIGINT) AS sq, CAST(max(abs(priv-orig)) AS BIGINT) AS linf,
 CAST(sum(CASE WHEN orig<>0 THEN 1 ELSE 0 END) AS BIGINT) AS nz_orig, CAST(sum(CASE WHEN priv<>0 THEN 1 ELSE 0 END) AS BIGINT) AS nz_priv FROM frame GROUP BY level, geocode) """
COLS = "level, geocode, flag, status, band"


def us(spark, sf):
    return m.unit_sums(frame(spark, sf), GEO)


def r(c, name):
    return F.round(c, R).alias(name)


@register("metric_l1", f"SELECT {COLS}, abs(priv-orig) AS l1 FROM frame")
def metric_l1(spark, sf):
    return frame(spark, sf).select(*GEO, *DIMS, m.l1().alias("l1"))


@register("metric_l2", UNIT + "SELECT level, geocode, sq, round(sqrt(sq),6) AS l2 FROM us")
def metric_l2(spark, sf):
    return us(spark, sf).select(*GEO, "sq", r(F.sqrt("sq"), "l2"))


@register("metric_signed_error", f"SELECT {COLS}, priv-orig AS error FROM frame")
def metric_signed_error(spark, sf):
    return frame(spark, sf).select(*GEO, *DIMS, m.error().alias("error"))


@register("metric_linf", UNIT + "SELECT level, CAST(sum(linf) AS BIGINT) AS total, max(linf) AS most FROM us GROUP BY level")
def metric_linf(spark, sf):
    return us(spark, sf).groupBy("level").agg(F.sum("linf").alias("total"), F.max("linf").alias("most"))


@register("metric_relative_error", "SELECT level, geocode, round(sum(abs(priv-orig)/(10.0+orig)),6) AS rel10, round(sum(abs(priv-orig)/CAST(greatest(orig,1) AS DOUBLE)),6) AS rel1 FROM frame GROUP BY ALL")
def metric_relative_error(spark, sf):
    return frame(spark, sf).groupBy(*GEO).agg(r(F.sum(m.l1() / (10.0 + F.col("orig"))), "rel10"), r(F.sum(m.l1() / F.greatest("orig", F.lit(1)).cast("double")), "rel1"))


@register("metric_unit_avg_l1", UNIT + "SELECT level, geocode, round(l1/nullif(CAST(priv AS DOUBLE),0),6) AS avg_l1 FROM us")
def metric_unit_avg_l1(spark, sf):
    return us(spark, sf).select(*GEO, r(m.ratio(F.col("l1"), F.col("priv")), "avg_l1"))


@register("metric_l1_relative", """, x AS (SELECT *, ((flag*2+status)*5+band) AS cell FROM frame), t AS (SELECT level, geocode, sum(orig) AS o, sum(priv) AS p, arg_max(orig, priv*1000-cell) AS bo, arg_max(priv, priv*1000-cell) AS bp FROM x GROUP BY ALL)
 SELECT level, geocode, round(CASE WHEN o=0 AND p=0 THEN 0.0 WHEN o=0 OR p=0 THEN 2.0 ELSE abs(CAST(bp AS DOUBLE)/p-CAST(bo AS DOUBLE)/o) END,6) AS gap FROM t""")
def metric_l1_relative(spark, sf):
    g = m.share_gap(frame(spark, sf).withColumn("cell", hist.flat_index(DIMS, SIZES)), GEO, "cell")
    return g.withColumn("gap", F.round("gap", R))


@register("metric_unit_tvd", UNIT + "SELECT level, geocode, round(1-l1/nullif(2.0*orig,0),6) AS tvd FROM us")
def metric_unit_tvd(spark, sf):
    return us(spark, sf).select(*GEO, r(m.tvd(F.col("l1"), F.col("orig")), "tvd"))


MANY2 = """, many AS (SELECT level AS geolevel, geocode, 'total' AS query, 'total' AS level, orig, priv FROM frame UNION ALL SELECT level, geocode, 'flag', CAST(flag AS VARCHAR), orig, priv FROM frame UNION ALL SELECT level, geocode, 'flag * status', flag || ' BY ' || status, orig, priv FROM frame
 UNION ALL SELECT level, geocode, 'any_band', any_band, orig, priv FROM frame """ + ANY_BAND + """ UNION ALL SELECT level, geocode, 'detailed', flag || ' BY ' || status || ' BY ' || band, orig, priv FROM frame),
 answers AS (SELECT geolevel, geocode, query, level, CAST(sum(orig) AS BIGINT) AS orig, CAST(sum(priv) AS BIGINT) AS priv FROM many GROUP BY ALL) """


@register("metric_level_tvd", MANY2 + "SELECT geolevel, query, CAST(sum(abs(priv-orig)) AS BIGINT) AS l1, CAST(sum(orig) AS BIGINT) AS orig, round(1-sum(abs(priv-orig))/(2.0*sum(orig)),6) AS tvd FROM answers GROUP BY geolevel, query")
def metric_level_tvd(spark, sf):
    s = answers(spark, sf).groupBy("geolevel", "query").agg(F.sum(m.l1()).alias("l1"), F.sum("orig").alias("orig"))
    return s.select("geolevel", "query", "l1", "orig", r(m.tvd(F.col("l1"), F.col("orig")), "tvd"))


@register("metric_nonzero_density", UNIT + "SELECT level, geocode, nz_orig, nz_priv, round(nz_orig/30.0,6) AS density, round(1-nz_orig/30.0,6) AS sparsity FROM us")
def metric_nonzero_density(spark, sf):
    d = F.col("nz_orig") / 30.0
    return us(spark, sf).select(*GEO, "nz_orig", "nz_priv", r(d, "density"), r(1 - d, "sparsity"))


@register("metric_sparsity_by_query", MANY2 + """, q AS (SELECT geolevel, query, count(DISTINCT geocode) AS units, sum(CASE WHEN orig<>0 THEN 1 ELSE 0 END) AS o, sum(CASE WHEN priv<>0 THEN 1 ELSE 0 END) AS p FROM answers GROUP BY ALL)
 SELECT geolevel, query, round(1-o/(units*CAST(CASE query WHEN 'total' THEN 1 WHEN 'flag' THEN 3 WHEN 'flag * status' THEN 6 WHEN 'any_band' THEN 2 ELSE 30 END AS DOUBLE)),6) AS sparsity, round(abs(p-o)/CAST(units AS DOUBLE),6) AS l1 FROM q""")
def metric_sparsity_by_query(spark, sf):
    sizes = F.create_map(*[F.lit(x) for q in ["total", "flag", "flag * status", "any_band", "detailed"] for x in (q, float(len(SCHEMA.levels(q))))])
    q = answers(spark, sf).groupBy("geolevel", "query").agg(F.countDistinct("geocode").alias("u"), F.sum(F.when(F.col("orig") != 0, 1).otherwise(0)).alias("o"), F.sum(F.when(F.col("priv") != 0, 1).otherwise(0)).alias("p"))
    return q.select("geolevel", "query", r(1 - F.col("o") / (F.col("u") * sizes[F.col("query")]), "sparsity"), r(F.abs(F.col("p") - F.col("o")) / F.col("u"), "l1"))


@register("metric_level_totals", UNIT + "SELECT level, CAST(sum(priv-orig) AS BIGINT) AS change, CAST(sum(abs(priv-orig)) AS BIGINT) AS abs_change, CAST(sum(sign(priv-orig)) AS BIGINT) AS signs, count(*) AS units, CAST(sum(CASE WHEN orig=0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_orig, CAST(sum(CASE WHEN priv=0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_priv FROM us GROUP BY level")
def metric_level_totals(spark, sf):
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return us(spark, sf).groupBy("level").agg(
        F.sum(m.error()).alias("change"), F.sum(m.l1()).alias("abs_change"), F.sum(F.signum(m.error().cast("double")).cast("long")).alias("signs"), F.count("*").alias("units"), one(F.col("orig") == 0).alias("zero_orig"), one(F.col("priv") == 0).alias("zero_priv")
    )


@register("metric_query_l1_max", MANY2 + ", u AS (SELECT geolevel, query, geocode, sum(abs(priv-orig)) AS l1, max(abs(priv-orig)) AS mx FROM answers GROUP BY ALL) SELECT geolevel, query, CAST(sum(l1) AS BIGINT) AS l1, CAST(sum(mx) AS BIGINT) AS most, round(avg(l1),6) AS mean_l1, round(avg(mx),6) AS mean_most FROM u GROUP BY ALL")
def metric_query_l1_max(spark, sf):
    u = answers(spark, sf).groupBy("geolevel", "query", "geocode").agg(F.sum(m.l1()).alias("l1"), F.max(m.l1()).alias("mx"))
    return u.groupBy("geolevel", "query").agg(F.sum("l1").alias("l1"), F.sum("mx").alias("most"), r(F.avg("l1"), "mean_l1"), r(F.avg("mx"), "mean_most"))


@register("metric_query_counts", MANY2 + "SELECT geocode, geolevel, query, string_agg(level || '=' || orig || '/' || priv, ';' ORDER BY level) AS counts FROM answers WHERE query<>'detailed' GROUP BY ALL")
def metric_query_counts(spark, sf):
    item = F.struct("level", F.concat(F.col("level"), F.lit("="), F.col("orig").cast("string"), F.lit("/"), F.col("priv").cast("string")).alias("t"))
    a = answers(spark, sf).filter("query <> 'detailed'").groupBy("geocode", "geolevel", "query").agg(F.sort_array(F.collect_list(item)).alias("x"))
    return a.select("geocode", "geolevel", "query", F.array_join("x.t", ";").alias("counts"))


@register("metric_error_histogram", """, e AS (SELECT level, abs(priv-orig) AS e FROM frame), w AS (SELECT level, CAST(greatest(floor(max(e)/20.0),1) AS BIGINT) AS width FROM e GROUP BY level)
 SELECT e.level, width, CAST(floor(e/CAST(width AS DOUBLE)) AS BIGINT) AS bin, count(*) AS n FROM e JOIN w ON e.level=w.level GROUP BY ALL""")
def metric_error_histogram(spark, sf):
    return m.error_histogram(frame(spark, sf), ["level"])


CLASS = "CASE WHEN orig<=0 THEN 0 ELSE CAST(power(10, length(CAST(orig AS VARCHAR))-1) AS BIGINT) END"


@register("metric_error_histogram_by_pop", UNIT + f""", c AS (SELECT level, geocode, {CLASS} AS pop FROM us), e AS (SELECT f.level, pop, abs(priv-orig) AS e FROM frame f JOIN c ON c.geocode=f.geocode AND c.level=f.level), w AS (SELECT level, pop, CAST(greatest(floor(max(e)/20.0),1) AS BIGINT) AS width FROM e GROUP BY ALL)
 SELECT e.level, e.pop, width, CAST(floor(e/CAST(width AS DOUBLE)) AS BIGINT) AS bin, count(*) AS n FROM e JOIN w ON e.level=w.level AND e.pop=w.pop GROUP BY ALL""")
def metric_error_histogram_by_pop(spark, sf):
    f = frame(spark, sf)
    c = us(spark, sf).select(*GEO, m.pow10_class(F.col("orig")).alias("pop"))
    return m.error_histogram(f.join(c, GEO), ["level", "pop"])


PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]



def quantile_sql(source: str, keys: str, value: str) -> str:
    parts = [f"SELECT {keys}, CAST({p} AS DOUBLE) AS quantile, round(quantile_cont({value}, {p}),6) AS value FROM {source} GROUP BY {keys}" for p in PROBS]
    return " UNION ALL ".join(parts)


def rounded(f: DataFrame, *names: str) -> DataFrame:
    return f.withColumns({n: F.round(n, R) for n in names})


@register("metric_nonzero_error_quantiles", MANY2 + ", e AS (SELECT geolevel, query, CAST(abs(priv-orig) AS DOUBLE) AS e FROM answers WHERE priv<>orig) " + quantile_sql("e", "geolevel, query", "e"))
def metric_nonzero_error_quantiles(spark, sf):
    e = answers(spark, sf).filter("priv <> orig").withColumn("e", m.l1().cast("double"))
    return rounded(m.quantiles(e, ["geolevel", "query"], "e", PROBS), "value")


@register("metric_total_error_by_bin", UNIT + "SELECT level, CAST(floor(orig/50.0)*50 AS BIGINT) AS bin, round(avg(abs(priv-orig)),6) AS mae, count(*) AS n FROM us GROUP BY ALL UNION ALL SELECT level, NULL, round(avg(abs(priv-orig)),6), count(*) FROM us GROUP BY level")
def metric_total_error_by_bin(spark, sf):
    u = us(spark, sf).withColumn("bin", m.bin_start(F.col("orig"), 50))
    out = lambda g: g.agg(r(F.avg(m.l1()), "mae"), F.count("*").alias("n"))
    return out(u.groupBy("level", "bin")).unionByName(out(u.groupBy("level")).withColumn("bin", F.lit(None).cast("long")))


@register("metric_relative_total_error", UNIT + "SELECT level, CAST(floor(orig/50.0)*50 AS BIGINT) AS bin, round(avg(CASE WHEN abs(priv-orig)/CAST(orig AS DOUBLE)<=0.05 THEN 1.0 ELSE 0.0 END),6) AS within, round(avg(abs(priv-orig)/CAST(orig AS DOUBLE)),6) AS mean_rel, count(*) AS n FROM us WHERE orig>0 GROUP BY ALL")
def metric_relative_total_error(spark, sf):
    u = us(spark, sf).filter("orig > 0").withColumn("bin", m.bin_start(F.col("orig"), 50)).withColumn("rel", m.ratio(m.l1(), F.col("orig")))
    return u.groupBy("level", "bin").agg(r(F.avg(F.when(F.col("rel") <= 0.05, 1.0).otherwise(0.0)), "within"), r(F.avg("rel"), "mean_rel"), F.count("*").alias("n"))


@register("metric_relative_query_error", MANY2 + "SELECT geolevel, query, round(avg(abs(priv-orig)/CAST(orig AS DOUBLE)),6) AS mean_rel, count(*) AS n FROM answers WHERE orig>=5 GROUP BY ALL")
def metric_relative_query_error(spark, sf):
    a = answers(spark, sf).filter("orig >= 5")
    return a.groupBy("geolevel", "query").agg(r(F.avg(m.ratio(m.l1(), F.col("orig"))), "mean_rel"), F.count("*").alias("n"))


RANGE = "CASE WHEN orig<10 THEN '[0, 10)' WHEN orig<100 THEN '[10, 100)' WHEN orig<1000 THEN '[100, 1000)' ELSE '1000+' END"


@register("metric_binned_error_quantiles", UNIT + f", b AS (SELECT level, {RANGE} AS pop, CAST(abs(priv-orig) AS DOUBLE) AS e FROM us) " + quantile_sql("b", "level, pop", "e"))
def metric_binned_error_quantiles(spark, sf):
    b = us(spark, sf).withColumn("pop", m.range_label(F.col("orig"), [0, 10, 100, 1000])).withColumn("e", m.l1().cast("double"))
    return rounded(m.quantiles(b, ["level", "pop"], "e", PROBS), "value")


@register("recode_bin_column", UNIT + f"SELECT level, geocode, orig, {RANGE} AS pop FROM us")
def recode_bin_column(spark, sf):
    return us(spark, sf).select(*GEO, "orig", m.range_label(F.col("orig"), [0, 10, 100, 1000]).alias("pop"))


@register("recode_pow10_bin", UNIT + f"SELECT level, geocode, orig, {CLASS} AS pop FROM us")
def recode_pow10_bin(spark, sf):
    return us(spark, sf).select(*GEO, "orig", m.pow10_class(F.col("orig")).alias("pop"))


DIV = """, g AS (SELECT geocode, flag, status, sum(orig) AS n, sum(priv) AS m FROM frame WHERE level=10 GROUP BY ALL), d AS (SELECT geocode, round(1-sum(n*n)/power(sum(n),2),9) AS diversity, CAST(sum(n) AS BIGINT) AS orig, CAST(sum(m) AS BIGINT) AS priv FROM g GROUP BY geocode),
 k AS (SELECT *, CAST(ceil(5.0*rank() OVER (ORDER BY diversity)/count(*) OVER ()) AS INTEGER) AS fifth FROM d) """


def fifths(spark, sf):
    d = m.diversity(frame(spark, sf).filter("level = 10"), ["geocode"], ["flag", "status"]).withColumn("diversity", F.round("diversity", 9))
    # ranks from counts of equal values
    v = order.running(d.groupBy("diversity").agg(F.count("*").alias("c")), ["diversity"], F.col("c"), "before")
    n = F.broadcast(d.agg(F.count("*").alias("n")))
    v = v.crossJoin(n).select("diversity", F.ceil(5.0 * (F.col("before") + 1) / F.col("n")).cast("int").alias("fifth"))
    return d.join(v, "diversity")


@register("metric_diversity_quintiles", DIV + "SELECT fifth, count(*) AS n, round(avg(priv-orig),6) AS mean_error, round(avg(abs(priv-orig)),6) AS mae FROM k GROUP BY fifth")
def metric_diversity_quintiles(spark, sf):
    return fifths(spark, sf).groupBy("fifth").agg(F.count("*").alias("n"), r(F.avg(m.error()), "mean_error"), r(F.avg(m.l1()), "mae"))


@register("recode_quantile_bin", DIV + "SELECT geocode, diversity, fifth FROM k WHERE fifth IN (1,5)")
def recode_quantile_bin(spark, sf):
    return fifths(spark, sf).filter("fifth in (1, 5)").select("geocode", "diversity", "fifth")


@register("metric_group_size_mae", ", g AS (SELECT level, geocode, flag, status, sum(orig) AS orig, sum(priv) AS priv FROM frame GROUP BY ALL) SELECT level, flag, status, CASE WHEN orig<10 THEN '[0, 10)' WHEN orig<100 THEN '[10, 100)' ELSE '100+' END AS size, round(avg(abs(priv-orig)),6) AS mae, count(*) AS n FROM g GROUP BY ALL")
def metric_group_size_mae(spark, sf):
    g = frame(spark, sf).groupBy(*GEO, "flag", "status").agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    return g.groupBy("level", "flag", "status", m.range_label(F.col("orig"), [0, 10, 100]).alias("size")).agg(r(F.avg(m.l1()), "mae"), F.count("*").alias("n"))


@register("metric_merged_unit_error", ", t AS (SELECT substr(geocode,1,1)||substr(geocode,4,2) AS merged, sum(orig) AS orig, sum(priv) AS priv FROM frame WHERE level=5 GROUP BY ALL) SELECT round(avg(abs(priv-orig)),6) AS mae, round(avg(CASE WHEN abs(priv-orig)<=20 THEN 1.0 ELSE 0.0 END),6) AS within20, count(*) AS n FROM t")
def metric_merged_unit_error(spark, sf):
    t = frame(spark, sf).filter("level = 5").groupBy(F.concat(F.substring("geocode", 1, 1), F.substring("geocode", 4, 2)).alias("merged")).agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    return t.agg(r(F.avg(m.l1()), "mae"), r(F.avg(F.when(m.l1() <= 20, 1.0).otherwise(0.0)), "within20"), F.count("*").alias("n"))


RUNS = ", runs AS (SELECT geocode, flag, run, count(*) AS x FROM (SELECT substr(geocode,1,3) AS geocode, flag, run FROM persons) GROUP BY ALL) "


def runs(spark, sf):
    return persons(spark, sf).groupBy(F.substring("geocode", 1, 3).alias("geocode"), "flag", "run").agg(F.count("*").alias("x"))


@register("metric_table_cv", RUNS + "SELECT geocode, flag, round(stddev_samp(x)/greatest(1, arg_min(x, run)),6) AS cv FROM runs GROUP BY ALL")
def metric_table_cv(spark, sf):
    return runs(spark, sf).groupBy("geocode", "flag").agg(r(F.stddev_samp("x") / F.greatest(F.lit(1), F.min_by("x", "run")), "cv"))


@register("metric_sample_variance", RUNS + "SELECT geocode, flag, round(var_samp(x),6) AS variance FROM runs GROUP BY ALL")
def metric_sample_variance(spark, sf):
    return rounded(m.sample_variance(runs(spark, sf), ["geocode", "flag"], "x"), "variance")


@register("metric_sum_avg", RUNS + "SELECT geocode, CAST(sum(x) AS BIGINT) AS total, round(avg(x),6) AS mean FROM runs GROUP BY ALL")
def metric_sum_avg(spark, sf):
    return runs(spark, sf).groupBy("geocode").agg(F.sum("x").alias("total"), r(F.avg("x"), "mean"))


@register("metric_group_quantiles", ", e AS (SELECT l_returnflag AS flag, l_extendedprice AS e FROM lineitem) " + quantile_sql("e", "flag", "e"))
def metric_group_quantiles(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("e"))
    return rounded(m.quantiles(li, ["flag"], "e", PROBS), "value")


@register("metric_column_quantiles", "SELECT CAST(quantile_disc(CAST(l_quantity AS DOUBLE), 0.5) AS DOUBLE) AS median, CAST(quantile_disc(CAST(l_quantity AS DOUBLE), 0.9) AS DOUBLE) AS p90 FROM lineitem")
def metric_column_quantiles(spark, sf):
    q = table(spark, sf, "lineitem").agg(F.percentile_approx(F.col("l_quantity").cast("double"), [0.5, 0.9], 1_000_000).alias("q"))
    return q.select(F.col("q")[0].alias("median"), F.col("q")[1].alias("p90"))


@register("metric_error_by_true_bin", MANY2 + "SELECT geolevel, query, CAST(floor(orig/10.0)*10 AS BIGINT) AS bin, round(avg(priv-orig),6) AS signed, round(avg(abs(priv-orig)),6) AS absolute, round(avg(abs(priv-orig)/nullif(CAST(orig AS DOUBLE),0)),6) AS relative FROM answers GROUP BY ALL")
def metric_error_by_true_bin(spark, sf):
    a = answers(spark, sf).withColumn("bin", m.bin_start(F.col("orig"), 10))
    return a.groupBy("geolevel", "query", "bin").agg(r(F.avg(m.error()), "signed"), r(F.avg(m.l1()), "absolute"), r(F.avg(m.ratio(m.l1(), F.col("orig"))), "relative"))


AGE = ", a AS (SELECT substr(geocode,1,3) AS geocode, flag, qty, count(*) AS n FROM persons GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY geocode, flag ORDER BY qty) AS run, sum(n) OVER (PARTITION BY geocode, flag) AS al FROM a) "


@register("metric_age_quantiles_by_category", AGE + "SELECT geocode, flag, min(CASE WHEN run>=0.25*al THEN qty END) AS q25, min(CASE WHEN run>=0.5*al THEN qty END) AS q50 FROM c GROUP BY ALL")
def metric_age_quantiles_by_category(spark, sf):
    a = persons(spark, sf).groupBy(F.substring("geocode", 1, 3).alias("geocode"), "flag", "qty").agg(F.count("*").alias("n"))
    keys = ["geocode", "flag"]
    return m.count_quantile(a, keys, "qty", "n", 0.25, "q25").join(m.count_quantile(a, keys, "qty", "n", 0.5, "q50"), keys)


@register("metric_unit_counts", "SELECT level, count(DISTINCT geocode) AS units FROM frame GROUP BY level")
def metric_unit_counts(spark, sf):
    return frame(spark, sf).groupBy("level").agg(F.countDistinct("geocode").alias("units"))


@register("metric_population_density", ", t AS (SELECT geocode, sum(orig) AS orig, sum(priv) AS priv FROM frame WHERE level=3 GROUP BY 1), a AS (SELECT CAST(n_regionkey AS VARCHAR)||lpad(CAST(n_nationkey AS VARCHAR),2,'0') AS geocode, n_nationkey+1 AS area FROM nation) SELECT a.geocode, round(coalesce(orig,0)/CAST(area AS DOUBLE),6) AS dense_orig, round(coalesce(priv,0)/CAST(area AS DOUBLE),6) AS dense_priv, round(abs(coalesce(priv,0)-coalesce(orig,0))/CAST(area AS DOUBLE),6) AS l1 FROM a LEFT JOIN t ON a.geocode=t.geocode")
def metric_population_density(spark, sf):
    t = frame(spark, sf).filter("level = 3").groupBy("geocode").agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    a = table(spark, sf, "nation").select(F.concat(F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("geocode"), (F.col("n_nationkey") + 1).cast("double").alias("area"))
    j = a.join(t, "geocode", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("orig", "priv")})
    return j.select("geocode", r(F.col("orig") / F.col("area"), "dense_orig"), r(F.col("priv") / F.col("area"), "dense_priv"), r(m.l1() / F.col("area"), "l1"))


@register("metric_group_share", RUNS + ", s AS (SELECT geocode, flag, x/CAST(sum(x) OVER (PARTITION BY geocode, run) AS DOUBLE) AS share FROM runs) SELECT geocode, flag, round(avg(share),6) AS share FROM s GROUP BY ALL")
def metric_group_share(spark, sf):
    s = runs(spark, sf).withColumn("share", F.col("x") / F.sum("x").over(W.partitionBy("geocode", "run")))
    return s.groupBy("geocode", "flag").agg(r(F.avg("share"), "share"))


@register("metric_run_variation", RUNS + ", g AS (SELECT geocode, flag, avg(x) AS mean, avg(CAST(x*x AS DOUBLE))-avg(x)*avg(x) AS var, avg((x-10.0)*(x-10.0)) AS around FROM runs GROUP BY ALL) SELECT flag, round(avg(var),6) AS own, round(avg(around),6) AS around_truth, round(avg(sqrt(greatest(var,0))/mean),6) AS relative FROM g GROUP BY flag")
def metric_run_variation(spark, sf):
    x = F.col("x").cast("double")
    g = runs(spark, sf).groupBy("geocode", "flag").agg(F.avg(x).alias("mean"), (F.avg(x * x) - F.avg(x) * F.avg(x)).alias("var"), F.avg((x - 10) * (x - 10)).alias("around"))
    return g.groupBy("flag").agg(r(F.avg("var"), "own"), r(F.avg("around"), "around_truth"), r(F.avg(F.sqrt(F.greatest("var", F.lit(0.0))) / F.col("mean")), "relative"))


@register("metric_summary_pack", """, s AS (SELECT level, avg(CAST(abs(priv-orig) AS DOUBLE)) AS mae, sqrt(avg(CAST((priv-orig)*(priv-orig) AS DOUBLE))) AS rmse, avg(CAST(orig AS DOUBLE)) AS mn, avg(abs((priv-orig)/nullif(CAST(orig AS DOUBLE),0))) AS mape, avg((priv-orig)/nullif(CAST(orig AS DOUBLE),0)) AS malpe, CAST(sum(CASE WHEN abs((priv-orig)/nullif(CAST(orig AS DOUBLE),0))>0.1 THEN 1 ELSE 0 END) AS DOUBLE) AS o10, CAST(count(*) AS DOUBLE) AS n FROM frame GROUP BY level)
 SELECT level, 'MAE' AS name, round(mae,6) AS value FROM s UNION ALL SELECT level,'RMSE',round(rmse,6) FROM s UNION ALL SELECT level,'CoV',round(100*rmse/mn,6) FROM s UNION ALL SELECT level,'MAPE',round(mape,6) FROM s UNION ALL SELECT level,'MALPE',round(malpe,6) FROM s UNION ALL SELECT level,'OVER10',o10 FROM s UNION ALL SELECT level,'ROWS',n FROM s""")
def metric_summary_pack(spark, sf):
    return rounded(m.summary(frame(spark, sf), ["level"]), "value")


@register("metric_aggregate_family", UNIT + "SELECT level||'.sum.l1' AS key, CAST(sum(l1) AS DOUBLE) AS value FROM us GROUP BY level UNION ALL SELECT level||'.avg.l1', round(avg(l1),6) FROM us GROUP BY level UNION ALL SELECT level||'.max.linf', CAST(max(linf) AS DOUBLE) FROM us GROUP BY level")
def metric_aggregate_family(spark, sf):
    a = us(spark, sf).groupBy("level").agg(F.sum("l1").cast("double").alias("sum.l1"), F.avg("l1").alias("avg.l1"), F.max("linf").cast("double").alias("max.linf"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").alias("v")) for c in a.columns[1:]]))
    return a.select("level", pairs.alias("x")).select(F.concat_ws(".", F.col("level").cast("string"), "x.k").alias("key"), r(F.col("x.v"), "value"))


@register("metric_cross_margins", "SELECT level, 'flag' AS margin, CAST(sum(e) AS BIGINT) AS l1 FROM (SELECT level, geocode, flag, abs(sum(priv)-sum(orig)) AS e FROM frame GROUP BY ALL) GROUP BY level UNION ALL SELECT level, 'flag*band', CAST(sum(e) AS BIGINT) FROM (SELECT level, geocode, flag, band, abs(sum(priv)-sum(orig)) AS e FROM frame GROUP BY ALL) GROUP BY level")
def metric_cross_margins(spark, sf):
    f = frame(spark, sf)
    out = [query.marginal(f, GEO, keep, ["orig", "priv"]).groupBy("level").agg(F.sum(m.l1()).alias("l1")).withColumn("margin", F.lit("*".join(keep))) for keep in (["flag"], ["flag", "band"])]
    return reduce(DataFrame.unionByName, out)


@register("metric_block_describe", UNIT + ", b AS (SELECT l1, 1-l1/nullif(2.0*orig,0) AS t FROM us WHERE level=10) SELECT count(*) AS n, round(avg(l1),6) AS mean_l1, round(stddev_samp(l1),6) AS sd_l1, min(l1) AS min_l1, max(l1) AS max_l1, round(avg(t),6) AS mean_t, round(stddev_samp(t),6) AS sd_t FROM b")
def metric_block_describe(spark, sf):
    b = us(spark, sf).filter("level = 10").withColumn("t", m.tvd(F.col("l1"), F.col("orig")))
    return b.agg(F.count("*").alias("n"), r(F.avg("l1"), "mean_l1"), r(F.stddev_samp("l1"), "sd_l1"), F.min("l1").alias("min_l1"), F.max("l1").alias("max_l1"), r(F.avg("t"), "mean_t"), r(F.stddev_samp("t"), "sd_t"))


@register("metric_plot_frames", MANY2 + "SELECT geolevel, query, round(avg(abs(priv-orig)),6) AS y FROM answers GROUP BY ALL")
def metric_plot_frames(spark, sf):
    return answers(spark, sf).groupBy("geolevel", "query").agg(r(F.avg(m.l1()), "y"))


@register("metric_loop_errors", RUNS + "SELECT flag, run, round(avg(abs(x-10)),6) AS error FROM runs WHERE run<=3 GROUP BY ALL")
def metric_loop_errors(spark, sf):
    return runs(spark, sf).filter("run <= 3").groupBy("flag", "run").agg(r(F.avg(F.abs(F.col("x") - 10)), "error"))


@register("metric_empty_block_bins", f", o AS (SELECT geocode, count(*) AS orig, max(CASE WHEN ostatus='P' THEN 1 ELSE 0 END) AS occ FROM persons GROUP BY 1) SELECT substr(geocode,1,3) AS state, {CLASS} AS pop, CAST(sum(1-occ) AS BIGINT) AS empty, count(*) AS n FROM o GROUP BY ALL")
def metric_empty_block_bins(spark, sf):
    o = persons(spark, sf).groupBy("geocode").agg(F.count("*").alias("orig"), F.max(F.when(F.col("ostatus") == "P", 1).otherwise(0)).alias("occ"))
    return o.groupBy(F.substring("geocode", 1, 3).alias("state"), m.pow10_class(F.col("orig")).alias("pop")).agg(F.sum(1 - F.col("occ")).alias("empty"), F.count("*").alias("n"))


@register("metric_error_cdf", ", e AS (SELECT level, abs(priv-orig) AS e, count(*) AS n FROM frame GROUP BY ALL) SELECT level, e, n, round(sum(n) OVER (PARTITION BY level ORDER BY e)/CAST(sum(n) OVER (PARTITION BY level) AS DOUBLE),6) AS cdf FROM e")
def metric_error_cdf(spark, sf):
    e = frame(spark, sf).groupBy("level", m.l1().alias("e")).agg(F.count("*").alias("n"))
    return e.select("level", "e", "n", r(F.sum("n").over(W.partitionBy("level").orderBy("e")) / F.sum("n").over(W.partitionBy("level")), "cdf"))


@register("metric_compare_runs", UNIT + "SELECT level, round(quantile_cont(l1,0.5),6) AS run_a, round(quantile_cont(linf,0.5),6) AS run_b FROM us GROUP BY level")
def metric_compare_runs(spark, sf):
    u = us(spark, sf)
    a, b = (m.quantiles(u, ["level"], v, [0.5]).select("level", r(F.col("value"), n)) for v, n in (("l1", "run_a"), ("linf", "run_b")))
    return a.join(b, "level")


@register("metric_fanout", ", c AS (SELECT substr(geocode,1,3) AS parent, count(DISTINCT substr(geocode,1,5)) AS n FROM units GROUP BY 1) SELECT max(n) AS fanout FROM c")
def metric_fanout(spark, sf):
    return persons(spark, sf).select(F.substring("geocode", 1, 3).alias("p"), F.substring("geocode", 1, 5).alias("c")).distinct().groupBy("p").agg(F.count("*").alias("n")).agg(F.max("n").alias("fanout"))


@register("metric_entities_per_group", ", g AS (SELECT substr(geocode,1,5) AS grp, count(DISTINCT supplier) AS entities FROM persons GROUP BY 1) SELECT entities, count(*) AS groups FROM g GROUP BY 1")
def metric_entities_per_group(spark, sf):
    g = persons(spark, sf).select(F.substring("geocode", 1, 5).alias("grp"), "supplier").distinct().groupBy("grp").agg(F.count("*").alias("entities"))
    return g.groupBy("entities").agg(F.count("*").alias("groups"))
