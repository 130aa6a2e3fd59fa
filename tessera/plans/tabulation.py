"""Registered queries: histograms and tabulation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import hist, query
from tessera.plans.base import DIMS, LEVELS, SCHEMA, SIZES, cells, frame, persons, register, table, units

D = "flag, status, band"
CELL = "((flag*2+status)*5+band)"


@register("hist_count_by_cell", "SELECT * FROM cells")
def hist_count_by_cell(spark, sf):
    return cells(spark, sf)


@register("hist_flat_index", f"SELECT geocode, CAST({CELL} AS INTEGER) AS cell, flag, status, band, orig FROM cells")
def hist_flat_index(spark, sf):
    c = cells(spark, sf).select("geocode", hist.flat_index(DIMS, SIZES).alias("cell"), "orig")
    return c.select("geocode", "cell", *hist.unflatten("cell", DIMS, SIZES), "orig")


@register("hist_sparse_vector", f"SELECT geocode, CAST(count(*) AS INTEGER) AS n, string_agg({CELL} || ':' || orig, ',' ORDER BY {CELL}) AS cells FROM cells GROUP BY geocode")
def hist_sparse_vector(spark, sf):
    v = hist.sparse_vector(cells(spark, sf).withColumn("cell", hist.flat_index(DIMS, SIZES)), ["geocode"], "cell", "orig")
    return v.select("geocode", F.size("cells").alias("n"), F.concat_ws(",", F.transform("cells", lambda x: F.concat_ws(":", x["cell"].cast("string"), x["orig"].cast("string")))).alias("cells"))


@register("hist_weighted_count", "SELECT geocode, CAST(floor(sum(CAST(round(p*100) AS BIGINT))/100.0+0.5) AS BIGINT) AS n, CAST(sum(CASE WHEN qty>=18 THEN 1 ELSE 0 END) AS BIGINT) AS adults FROM persons GROUP BY geocode")
def hist_weighted_count(spark, sf):
    p = persons(spark, sf)
    n = hist.weighted_count(p, ["geocode"], F.round(F.col("p") * 100).cast("long").cast("decimal(18,0)") / 100)
    return n.join(p.groupBy("geocode").agg(F.sum(F.when(F.col("qty") >= 18, 1).otherwise(0)).alias("adults")), "geocode")


@register("hist_units_from_persons", "SELECT substr(geocode,1,3) AS geocode, flag, count(DISTINCT unit) AS n_units FROM persons GROUP BY 1,2")
def hist_units_from_persons(spark, sf):
    return hist.units_from_persons(persons(spark, sf).withColumn("geocode", F.substring("geocode", 1, 3)), ["geocode"], ["flag"], "unit")


@register("hist_join_universes", "SELECT u.geocode, coalesce(n,0) AS n_persons, n_units FROM (SELECT geocode, count(*) AS n_units FROM units GROUP BY 1) u LEFT JOIN (SELECT geocode, count(*) AS n FROM persons WHERE status=1 GROUP BY 1) p ON u.geocode=p.geocode")
def hist_join_universes(spark, sf):
    p = persons(spark, sf).filter("status = 1").groupBy("geocode").agg(F.count("*").alias("n_persons"))
    return hist.join_universes(p, units(spark, sf).groupBy("geocode").agg(F.count("*").alias("n_units")), ["geocode"], "n_persons", "n_units")


@register("hist_add", f"SELECT geocode, {D}, CAST(sum(priv-orig) AS BIGINT) AS n FROM frame WHERE level=10 GROUP BY ALL")
def hist_add(spark, sf):
    f = frame(spark, sf).filter("level = 10")
    keys = ["geocode", *DIMS]
    return hist.combine(f.withColumnRenamed("priv", "n"), f.withColumnRenamed("orig", "n"), keys, "n", -1)


@register("hist_densify", "SELECT g.geocode, f.flag, s.status, b.band, coalesce(orig,0) AS orig FROM (SELECT DISTINCT geocode FROM cells) g CROSS JOIN (SELECT unnest([0,1,2]) AS flag) f CROSS JOIN (SELECT unnest([0,1]) AS status) s CROSS JOIN (SELECT unnest([0,1,2,3,4]) AS band) b LEFT JOIN cells c ON c.geocode=g.geocode AND c.flag=f.flag AND c.status=s.status AND c.band=b.band")
def hist_densify(spark, sf):
    return hist.densify(cells(spark, sf), ["geocode"], DIMS, SIZES, "orig")


@register("hist_roll_up", "SELECT * FROM rolled")
def hist_roll_up(spark, sf):
    return hist.roll_up(cells(spark, sf), "geocode", DIMS, LEVELS, ["orig"])


@register("hist_roll_up_offspine", "SELECT s_nationkey AS area, flag, status, band, count(*) AS orig FROM persons JOIN supplier ON s_suppkey=supplier GROUP BY ALL")
def hist_roll_up_offspine(spark, sf):
    by = hist.count_by_cell(persons(spark, sf).withColumnRenamed("supplier", "block"), ["block"], DIMS)
    walk = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("block"), F.col("s_nationkey").alias("area"))
    return hist.roll_up_offspine(by, walk, "block", "area", DIMS, ["orig"])


GEO = ["level", "geocode"]


@register("query_total", "SELECT level, geocode, CAST(sum(orig) AS BIGINT) AS orig, CAST(sum(priv) AS BIGINT) AS priv FROM frame GROUP BY ALL")
def query_total(spark, sf):
    return query.answer(frame(spark, sf), SCHEMA, "total", GEO, ["orig", "priv"])


@register("query_detailed", "SELECT level, geocode, CAST(flag AS VARCHAR) AS flag, CAST(status AS VARCHAR) AS status, CAST(band AS VARCHAR) AS band, orig FROM frame")
def query_detailed(spark, sf):
    return query.answer(frame(spark, sf), SCHEMA, "detailed", GEO, ["orig"])


@register("query_marginal", "SELECT level, geocode, flag, band, CAST(sum(orig) AS BIGINT) AS orig FROM frame GROUP BY ALL")
def query_marginal(spark, sf):
    return query.marginal(frame(spark, sf), GEO, ["flag", "band"], ["orig"])


@register("query_subset_marginal", "SELECT level, geocode, flag, band, CAST(sum(orig) AS BIGINT) AS orig FROM frame WHERE flag IN (0,2) AND band IN (1,3) GROUP BY ALL")
def query_subset_marginal(spark, sf):
    return query.subset_marginal(frame(spark, sf), GEO, {"flag": [0, 2], "band": [1, 3]}, ["orig"])


ANY_BAND = "JOIN (VALUES ('first',0),('first',1),('first',2),('last',2),('last',3),('last',4)) g(any_band,b) ON band=b"
LOW_BAND = "JOIN (VALUES ('low',0),('low',1),('high',3),('high',4)) l(low_band,lb) ON band=lb"


@register("query_grouped", f"SELECT level, geocode, any_band, CAST(sum(orig) AS BIGINT) AS orig FROM frame {ANY_BAND} GROUP BY ALL")
def query_grouped(spark, sf):
    return query.answer(frame(spark, sf), SCHEMA, "any_band", GEO, ["orig"])


@register("query_crossed", f"SELECT level, geocode, CASE WHEN flag=1 THEN 'kept' ELSE 'returned' END AS returned, low_band, CAST(sum(orig) AS BIGINT) AS orig FROM frame {LOW_BAND} GROUP BY ALL")
def query_crossed(spark, sf):
    return query.answer(frame(spark, sf), SCHEMA, "low_band * returned", GEO, ["orig"])


@register("query_kron", "SELECT level, geocode, f.r AS flag_row, b.r AS band_row, CAST(sum(orig*f.w*b.w) AS DOUBLE) AS answer FROM frame JOIN (VALUES (0,0,1.0),(0,1,0.5),(1,2,2.0)) f(r,k,w) ON flag=f.k JOIN (VALUES (0,0,1.0),(0,1,1.0),(0,2,1.0),(0,3,1.0),(0,4,1.0),(1,4,-1.0)) b(r,k,w) ON band=b.k GROUP BY ALL")
def query_kron(spark, sf):
    return query.kron(frame(spark, sf), GEO, {"flag": [[1, 0.5, 0], [0, 0, 2]], "band": [[1, 1, 1, 1, 1], [0, 0, 0, 0, -1]]}, "orig")


@register("query_predicate_count", f"SELECT level, geocode, CAST(sum(CASE WHEN {CELL} IN (1,7,20) THEN orig ELSE 0 END) AS BIGINT) AS inside, CAST(sum(CASE WHEN {CELL} IN (1,7,20) THEN 0 ELSE orig END) AS BIGINT) AS outside FROM frame GROUP BY ALL")
def query_predicate_count(spark, sf):
    return query.predicate_count(frame(spark, sf), GEO, hist.flat_index(DIMS, SIZES).isin(1, 7, 20), "orig")


@register("query_multi_histogram", "SELECT geocode, CAST(sum(v) AS DOUBLE) AS answer FROM (SELECT geocode, 1.0*count(*) AS v FROM persons GROUP BY 1 UNION ALL SELECT geocode, -2.0*count(*) FROM units GROUP BY 1) GROUP BY 1")
def query_multi_histogram(spark, sf):
    p = persons(spark, sf).groupBy("geocode").agg(F.count("*").alias("n"))
    u = units(spark, sf).groupBy("geocode").agg(F.count("*").alias("n"))
    return query.weighted_sum([(1.0, p), (-2.0, u)], ["geocode"], "n", "answer")


@register("query_combination", "SELECT level, geocode, CAST(sum(CASE WHEN flag=0 THEN 2.0*orig WHEN flag=2 THEN -1.0*orig ELSE 0 END) AS DOUBLE) AS answer FROM frame WHERE flag IN (0,2) GROUP BY ALL")
def query_combination(spark, sf):
    f = frame(spark, sf)
    a = query.subset_marginal(f, GEO, {"flag": [0]}, ["orig"]).drop("flag")
    b = query.subset_marginal(f, GEO, {"flag": [2]}, ["orig"]).drop("flag")
    return query.weighted_sum([(2.0, a), (-1.0, b)], GEO, "orig", "answer")


MANY = ["total", "flag", "flag * status", "any_band", "detailed"]
MANY_SQL = f"""many AS (SELECT level AS geolevel, geocode, 'total' AS query, 'total' AS level, orig, priv FROM frame
 UNION ALL SELECT level, geocode, 'flag', CAST(flag AS VARCHAR), orig, priv FROM frame
 UNION ALL SELECT level, geocode, 'flag * status', flag || ' BY ' || status, orig, priv FROM frame
 UNION ALL SELECT level, geocode, 'any_band', any_band, orig, priv FROM frame {ANY_BAND}
 UNION ALL SELECT level, geocode, 'detailed', flag || ' BY ' || status || ' BY ' || band, orig, priv FROM frame),
answers AS (SELECT geolevel, geocode, query, level, CAST(sum(orig) AS BIGINT) AS orig, CAST(sum(priv) AS BIGINT) AS priv FROM many GROUP BY ALL)"""


def answers(spark, sf):
    f = frame(spark, sf).withColumnRenamed("level", "geolevel")
    return query.answer_many(f, SCHEMA, MANY, ["geolevel", "geocode"], ["orig", "priv"])


@register("query_answer_many", f", {MANY_SQL} SELECT * FROM answers")
def query_answer_many(spark, sf):
    return answers(spark, sf)


@register("query_stacked", f", {MANY_SQL} SELECT * FROM answers WHERE query IN ('flag','any_band') AND level <> '1'")
def query_stacked(spark, sf):
    f = frame(spark, sf).withColumnRenamed("level", "geolevel")
    return query.answer_many(f, SCHEMA, ["flag", "any_band"], ["geolevel", "geocode"], ["orig", "priv"]).filter("level <> '1'")


@register("query_answer_sparse", "SELECT level, geocode, CAST(flag AS VARCHAR) AS flag, CAST(status AS VARCHAR) AS status, CAST(sum(priv) AS BIGINT) AS priv FROM frame GROUP BY ALL HAVING sum(priv) <> 0")
def query_answer_sparse(spark, sf):
    return query.answer(frame(spark, sf), SCHEMA, "flag * status", GEO, ["priv"]).filter("priv <> 0")


@register("query_answer_df", f", {MANY_SQL} SELECT geolevel, geocode, level AS any_band, orig, priv FROM answers WHERE query='any_band'")
def query_answer_df(spark, sf):
    return query.answer(frame(spark, sf).withColumnRenamed("level", "geolevel"), SCHEMA, "any_band", ["geolevel", "geocode"], ["orig", "priv"])


@register("query_table", f", {MANY_SQL} SELECT geocode, query, level, orig AS value FROM answers WHERE geolevel=3 AND query IN ('total','flag * status')")
def query_table(spark, sf):
    f = frame(spark, sf).filter("level = 3").drop("level")
    queries = query.expand_workload(["T1"], {"T1": ["total", "flag * status"]})
    return query.answer_many(f, SCHEMA, queries, ["geocode"], ["orig"]).withColumnRenamed("orig", "value")


@register("query_workload", "SELECT level, geocode, CAST(flag AS VARCHAR) || ' BY ' || CAST(status AS VARCHAR) AS cell, CAST(sum(orig) AS BIGINT) AS orig FROM frame GROUP BY ALL")
def query_workload(spark, sf):
    names = query.expand_workload(["W", "flag * status"], {"W": ["flag * status"]})
    f = query.answer_many(frame(spark, sf).withColumnRenamed("level", "geolevel"), SCHEMA, names, ["geolevel", "geocode"], ["orig"])
    return f.select(F.col("geolevel").alias("level"), "geocode", F.col("level").alias("cell"), "orig")


@register("query_fill_missing", f""", {MANY_SQL}, wanted AS (SELECT f || ' BY ' || s AS level FROM (SELECT unnest([0,1,2]) AS f), (SELECT unnest([0,1]) AS s))
 SELECT g.geolevel, g.geocode, 'flag * status' AS query, w.level, coalesce(orig,0) AS orig, CASE WHEN a.level IS NULL THEN 1 ELSE 0 END AS was_missing FROM (SELECT DISTINCT geolevel, geocode FROM answers) g CROSS JOIN wanted w LEFT JOIN answers a ON a.query='flag * status' AND a.level=w.level AND a.geocode=g.geocode AND a.geolevel=g.geolevel""")
def query_fill_missing(spark, sf):
    f = frame(spark, sf).withColumnRenamed("level", "geolevel")
    a = query.answer_many(f, SCHEMA, ["flag * status"], ["geolevel", "geocode"], ["orig"])
    return query.fill_missing(a, SCHEMA, ["flag * status"], ["geolevel", "geocode"], ["orig"])


@register("query_levels_shape", f", {MANY_SQL} SELECT query, CAST(CASE query WHEN 'total' THEN 1 WHEN 'flag' THEN 3 WHEN 'flag * status' THEN 6 WHEN 'any_band' THEN 2 ELSE 30 END AS INTEGER) AS size, count(DISTINCT level) AS seen FROM answers GROUP BY query")
def query_levels_shape(spark, sf):
    sizes = F.create_map(*[F.lit(x) for q in MANY for x in (q, len(SCHEMA.levels(q)))])
    return answers(spark, sf).groupBy("query").agg(F.countDistinct("level").alias("seen")).select("query", sizes[F.col("query")].alias("size"), "seen")


@register("query_sensitivity", f", {MANY_SQL} SELECT query, CAST(round(sum(orig)/(SELECT sum(orig) FROM frame WHERE level=0 AND band=2)) AS BIGINT) AS most FROM (SELECT 'any_band' AS query, orig FROM frame {ANY_BAND} WHERE level=0 AND band=2) GROUP BY query")
def query_sensitivity(spark, sf):
    """Most groups one cell counts in, with the share of answers in the data that shows it."""
    f = frame(spark, sf).filter("level = 0 and band = 2")
    seen = query.answer(f, SCHEMA, "any_band", [], ["orig"]).agg(F.count("*").alias("n"))
    return seen.select(F.lit("any_band").alias("query"), F.least(F.col("n"), F.lit(SCHEMA.sensitivity("any_band"))).alias("most"))


NAMED_GROUPS = {
    "low_band": ("band", {"low": [0, 1], "high": [3, 4]}), "returned": ("flag", {"returned": [0, 2], "kept": [1]}), "any_band": ("band", {"first": [0, 1, 2], "last": [2, 3, 4]}),
}


def names_sql() -> str:
    """One and two parts that share no dim, each counted at the root."""
    dim = {d: d for d in DIMS} | {r: d for r, (d, _) in NAMED_GROUPS.items()}
    place = {d: i for i, d in enumerate(DIMS)}
    found = [[], *[[p] for p in dim], *[sorted((p, q), key=lambda x: place[dim[x]]) for i, p in enumerate(dim) for q in list(dim)[i + 1 :] if dim[p] != dim[q]]]
    out = [f"SELECT 'detailed' AS query, count(*) AS levels, CAST(sum(orig) AS BIGINT) AS orig FROM (SELECT {D}, sum(orig) AS orig FROM frame WHERE level=0 GROUP BY ALL)"]
    for parts in found:
        labels = {p: f"l{i}.label" if p in NAMED_GROUPS else p for i, p in enumerate(parts)}
        joins = " ".join(f"JOIN (VALUES {', '.join(f"('{label}',{k})" for label, members in NAMED_GROUPS[p][1].items() for k in members)}) l{i}(label,k) ON frame.{dim[p]}=l{i}.k" for i, p in enumerate(parts) if p in NAMED_GROUPS)
        columns = ", ".join(f"{labels[p]} AS p{i}" for i, p in enumerate(parts)) or "1 AS p0"
        out.append(f"SELECT '{' * '.join(parts) or 'total'}', count(*), CAST(sum(orig) AS BIGINT) FROM (SELECT {columns}, sum(orig) AS orig FROM frame {joins} WHERE level=0 GROUP BY ALL)")
    return " UNION ALL ".join(out)


@register("query_names", names_sql())
def query_names(spark, sf):
    """Catalogue of the schema's queries, with what each answers over the whole table."""
    root = frame(spark, sf).filter("level = 0").drop("level")
    names = [n for n in SCHEMA.names() if n.count("*") < 2]
    return query.answer_many(root, SCHEMA, names, [], ["orig"]).groupBy("query").agg(F.count("*").alias("levels"), F.sum("orig").alias("orig"))


@register("recode_merge_dims", "SELECT level AS geolevel, geocode, flag || ' BY ' || status || ' BY ' || band AS level, orig FROM frame")
def recode_merge_dims(spark, sf):
    return query.merge_dims(frame(spark, sf).drop("priv").withColumnRenamed("level", "geolevel"), DIMS)
