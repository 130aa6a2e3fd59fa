"""Registered queries: joins, constraints, checks, and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import checks, constraints, hist, joins, partition
from tessera.plans.base import DIMS, SIZES, frame, persons, protected, cells, register, table, units




@register("join_person_unit_inner", "SELECT l_orderkey AS orderkey, l_linenumber AS line, o_custkey AS unit, o_orderstatus AS status FROM lineitem JOIN orders ON l_orderkey=o_orderkey")
def join_person_unit_inner(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("unit"), F.col("o_orderstatus").alias("status"))
    return joins.attach_units(li, o, "orderkey")


@register("join_unit_geography_left", "SELECT c_custkey AS unit, c_nationkey AS block, n_name AS geocode FROM customer LEFT JOIN nation ON c_nationkey=n_nationkey")
def join_unit_geography_left(spark, sf):
    u = table(spark, sf, "customer").select(F.col("c_custkey").alias("unit"), F.col("c_nationkey").alias("block"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("block"), F.col("n_name").alias("geocode"))
    return joins.attach_geography(u, n, "block", "geocode")


P_BY = "(SELECT geocode, count(*) AS n FROM persons WHERE status=1 AND flag=1 AND band=4 GROUP BY 1)"
U_BY = "(SELECT geocode, count(*) AS m FROM units GROUP BY 1)"


def by_geo(spark, sf):
    p = persons(spark, sf).filter("status = 1 and flag = 1 and band = 4").groupBy("geocode").agg(F.count("*").alias("n"))
    return p, units(spark, sf).groupBy("geocode").agg(F.count("*").alias("m"))


@register("join_right_outer_units", f"SELECT u.geocode, coalesce(n,0) AS n, m FROM {P_BY} p RIGHT JOIN {U_BY} u ON p.geocode=u.geocode")
def join_right_outer_units(spark, sf):
    return joins.outer_fill(*by_geo(spark, sf), ["geocode"], ["n", "m"], "right")


@register("join_full_outer_tables", "SELECT coalesce(a.k,b.k) AS k, coalesce(n,0) AS n, coalesce(m,0) AS m FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus='P' GROUP BY 1) a FULL JOIN (SELECT c_custkey AS k, count(*) AS m FROM customer WHERE c_mktsegment='BUILDING' GROUP BY 1) b ON a.k=b.k")
def join_full_outer_tables(spark, sf):
    a = table(spark, sf, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    b = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").groupBy(F.col("c_custkey").alias("k")).agg(F.count("*").alias("m"))
    return joins.outer_fill(a, b, ["k"], ["n", "m"])


@register("join_protected_truth_full", "SELECT geocode, flag, status, band, orig, priv FROM frame WHERE level=10 AND (orig<>0 OR priv<>0)")
def join_protected_truth_full(spark, sf):
    f = frame(spark, sf).filter("level = 10")
    keys = ["geocode", *DIMS]
    return joins.outer_fill(f.filter("orig <> 0").select(*keys, "orig"), f.filter("priv <> 0").select(*keys, "priv"), keys, ["orig", "priv"])


@register("join_crosswalk_inner", "SELECT s_nationkey AS area, flag, count(*) AS n FROM persons JOIN supplier ON supplier=s_suppkey GROUP BY ALL")
def join_crosswalk_inner(spark, sf):
    by = hist.count_by_cell(persons(spark, sf), ["supplier"], ["flag"], "n")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("area"))
    return joins.attach_units(by, s, "supplier").groupBy("area", "flag").agg(F.sum("n").alias("n"))


@register("join_denominator", "SELECT f.level, f.geocode, f.flag, f.status, f.band, orig, denominator FROM frame f JOIN (SELECT level, geocode, CAST(sum(orig) AS BIGINT) AS denominator FROM frame GROUP BY ALL) d ON f.level=d.level AND f.geocode=d.geocode")
def join_denominator(spark, sf):
    f = frame(spark, sf).drop("priv")
    return joins.with_denominator(f, f.groupBy("level", "geocode").agg(F.sum("orig").alias("t")), ["level", "geocode"], "t")


@register("join_geo_left_outer", "SELECT p.geocode, n, r_name AS name FROM (SELECT substr(geocode,1,1) AS geocode, count(*) AS n FROM persons GROUP BY 1) p LEFT JOIN region ON p.geocode=CAST(r_regionkey AS VARCHAR)")
def join_geo_left_outer(spark, sf):
    p = persons(spark, sf).groupBy(F.substring("geocode", 1, 1).alias("geocode")).agg(F.count("*").alias("n"))
    return p.join(table(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("geocode"), F.col("r_name").alias("name")), "geocode", "left")


@register("join_anti_occupied", "SELECT DISTINCT geocode FROM units WHERE unit NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus='P')")
def join_anti_occupied(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("unit"))
    return units(spark, sf).join(o, "unit", "left_anti").select("geocode").distinct()


@register("join_semi_reference", "SELECT s_suppkey AS id FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey=1)")
def join_semi_reference(spark, sf):
    n = table(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, sf, "supplier").join(n, "s_nationkey", "left_semi").select(F.col("s_suppkey").alias("id"))


@register("join_parent_children", "SELECT c.geocode, p.geocode AS parent, c.n, p.n AS parent_n FROM (SELECT geocode, CAST(sum(orig) AS BIGINT) AS n FROM frame WHERE level=5 GROUP BY 1) c JOIN (SELECT geocode, CAST(sum(orig) AS BIGINT) AS n FROM frame WHERE level=3 GROUP BY 1) p ON substr(c.geocode,1,3)=p.geocode")
def join_parent_children(spark, sf):
    t = frame(spark, sf).filter("level in (3, 5)").groupBy("level", "geocode").agg(F.sum("orig").alias("n"))
    return joins.parent_children(t, "geocode", 3, 5, "level", ["n"]).select("geocode", "parent", "n", "parent_n")


@register("join_histogram_invariants", "SELECT f.geocode, flag, status, band, priv, m AS units FROM frame f JOIN (SELECT geocode, count(*) AS m FROM units GROUP BY 1) u ON f.geocode=u.geocode WHERE level=10")
def join_histogram_invariants(spark, sf):
    inv = units(spark, sf).groupBy("geocode").agg(F.count("*").alias("units"))
    return joins.attach_units(protected(cells(spark, sf)).select("geocode", *DIMS, "priv"), inv, "geocode")


@register("join_compound_key_full", "SELECT coalesce(a.geocode,b.geocode) AS geocode, coalesce(a.k,b.k) AS kind, coalesce(n,0) AS n_left, coalesce(m,0) AS n_right, coalesce(m,0)-coalesce(n,0) AS difference FROM (SELECT geocode, flag AS k, count(*) AS n FROM persons WHERE status=0 GROUP BY ALL) a FULL JOIN (SELECT geocode, flag AS k, count(*) AS m FROM persons WHERE status=1 GROUP BY ALL) b ON a.geocode=b.geocode AND a.k=b.k")
def join_compound_key_full(spark, sf):
    p = persons(spark, sf).withColumnRenamed("flag", "kind")
    return joins.compare_counts(p.filter("status = 0"), p.filter("status = 1"), ["geocode", "kind"])


INV = """, p AS (SELECT geocode, count(*) AS t, CAST(sum(CASE WHEN qty>=18 THEN 1 ELSE 0 END) AS BIGINT) AS a FROM persons GROUP BY 1) """


@register("inv_make", INV + "SELECT geocode, 'total' AS name, t AS value FROM p UNION ALL SELECT geocode,'adults',a FROM p UNION ALL SELECT geocode,'units',count(*) FROM units GROUP BY 1 UNION ALL SELECT geocode,'units:'||unit_type,count(*) FROM units GROUP BY geocode, unit_type")
def inv_make(spark, sf):
    return constraints.invariants(persons(spark, sf), units(spark, sf), "geocode", "unit_type", F.col("qty") >= 18)


@register("cons_total", INV + "SELECT substr(geocode,1,3) AS geocode, CAST(sum(t) AS BIGINT) AS total, CAST(sum(a) AS BIGINT) AS adults FROM p GROUP BY 1")
def cons_total(spark, sf):
    i = constraints.invariants(persons(spark, sf), units(spark, sf), "geocode", "unit_type", F.col("qty") >= 18).filter("name in ('total', 'adults')").withColumnRenamed("value", "rhs")
    up = constraints.add_up(i, "geocode", 3, ["name"])
    one = lambda n: F.sum(F.when(F.col("name") == n, F.col("rhs"))).alias(n)
    return up.groupBy("geocode").agg(one("total"), one("adults"))


FAC = """, f AS (SELECT substr(geocode,1,5) AS geocode, unit_type, count(*) AS n FROM units GROUP BY ALL), t AS (SELECT substr(geocode,1,5) AS geocode, count(*) AS total FROM persons GROUP BY 1),
 g AS (SELECT f.*, total, count(*) OVER (PARTITION BY f.geocode) AS k, sum(n) OVER (PARTITION BY f.geocode) AS al FROM f JOIN t ON f.geocode=t.geocode),
 b AS (SELECT geocode, unit_type, n, CAST(CASE WHEN k=1 THEN total ELSE n END AS BIGINT) AS lower, CAST(least(total-(al-n), n*99999) AS BIGINT) AS upper FROM g) """


def tract_bounds(spark, sf):
    tract = F.substring("geocode", 1, 5)
    t = persons(spark, sf).groupBy(tract.alias("geocode")).agg(F.count("*").alias("total"))
    return constraints.facility_bounds(units(spark, sf).withColumn("geocode", tract), t, "geocode", "unit_type", "total")


@register("cons_facility_bounds", FAC + "SELECT * FROM b")
def cons_facility_bounds(spark, sf):
    return tract_bounds(spark, sf)


@register("cons_add_up", FAC + "SELECT substr(geocode,1,3) AS geocode, unit_type, CAST(sum(lower) AS BIGINT) AS rhs FROM b GROUP BY 1,2")
def cons_add_up(spark, sf):
    return constraints.add_up(tract_bounds(spark, sf).withColumnRenamed("lower", "rhs"), "geocode", 3, ["unit_type"])


@register("cons_tighten", FAC + ", s AS (SELECT substr(geocode,1,3) AS geocode, unit_type, CAST(sum(lower) AS BIGINT) AS lo, CAST(sum(n) AS BIGINT) AS n FROM b GROUP BY 1,2) SELECT geocode, unit_type, 'ge' AS sign, greatest(n, lo) AS rhs FROM s")
def cons_tighten(spark, sf):
    b = tract_bounds(spark, sf).withColumn("sign", F.lit("ge"))
    keys = ["unit_type", "sign"]
    own = constraints.add_up(b.withColumnRenamed("n", "rhs"), "geocode", 3, keys)
    return constraints.tighten(own, constraints.add_up(b.withColumnRenamed("lower", "rhs"), "geocode", 3, keys), ["geocode", "unit_type"])


@register("cons_structural_zeros_person", "SELECT level, geocode, 'kept_closed' AS rule, CAST(sum(priv) AS BIGINT) AS priv FROM frame WHERE priv>0 AND flag=1 AND status=0 GROUP BY ALL UNION ALL SELECT level, geocode, 'open_returned_small', CAST(sum(priv) AS BIGINT) FROM frame WHERE priv>0 AND flag<>1 AND status=1 AND band=0 GROUP BY ALL")
def cons_structural_zeros_person(spark, sf):
    rules = {"kept_closed": (F.col("flag") == 1) & (F.col("status") == 0), "open_returned_small": (F.col("flag") != 1) & (F.col("status") == 1) & (F.col("band") == 0)}
    return constraints.structural_zeros(frame(spark, sf), ["level", "geocode"], rules, "priv")


@register("cons_unit_linked_bounds", "SELECT u.geocode, coalesce(p.n,0) AS value, 20*m AS rhs, 'le' AS sign FROM (SELECT substr(geocode,1,5) AS geocode, count(*) AS m FROM units GROUP BY 1) u LEFT JOIN (SELECT substr(geocode,1,5) AS geocode, count(*) AS n FROM persons GROUP BY 1) p ON p.geocode=u.geocode WHERE coalesce(p.n,0)>20*m+0.001")
def cons_unit_linked_bounds(spark, sf):
    tract = F.substring("geocode", 1, 5).alias("geocode")
    rhs = units(spark, sf).groupBy(tract).agg((20 * F.count("*")).alias("rhs")).withColumn("sign", F.lit("le"))
    return checks.constraint_failures(persons(spark, sf).groupBy(tract).agg(F.count("*").alias("value")), rhs, ["geocode"])


@register("check_constraints", "SELECT geocode, CAST(sum(priv) AS BIGINT) AS value, CAST(sum(orig) AS BIGINT) AS rhs, '=' AS sign FROM frame WHERE level=3 GROUP BY 1 HAVING sum(priv)<>sum(orig)")
def check_constraints(spark, sf):
    t = frame(spark, sf).filter("level = 3").groupBy("geocode").agg(F.sum("priv").alias("value"), F.sum("orig").alias("rhs"))
    return checks.constraint_failures(t.select("geocode", "value"), t.select("geocode", "rhs", F.lit("=").alias("sign")), ["geocode"])


@register("check_record_layout", """SELECT 'l_linenumber' AS "column", '1-7' AS allowed, CAST(sum(CASE WHEN l_linenumber BETWEEN 1 AND 7 THEN 0 ELSE 1 END) AS BIGINT) AS illegal FROM lineitem UNION ALL SELECT 'l_returnflag','A,N', CAST(sum(CASE WHEN l_returnflag IN ('A','N') THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem UNION ALL SELECT 'l_quantity','1-45', CAST(sum(CASE WHEN l_quantity BETWEEN 1 AND 45 THEN 0 ELSE 1 END) AS BIGINT) FROM lineitem""")
def check_record_layout(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("int"))
    return checks.layout_counts(li, {"l_linenumber": "1-7", "l_returnflag": "A,N", "l_quantity": "1-45"})


@register("recode_legal_values", "SELECT l_orderkey AS orderkey, l_returnflag AS value FROM lineitem WHERE l_returnflag NOT IN ('A','N')")
def recode_legal_values(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.filter(~checks.legal("l_returnflag", "A,N")).select(F.col("l_orderkey").alias("orderkey"), F.col("l_returnflag").alias("value"))


@register("check_record_rules_person", "SELECT orderkey, unit, run, qty, broken FROM (SELECT orderkey, unit, run, qty, concat_ws(',', CASE WHEN qty>45 AND flag=1 THEN 'large_kept' END, CASE WHEN prio=0 AND status=1 THEN 'urgent_open' END) AS broken FROM persons) WHERE broken<>''")
def check_record_rules_person(spark, sf):
    rules = {"large_kept": (F.col("qty") > 45) & (F.col("flag") == 1), "urgent_open": (F.col("prio") == 0) & (F.col("status") == 1)}
    return checks.failing_rules(persons(spark, sf), ["orderkey", "unit", "run", "qty"], rules)


@register("check_record_rules_household", "SELECT unit, n, broken FROM (SELECT unit, n, concat_ws(',', CASE WHEN n=1 AND t='BUILDING' THEN 'alone' END, CASE WHEN n>60 THEN 'large' END) AS broken FROM (SELECT unit, max(unit_type) AS t, count(*) AS n FROM persons GROUP BY 1)) WHERE broken<>''")
def check_record_rules_household(spark, sf):
    u = persons(spark, sf).groupBy("unit").agg(F.max("unit_type").alias("t"), F.count("*").alias("n"))
    return checks.failing_rules(u, ["unit", "n"], {"alone": (F.col("n") == 1) & (F.col("t") == "BUILDING"), "large": F.col("n") > 60})


@register("check_total_records", "SELECT 'all' AS what, (SELECT count(*) FROM persons) AS truth, (SELECT count(*) FROM lineitem) AS output, (SELECT count(*) FROM persons)=(SELECT count(*) FROM lineitem) AS ok")
def check_total_records(spark, sf):
    w = F.lit("all").alias("what")
    return checks.totals({"truth": persons(spark, sf).select(w), "output": table(spark, sf, "lineitem").select(w)}, ["what"])


@register("check_ids_in_reference", "SELECT DISTINCT o_custkey AS unit FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment<>'MACHINERY')")
def check_ids_in_reference(spark, sf):
    ref = table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("unit"))
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("unit")).distinct().join(ref, "unit", "left_anti")


@register("check_unit_counts_by_type", "SELECT geocode, unit_type, CAST(sum(a) AS BIGINT) AS units, CAST(sum(b) AS BIGINT) AS active, sum(a)=sum(b) AS ok FROM (SELECT substr(geocode,1,3) AS geocode, unit_type, 1 AS a, CASE WHEN unit IN (SELECT o_custkey FROM orders) THEN 1 ELSE 0 END AS b FROM units) GROUP BY ALL")
def check_unit_counts_by_type(spark, sf):
    u = units(spark, sf).withColumn("geocode", F.substring("geocode", 1, 3))
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("unit")).distinct()
    return checks.totals({"units": u.select("geocode", "unit_type"), "active": u.join(o, "unit", "left_semi").select("geocode", "unit_type")}, ["geocode", "unit_type"])


@register("check_occupied_rules", "SELECT o_orderkey AS unit, broken FROM (SELECT o_orderkey, concat_ws(',', CASE WHEN o_totalprice<1000 THEN 'cheap' END, CASE WHEN o_orderstatus NOT IN ('F','O') THEN 'status' END) AS broken FROM orders) WHERE broken<>''")
def check_occupied_rules(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "unit")
    return checks.failing_rules(o, ["unit"], {"cheap": F.col("o_totalprice") < 1000, "status": ~F.col("o_orderstatus").isin("F", "O")})


@register("check_persons_ge_facilities", "SELECT f.geocode, f.unit_type, coalesce(p.n,0) AS value, f.m AS rhs, 'ge' AS sign FROM (SELECT geocode, unit_type, 30*count(*) AS m FROM units GROUP BY ALL) f LEFT JOIN (SELECT geocode, unit_type, count(*) AS n FROM persons GROUP BY ALL) p ON p.geocode=f.geocode AND p.unit_type=f.unit_type WHERE coalesce(p.n,0)<f.m-0.001")
def check_persons_ge_facilities(spark, sf):
    keys = ["geocode", "unit_type"]
    rhs = units(spark, sf).groupBy(*keys).agg((30 * F.count("*")).alias("rhs")).withColumn("sign", F.lit("ge"))
    return checks.constraint_failures(persons(spark, sf).groupBy(*keys).agg(F.count("*").alias("value")), rhs, keys)


@register("check_max_per_unit", "SELECT p.geocode, n AS value, 60*m AS rhs, 'le' AS sign FROM (SELECT geocode, count(*) AS n FROM persons GROUP BY 1) p JOIN (SELECT geocode, count(*) AS m FROM units GROUP BY 1) u ON p.geocode=u.geocode WHERE n>60*m")
def check_max_per_unit(spark, sf):
    rhs = units(spark, sf).groupBy("geocode").agg((60 * F.count("*")).alias("rhs")).withColumn("sign", F.lit("le"))
    return checks.constraint_failures(persons(spark, sf).groupBy("geocode").agg(F.count("*").alias("value")), rhs, ["geocode"])


@register("check_state_totals", "SELECT geocode, CAST(sum(orig) AS BIGINT) AS orig, CAST(sum(priv) AS BIGINT) AS priv, sum(orig)=sum(priv) AS ok FROM frame WHERE level=1 GROUP BY 1")
def check_state_totals(spark, sf):
    t = frame(spark, sf).filter("level = 1").groupBy("geocode").agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    return t.withColumn("ok", F.col("orig") == F.col("priv"))


@register("check_not_invariant", "SELECT CAST(sum(CASE WHEN o<>p THEN 1 ELSE 0 END) AS BIGINT) AS n_different, sum(CASE WHEN o<>p THEN 1 ELSE 0 END)>0 AS ok FROM (SELECT geocode, sum(orig) AS o, sum(priv) AS p FROM frame WHERE level=10 GROUP BY 1)")
def check_not_invariant(spark, sf):
    f = frame(spark, sf).filter("level = 10")
    return checks.must_differ(f.groupBy("geocode").agg(F.sum("orig").alias("n")), f.groupBy("geocode").agg(F.sum("priv").alias("n")), ["geocode"], "n")


@register("check_equal_frames", "SELECT CAST(sum(greatest(d,0)) AS BIGINT) AS only_left, CAST(sum(greatest(-d,0)) AS BIGINT) AS only_right FROM (SELECT geocode, flag, sum(CASE WHEN status=0 THEN 1 ELSE -1 END) AS d FROM persons GROUP BY ALL)")
def check_equal_frames(spark, sf):
    p = persons(spark, sf)
    return checks.equal_frames(p.filter("status = 0").select("geocode", "flag"), p.filter("status = 1").select("geocode", "flag"))


@register("check_level", "SELECT level, count(*) AS n_cells, CAST(sum(CASE WHEN priv<0 THEN 1 ELSE 0 END) AS BIGINT) AS negative, sum(CASE WHEN priv<0 THEN 1 ELSE 0 END)=0 AS ok FROM frame GROUP BY level")
def check_level(spark, sf):
    neg = F.sum(F.when(F.col("priv") < 0, 1).otherwise(0))
    return frame(spark, sf).groupBy("level").agg(F.count("*").alias("n_cells"), neg.alias("negative")).withColumn("ok", F.col("negative") == 0)


@register("ops_sort_output", "SELECT geocode, flag, status, band, orig FROM cells ORDER BY geocode, flag, status, band")
def ops_sort_output(spark, sf):
    return cells(spark, sf).sort("geocode", *DIMS)


@register("ops_limit_sample", "SELECT geocode, flag, status, band, orig FROM cells ORDER BY orig DESC, geocode, flag, status, band LIMIT 20")
def ops_limit_sample(spark, sf):
    """A top-20 report: TakeOrdered per partition, then one merge."""
    return cells(spark, sf).orderBy(F.desc("orig"), "geocode", *DIMS).limit(20)


@register("ops_union_by_name", "SELECT geocode, 'open' AS run_id, count(*) AS n FROM persons WHERE status=1 GROUP BY 1 UNION ALL SELECT geocode, 'closed', count(*) FROM persons WHERE status=0 GROUP BY 1")
def ops_union_by_name(spark, sf):
    p = persons(spark, sf)
    part = lambda s, name: p.filter(F.col("status") == s).groupBy("geocode").agg(F.count("*").alias("n")).withColumn("run_id", F.lit(name))
    return part(1, "open").unionByName(part(0, "closed"))


@register("ops_subtract", "SELECT DISTINCT c_mktsegment AS level, c_nationkey AS area FROM customer WHERE c_mktsegment NOT LIKE '%MACH%'")
def ops_subtract(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("level"), F.col("c_nationkey").alias("area"))
    return c.subtract(c.filter(F.col("level").contains("MACH")))


@register("ops_except_all", "SELECT geocode, flag FROM persons WHERE status=0 EXCEPT ALL SELECT geocode, flag FROM persons WHERE status=1")
def ops_except_all(spark, sf):
    p = persons(spark, sf)
    return p.filter("status = 0").select("geocode", "flag").exceptAll(p.filter("status = 1").select("geocode", "flag"))


@register("ops_distinct", "SELECT DISTINCT unit_type, flag, status FROM persons")
def ops_distinct(spark, sf):
    return persons(spark, sf).select("unit_type", "flag", "status").distinct()


@register("ops_repartition_even", f"SELECT part, count(*) AS n_rows, min(position) AS first, max(position) AS last, min(geocode) AS least FROM (SELECT geocode, position, CAST(floor(position*16/(SELECT count(*) FROM cells)) AS INTEGER) AS part FROM (SELECT geocode, row_number() OVER (ORDER BY geocode, {', '.join(DIMS)})-1 AS position FROM cells)) GROUP BY part")
def ops_repartition_even(spark, sf):
    """Contiguous partitions of nearly equal size in the order of the keys: what each holds."""
    n = partition.even(cells(spark, sf), ["geocode", *DIMS], 16)
    return partition.sizes(n, "part", "position", F.min("geocode").alias("least"))


@register("ops_partitions_per_key", "SELECT count(DISTINCT substr(geocode,1,3)) AS keys, count(*) AS n_rows, 1::BIGINT AS most FROM cells")
def ops_partitions_per_key(spark, sf):
    """Dealt by parent, each parent's rows stand in one partition."""
    c = cells(spark, sf).withColumn("parent", F.substring("geocode", 1, 3)).repartition("parent")
    p = partition.per_key(c, ["parent"])
    return p.agg(F.count("*").alias("keys"), F.sum("n_rows").alias("n_rows"), F.max("partitions").alias("most"))


@register("fn_string", "SELECT c_custkey AS id, lpad(CAST(c_custkey AS VARCHAR),8,'0') AS padded, reverse(c_mktsegment) AS back, substr(c_mktsegment,2,3) AS part, length(c_name) AS n, concat_ws('-', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS joined, starts_with(c_mktsegment,'B') AS b, split_part(c_name,'#',2) AS tail FROM customer", base=False)
def fn_string(spark, sf):
    c = table(spark, sf, "customer")
    s = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("id"), F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"), F.reverse(s).alias("back"), F.substring(s, 2, 3).alias("part"), F.length("c_name").cast("long").alias("n"),
        F.concat_ws("-", s, F.col("c_nationkey").cast("string")).alias("joined"), s.startswith("B").alias("b"), F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("tail"),
    )


@register("fn_math", "SELECT o_orderkey AS id, round(sqrt(o_totalprice),6) AS root, round(ln(1+abs(o_totalprice)),6) AS l, round(log10(1+abs(o_totalprice)),6) AS l10, CAST(floor(o_totalprice/1000) AS BIGINT) AS k, CAST(sign(o_totalprice-150000) AS DOUBLE) AS s, o_custkey % 7 AS m, greatest(o_custkey, 100) AS g FROM orders", base=False)
def fn_math(spark, sf):
    x = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.round(F.sqrt(x), 6).alias("root"), F.round(F.log(1 + F.abs(x)), 6).alias("l"), F.round(F.log10(1 + F.abs(x)), 6).alias("l10"), F.floor(x / 1000).cast("long").alias("k"),
        F.signum(x - 150000).alias("s"), (F.col("o_custkey") % 7).alias("m"), F.greatest(F.col("o_custkey"), F.lit(100)).alias("g"),
    )


@register("fn_conditional", "SELECT o_orderkey AS id, CASE WHEN o_orderstatus IN ('F','P') THEN 'done' WHEN o_totalprice BETWEEN 1000 AND 100000 THEN 'open small' ELSE 'open large' END AS kind, coalesce(nullif(o_orderstatus,'O'),'none') AS filled FROM orders", base=False)
def fn_conditional(spark, sf):
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.when(s.isin("F", "P"), "done").when(F.col("o_totalprice").between(1000, 100000), "open small").otherwise("open large").alias("kind"), F.coalesce(F.nullif(s, F.lit("O")), F.lit("none")).alias("filled"))


@register("fn_array_map", "SELECT unit, string_agg(DISTINCT CAST(flag AS VARCHAR), ',' ORDER BY CAST(flag AS VARCHAR)) AS flags, count(DISTINCT band) AS n_bands FROM persons GROUP BY unit")
def fn_array_map(spark, sf):
    g = persons(spark, sf).groupBy("unit").agg(F.sort_array(F.collect_set("flag")).alias("f"), F.collect_set("band").alias("b"))
    return g.select("unit", F.array_join(F.transform("f", lambda x: x.cast("string")), ",").alias("flags"), F.size("b").cast("long").alias("n_bands"))


@register("fn_cast", "SELECT c_custkey AS id, TRY_CAST(split_part(c_name,'#',2) AS BIGINT) AS number, TRY_CAST(c_mktsegment AS BIGINT) AS bad, CAST(c_acctbal AS VARCHAR) IS NOT NULL AS ok FROM customer", base=False)
def fn_cast(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr("try_cast(split_part(c_name, '#', 2) as bigint)").alias("number"), F.expr("try_cast(c_mktsegment as bigint)").alias("bad"), F.col("c_acctbal").cast("string").isNotNull().alias("ok"))
