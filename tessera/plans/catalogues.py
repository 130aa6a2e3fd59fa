"""Registered queries: schemas, workloads, layouts, constraints and types given as tables, which Spark derives from the given ones and reads back from files."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import catalogue, constraints, query
from tessera.plans.base import persons, register, table
from tessera.sources import files

# brands are a dim; makers group them, and the first words of their parts' types do so with overlaps
BRANDS = "br AS (SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand)-1 AS INTEGER) AS brand FROM (SELECT DISTINCT p_brand FROM part)), gr AS (SELECT DISTINCT brand, 'Maker'||substr(p_brand,7,1) AS maker, split_part(p_type,' ',1) AS word FROM part JOIN br USING (p_brand)), li AS (SELECT brand, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flag, count(*) AS n FROM lineitem JOIN part ON l_partkey=p_partkey JOIN br USING (p_brand) GROUP BY ALL)"


def flag():
    return F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag")


def brands(spark, sf):
    names = table(spark, sf, "part").select("p_brand").distinct()
    return names.select("p_brand", (F.dense_rank().over(W.orderBy("p_brand")) - 1).alias("brand"))


def groups(spark, sf):
    """(recode, dim, place, label, level) of makers and words."""
    p = table(spark, sf, "part").join(brands(spark, sf), "p_brand")
    one = lambda name, label: p.select(F.lit(name).alias("recode"), F.lit("brand").alias("dim"), label.alias("label"), F.col("brand").alias("level")).distinct()
    both = one("maker", F.concat(F.lit("Maker"), F.substring("p_brand", 7, 1))).unionByName(one("word", F.split("p_type", " ")[0]))
    return both.withColumn("place", F.dense_rank().over(W.partitionBy("recode").orderBy("label")))


def schema(spark, sf):
    dims = brands(spark, sf).agg(F.count("*").alias("size")).select(F.lit("brand").alias("dim"), F.lit(0).alias("place"), "size")
    dims = dims.unionByName(table(spark, sf, "lineitem").select("l_returnflag").distinct().agg(F.count("*").alias("size")).select(F.lit("flag").alias("dim"), F.lit(1).alias("place"), "size"))
    return catalogue.load_schema(files.kept(dims, "dims"), files.kept(groups(spark, sf), "groups"))


def cells(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).join(brands(spark, sf), "p_brand")
    return li.select("brand", flag()).groupBy("brand", "flag").agg(F.count("*").alias("n"))


MARGINS = ["maker * flag", "word", "total"]
LEVELS_SQL = f"WITH {BRANDS}, mk AS (SELECT DISTINCT brand, maker FROM gr), wd AS (SELECT DISTINCT brand, word FROM gr), an AS (SELECT 'maker * flag' AS query, maker||' BY '||flag AS level, CAST(sum(n) AS BIGINT) AS n FROM li JOIN mk USING (brand) GROUP BY ALL UNION ALL SELECT 'word', word, CAST(sum(n) AS BIGINT) FROM li JOIN wd USING (brand) GROUP BY ALL UNION ALL SELECT 'total', 'total', CAST(sum(n) AS BIGINT) FROM li) "


def answers(spark, sf, s):
    plan = spark.createDataFrame([("margins", i, q) for i, q in enumerate(MARGINS)], "workload string, place int, query string")
    work = catalogue.load_workloads(files.kept(plan, "workloads"), s)
    return query.answer_many(cells(spark, sf), s, query.expand_workload(["margins"], work), [], ["n"])


@register("catalogue_workload", LEVELS_SQL + "SELECT * FROM an", base=False)
def catalogue_workload(spark, sf):
    """A workload read from a table, answered under a schema read from tables."""
    return answers(spark, sf, schema(spark, sf))


@register("catalogue_limits", LEVELS_SQL + "SELECT 'share' AS constraint, query, level, n, NULL::BIGINT AS lower, lim AS upper FROM an, (SELECT CAST(sum(n)//15 AS BIGINT) AS lim FROM li) WHERE query='maker * flag' AND n>lim", base=False)
def catalogue_limits(spark, sf):
    """Answers above their limits: no pair of maker and flag may have more than a fifteenth of all."""
    s = schema(spark, sf)
    most = cells(spark, sf).agg(F.floor(F.sum("n") / 15).alias("upper"))
    limits = query.with_levels(most, s, ["maker * flag"]).select(F.lit("share").alias("constraint"), "query", "level", F.lit(None).cast("long").alias("lower"), "upper")
    return catalogue.failing_limits(answers(spark, sf, s), files.kept(limits, "limits"), [], "n")


@register("catalogue_zeros", f"WITH {BRANDS}, mk AS (SELECT brand, max(maker) AS maker FROM gr GROUP BY 1) SELECT rule, CAST(sum(n) AS BIGINT) AS n FROM (SELECT 'first' AS rule, n FROM li JOIN mk USING (brand) WHERE maker='Maker1' AND flag IN (0,2) UNION ALL SELECT 'second', n FROM li WHERE flag=1) GROUP BY 1", base=False)
def catalogue_zeros(spark, sf):
    """Counts in cells that rules from a table call impossible."""
    rules = spark.createDataFrame([("first", "maker", "Maker1"), ("first", "flag", "0"), ("first", "flag", "2"), ("second", "flag", "1")], "rule string, part string, label string")
    return constraints.structural_zeros(cells(spark, sf), [], catalogue.load_zeros(files.kept(rules, "rules"), schema(spark, sf)), "n")


@register("catalogue_layout", "SELECT c_custkey AS unit, c_mktsegment AS segment, c_nationkey AS nation FROM customer", base=False)
def catalogue_layout(spark, sf):
    """Fixed-width lines written and read by a layout from a table; a value outside its legal ones fails."""
    from tessera.operators import checks

    plan = spark.createDataFrame([("unit", 1, "unit", 10, "bigint", "0-9999999999"), ("unit", 2, "segment", 12, "string", "AUTOMOBILE,BUILDING,FURNITURE,HOUSEHOLD,MACHINERY"), ("unit", 3, "nation", 2, "int", "0-24")], "layout string, place int, field string, width int, type string, legal string")
    fields, legal = catalogue.load_layouts(files.kept(plan, "layouts"))["unit"]
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    path = files.scratch(spark, "fixed")
    c.select(F.concat(*[F.rpad(F.col(name).cast("string"), width, " ") for name, _, width, _ in fields])).write.text(path)
    back = files.read_fixed_width(spark, path, fields)
    if bad := checks.layout_counts(back, legal).filter("illegal > 0").collect():
        raise ValueError(f"illegal values: {bad}")
    return back


NORMS = f"""WITH {BRANDS}, wd AS (SELECT DISTINCT brand, word FROM gr), cell AS (SELECT brand, flag FROM br, (SELECT unnest([0,1,2]) AS flag)),
 w AS (SELECT * FROM (VALUES ('all',0,1.0),('all',1,1.0),('all',2,1.0),('twice',0,2.0),('half',1,0.5)) x(r,k,w)),
 q AS (SELECT 'maker * flag' AS query, brand, flag, 1.0 AS l1, 1.0 AS s2, true AS whole FROM cell
 UNION ALL SELECT 'word', c.brand, c.flag, count(*), count(*), true FROM cell c JOIN wd USING (brand) GROUP BY ALL
 UNION ALL SELECT 'word * weights', c.brand, c.flag, sum(w), sum(w*w), false FROM cell c JOIN wd USING (brand) JOIN w ON c.flag=w.k GROUP BY ALL) """


@register("query_column_norms", NORMS + "SELECT query, CAST(max(l1) AS DOUBLE) AS l1, round(CAST(sqrt(max(s2)) AS DOUBLE),9) AS l2, min(whole) AS whole, min(whole) AND max(l1)=1 AS gaussian FROM q GROUP BY query", base=False)
def query_column_norms(spark, sf):
    """Sensitivities from the groups' tables, against the greatest column over all cells."""
    g = groups(spark, sf)
    rows = lambda q, f, weight: f.select(F.lit(q).alias("query"), "dim", F.col("label").alias("row"), "level", weight.alias("weight"))
    flags = spark.createDataFrame([("flag", str(k), k) for k in range(3)], "dim string, label string, level int")
    weights = spark.createDataFrame([("flag", "all", 0, 1.0), ("flag", "all", 1, 1.0), ("flag", "all", 2, 1.0), ("flag", "twice", 0, 2.0), ("flag", "half", 1, 0.5)], "dim string, label string, level int, weight double")
    one, words = F.lit(1.0), g.filter("recode = 'word'")
    parts = [rows("maker * flag", g.filter("recode = 'maker'"), one), rows("maker * flag", flags, one), rows("word", words, one), rows("word * weights", words, one), rows("word * weights", weights, F.col("weight"))]
    all_rows = parts[0]
    for p in parts[1:]:
        all_rows = all_rows.unionByName(p)
    return catalogue.sensitivities(all_rows).withColumn("l2", F.round("l2", 9))


#: Twenty flags of a unit's persons: SQL conditions, true for one of them at least.
FLAGS = {
    **{f"age{k}": f"qty BETWEEN {a} AND {b}" for k, (a, b) in enumerate(((1, 5), (6, 11), (12, 17), (18, 29), (30, 39), (40, 44), (45, 48), (49, 50)))},
    **{f"prio{k}": f"prio = {k}" for k in range(5)}, "open": "ostatus = 'O'", "part": "ostatus = 'P'", "done": "ostatus = 'F'", "kept": "flag = 1", "back": "flag = 0", "late": "status = 1", "cheap": "p >= 0.1",
}
#: Types by the flags that they ask for; flags not named fit any value.
TYPES = [
    (1, {}), (2, {"age0": 1}), (3, {"age0": 1, "age7": 0}), (4, {"age0": 1, "age7": 0, "prio2": 1}), (5, {"open": 0}), (6, {"open": 0, "part": 1}), (7, {"age7": 1, "cheap": 1}), (8, {"age7": 1, "cheap": 1, "late": 0}),
    (9, {"prio0": 0}), (10, {"prio0": 0, "prio1": 0}), (11, {"back": 0, "kept": 1, "age6": 1}), (12, {"age2": 0, "age3": 0}), (13, {"part": 1, "late": 1, "done": 1, "age6": 0}), (14, {"age1": 0, "age4": 1, "prio4": 1}),
]
TYPE_ROWS = ", ".join(f"({k},{len(FLAGS) - len(f)},{','.join(str(f.get(x, 'NULL')) for x in FLAGS)})" for k, f in TYPES)
FITS = " AND ".join(f"(t.{x} IS NULL OR t.{x}=u.{x})" for x in FLAGS)


@register("recode_type_by_flags", f", u AS (SELECT unit, {', '.join(f'CAST(max(CASE WHEN {c} THEN 1 ELSE 0 END) AS INTEGER) AS {x}' for x, c in FLAGS.items())} FROM persons GROUP BY 1), t AS (SELECT * FROM (VALUES {TYPE_ROWS}) v(type,free,{','.join(FLAGS)})), r AS (SELECT u.unit, t.type, row_number() OVER (PARTITION BY u.unit ORDER BY free, type) AS k FROM u JOIN t ON {FITS}) SELECT u.unit, r.type FROM u LEFT JOIN r ON u.unit=r.unit AND k=1")
def recode_type_by_flags(spark, sf):
    """Type of a unit from twenty flags by a table with entries for any value: the most specific row that fits."""
    u = persons(spark, sf).groupBy("unit").agg(*[F.max(F.when(F.expr(c), 1).otherwise(0)).alias(x) for x, c in FLAGS.items()])
    t = spark.createDataFrame([(k, *[f.get(x) for x in FLAGS]) for k, f in TYPES], "type int, " + ", ".join(f"{x} int" for x in FLAGS))
    return catalogue.by_flags(u, list(FLAGS), files.kept(t, "types"), "type").select("unit", "type")
