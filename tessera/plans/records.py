"""Registered queries: recodes, sources, sinks and user functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions import recode
from tessera.operators import hist, metrics, order, resample
from tessera.plans.base import DIMS, SIZES, cells, frame, persons, register, table, units
from tessera.plans.privacy import uniform_sql
from tessera.sources import files


@register("recode_apply", "SELECT orderkey, run, qty, CASE WHEN flag=0 THEN 'a' WHEN flag=1 THEN 'n' END AS kind FROM persons WHERE flag<2")
def recode_apply(spark, sf):
    p = persons(spark, sf)
    return recode.apply_recodes(p, {"kind": F.when(F.col("flag") == 0, "a").when(F.col("flag") == 1, "n")}).select("orderkey", "run", "qty", "kind")


FLAGS = "CASE WHEN p_size%2=0 THEN 1 ELSE 0 END AS a, CASE WHEN p_size%3=0 THEN 1 ELSE 0 END AS b, CASE WHEN p_size%5=0 THEN 1 ELSE 0 END AS c"


def flags(spark, sf):
    bit = lambda n: F.when(F.col("p_size") % n == 0, 1).otherwise(0)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), bit(2).alias("a"), bit(3).alias("b"), bit(5).alias("c"))


@register("recode_race_combination", f"SELECT id, a, b, c, CAST(CASE WHEN a+b+c=1 THEN CASE WHEN a=1 THEN 0 WHEN b=1 THEN 1 ELSE 2 END WHEN a+b+c=2 THEN CASE WHEN c=0 THEN 3 WHEN b=0 THEN 4 ELSE 5 END WHEN a+b+c=3 THEN 6 END AS INTEGER) AS race FROM (SELECT p_partkey AS id, {FLAGS} FROM part)", base=False)
def recode_race_combination(spark, sf):
    return flags(spark, sf).withColumn("race", recode.combination_index(["a", "b", "c"]))


@register("recode_race_groups", f"SELECT grp, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN a=1 THEN 'a' END, CASE WHEN b=1 THEN 'b' END, CASE WHEN c=1 THEN 'c' END], lambda x: x IS NOT NULL)) AS grp FROM (SELECT {FLAGS} FROM part)) GROUP BY 1", base=False)
def recode_race_groups(spark, sf):
    return flags(spark, sf).select(F.explode(recode.groups_alone_or_combined(["a", "b", "c"])).alias("grp")).groupBy("grp").agg(F.count("*").alias("n"))


@register("recode_age_bands", "SELECT orderkey, run, qty, CAST(CASE WHEN qty<5 THEN 0 WHEN qty<18 THEN 1 WHEN qty<40 THEN 2 ELSE 3 END AS INTEGER) AS band, CAST(CASE WHEN qty>=18 THEN 1 ELSE 0 END AS INTEGER) AS voting, least(qty,45) AS top FROM persons")
def recode_age_bands(spark, sf):
    q = F.col("qty")
    return persons(spark, sf).select("orderkey", "run", "qty", recode.bands(q, [0, 5, 18, 40]).alias("band"), recode.bands(q, [0, 18]).alias("voting"), recode.topcode(q, 45).alias("top"))


SIZE = "(SELECT unit, count(*) AS n FROM persons GROUP BY 1)"


def sizes(spark, sf):
    return persons(spark, sf).groupBy("unit").agg(F.count("*").alias("n"))


@register("recode_size_topcode", f"SELECT unit, n, CASE WHEN n>=10 THEN least(n,70) END AS size FROM {SIZE}")
def recode_size_topcode(spark, sf):
    return sizes(spark, sf).withColumn("size", recode.topcode(F.col("n"), 70, 10))


FACILITIES = ["BUILDING", "MACHINERY"]


@register("recode_relationship_gq", f"SELECT orderkey, run, qty, CAST(CASE unit_type WHEN 'BUILDING' THEN 5 WHEN 'MACHINERY' THEN 6 ELSE CASE WHEN prio=0 THEN CASE WHEN n=1 THEN 0 ELSE 1 END WHEN prio<=3 THEN 1+prio END END AS INTEGER) AS code FROM persons JOIN {SIZE} s ON persons.unit=s.unit")
def recode_relationship_gq(spark, sf):
    """Relationship in households, alone or not by the unit's population; kind of facility elsewhere."""
    j = persons(spark, sf).join(sizes(spark, sf), "unit")
    facility = F.when(F.col("unit_type").isin(FACILITIES), F.col("unit_type"))
    return j.select("orderkey", "run", "qty", recode.relationship_or_facility(F.col("prio"), facility, F.col("n"), 3, FACILITIES).alias("code"))


@register("recode_facility_8level", "SELECT p_partkey AS id, CASE WHEN p_size%10=0 THEN 0 ELSE least(CAST(substr(CAST(p_size*20 AS VARCHAR),1,1) AS INTEGER),7) END AS level FROM part", base=False)
def recode_facility_8level(spark, sf):
    first = F.substring((F.col("p_size") * 20).cast("string"), 1, 1).cast("int")
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 10 == 0, 0).otherwise(recode.topcode(first, 7)).alias("level"))


@register("recode_unit_type", "SELECT c_custkey AS unit, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'FURNITURE' THEN 3 END AS INTEGER) AS type FROM customer", base=False)
def recode_unit_type(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("unit"), recode.lookup(F.col("c_mktsegment"), {"BUILDING": 1, "MACHINERY": 2, "FURNITURE": 3}).alias("type"))


PRES = "(SELECT unit, max(CASE WHEN qty<6 THEN 1 ELSE 0 END) AS young, max(CASE WHEN qty BETWEEN 6 AND 17 THEN 1 ELSE 0 END) AS older, max(qty) AS oldest FROM persons GROUP BY 1)"


def presence(spark, sf):
    q = F.col("qty")
    return persons(spark, sf).groupBy("unit").agg(F.max(F.when(q < 6, 1).otherwise(0)).alias("young"), F.max(F.when(q.between(6, 17), 1).otherwise(0)).alias("older"), F.max(q).alias("oldest"))


@register("recode_household_person_presence", f"SELECT unit, young, older, CAST(CASE WHEN young=1 AND older=1 THEN 3 WHEN young=1 THEN 1 WHEN older=1 THEN 2 ELSE 0 END AS INTEGER) AS children FROM {PRES}")
def recode_household_person_presence(spark, sf):
    return presence(spark, sf).select("unit", "young", "older", (F.col("young") + 2 * F.col("older")).cast("int").alias("children"))


@register("recode_elderly_presence", f"SELECT unit, CAST(CASE WHEN oldest>=49 THEN 3 WHEN oldest>=45 THEN 2 WHEN oldest>=40 THEN 1 ELSE 0 END AS INTEGER) AS elderly FROM {PRES}")
def recode_elderly_presence(spark, sf):
    return presence(spark, sf).select("unit", recode.bands(F.col("oldest"), [0, 40, 45, 49]).alias("elderly"))


FLAGS = "young*12+older*6+CASE WHEN oldest>=45 THEN 3 ELSE 0 END+unit%3"


@register("recode_household_type_lookup", f"SELECT unit, CASE WHEN ({FLAGS})%5<>4 THEN ({FLAGS})*7%24 END AS type FROM {PRES}")
def recode_household_type_lookup(spark, sf):
    """Four flags packed into one key of 24 values; the table of types lacks some."""
    key = recode.packed([F.col("young"), F.col("older"), F.when(F.col("oldest") >= 45, 1).otherwise(0), (F.col("unit") % 3).cast("int")], [2, 2, 2, 3])
    types = spark.createDataFrame([(k, k * 7 % 24) for k in range(24) if k % 5 != 4], "key int, type int")
    return recode.by_table(presence(spark, sf), key, types, "type", "type").select("unit", "type")


@register("recode_type_from_marginals", f"SELECT unit, CAST(CASE WHEN young=1 AND older=1 THEN 4 WHEN young=1 THEN 2 WHEN older=1 THEN 3 END AS INTEGER) AS type FROM {PRES}")
def recode_type_from_marginals(spark, sf):
    return presence(spark, sf).select("unit", recode.candidates({"young": {1: [2, 4], 0: [3]}, "older": {1: [3, 4], 0: [2]}}).alias("type"))


@register("recode_citizen_race_12", "SELECT orderkey, run, qty, CASE WHEN prio<4 THEN CAST(status*6+CASE WHEN prio=3 THEN 5 ELSE prio+flag%2 END AS INTEGER) END AS race12 FROM persons")
def recode_citizen_race_12(spark, sf):
    """File codes are remapped by a table, then crossed with origin: twelve levels, null for codes that the table lacks."""
    remap = {p * 3 + f: 5 if p == 3 else p + f % 2 for p in range(4) for f in range(3)}
    race = recode.lookup(F.col("prio") * 3 + F.col("flag"), remap)
    return persons(spark, sf).select("orderkey", "run", "qty", recode.origin_and_race(F.col("status"), race, 6).alias("race12"))


@register("recode_historic_1940", "SELECT orderkey, run, qty, CAST(CASE prio WHEN 1 THEN 0 WHEN 2 THEN 1 END AS INTEGER) AS sex, least(qty,40) AS age, CAST(CASE WHEN flag=0 THEN 0 ELSE 1 END AS INTEGER) AS citizen, CAST(CASE WHEN qty<10 THEN 0 WHEN qty<30 THEN 1 ELSE 2 END AS INTEGER) AS school, CAST(status*3+flag AS INTEGER) AS origin_race FROM persons WHERE prio IN (1,2)")
def recode_historic_1940(spark, sf):
    """The old file's codes: sex from 1 and 2, ages topped, citizenship, schooling in bands, origin by race; rows with other sexes go."""
    return recode.apply_recodes(
        persons(spark, sf),
        {
            "sex": recode.lookup(F.col("prio"), {1: 0, 2: 1}), "age": recode.topcode(F.col("qty"), 40), "citizen": F.when(F.col("flag") == 0, 0).otherwise(1),
            "school": recode.bands(F.col("qty"), [0, 10, 30]), "origin_race": recode.origin_and_race(F.col("status"), F.col("flag"), 3),
        },
    ).filter("sex is not null").select("orderkey", "run", "qty", "sex", "age", "citizen", "school", "origin_race")


@register("recode_from_output_layout", "SELECT geocode, CASE l WHEN 'F' THEN 0 ELSE 1 END AS status, count(*) AS n FROM (SELECT geocode, CASE status WHEN 0 THEN 'F' ELSE 'O' END AS l FROM persons) GROUP BY ALL")
def recode_from_output_layout(spark, sf):
    out = recode_output_person(spark, sf)
    return out.groupBy("geocode", F.when(F.col("line_status") == "F", 0).otherwise(1).alias("status")).agg(F.count("*").alias("n"))


@register("recode_output_person", "SELECT geocode, CASE flag WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS return_flag, CASE status WHEN 0 THEN 'F' ELSE 'O' END AS line_status, lpad(CAST(band AS VARCHAR),2,'0') AS band, '000' AS filler FROM persons")
def recode_output_person(spark, sf):
    return files.expand(cells(spark, sf), "orig").select(
        "geocode", recode.level_labels(F.col("flag"), ["A", "N", "R"]).alias("return_flag"), recode.level_labels(F.col("status"), ["F", "O"]).alias("line_status"), F.lpad(F.col("band").cast("string"), 2, "0").alias("band"), recode.filler("string", 3, True).alias("filler")
    )


@register("recode_output_household", f"SELECT unit, CASE WHEN young=1 THEN '1' ELSE '0' END||CASE WHEN older=1 THEN '1' ELSE '0' END AS children, '99' AS tenure FROM {PRES}")
def recode_output_household(spark, sf):
    return presence(spark, sf).select("unit", F.concat(F.col("young").cast("string"), F.col("older").cast("string")).alias("children"), recode.filler("string", 2, False).alias("tenure"))


# a household's codes from its persons: quantities stand for ages, times 1.8
HOUSE = """, hh AS (SELECT unit, count(*) AS size, max(CASE WHEN qty<4 THEN 1 ELSE 0 END)+2*max(CASE WHEN qty BETWEEN 4 AND 9 THEN 1 ELSE 0 END) AS children, CASE WHEN count(*)>1 THEN unit%5 ELSE 0 END AS couple, max(CASE WHEN prio=4 THEN 1 ELSE 0 END) AS relatives,
 max(CASE WHEN qty<10 THEN 1 ELSE 0 END)+max(CASE WHEN qty BETWEEN 10 AND 30 THEN 1 ELSE 0 END)+max(CASE WHEN qty>30 THEN 1 ELSE 0 END) AS generations, 1+unit%2 AS sex, CAST(floor(max(qty)*1.8) AS INTEGER) AS oldest, CAST(floor(min(qty)*1.8) AS INTEGER) AS age, sum(CASE WHEN qty>=10 THEN 1 ELSE 0 END) AS adults
 FROM (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY orderkey, run, qty) AS nth FROM persons) WHERE nth<=unit%7+1 GROUP BY unit),
 k AS (SELECT *, CASE WHEN size>1 THEN children ELSE 0 END AS kids, size>1 AND (couple IN (1,2) OR relatives=1 OR children>0) AS fam FROM hh) """


def households(spark, sf):
    from pyspark.sql import Window as W

    nth = F.row_number().over(W.partitionBy("unit").orderBy("orderkey", "run", "qty"))
    p = persons(spark, sf).withColumn("nth", nth).filter(F.col("nth") <= F.col("unit") % 7 + 1)
    any_ = lambda c: F.max(F.when(c, 1).otherwise(0))
    q = F.col("qty")
    return p.groupBy("unit").agg(
        F.count("*").alias("size"), (any_(q < 4) + 2 * any_(q.between(4, 9))).alias("children"), any_(F.col("prio") == 4).alias("relatives"), (any_(q < 10) + any_(q.between(10, 30)) + any_(q > 30)).alias("generations"),
        F.floor(F.max(q) * 1.8).cast("int").alias("oldest"), F.floor(F.min(q) * 1.8).cast("int").alias("age"), F.sum(F.when(q >= 10, 1).otherwise(0)).alias("adults"),
    ).withColumns({"couple": F.when(F.col("size") > 1, F.col("unit") % 5).otherwise(0), "sex": 1 + F.col("unit") % 2})


def house_flags():
    return recode.household_flags(*[F.col(c) for c in ("children", "couple", "relatives", "size", "generations")])


FLAG_SQL = {
    "child_under_6_only": "kids=1", "child_6_to_17_only": "kids=2", "child_both": "kids=3", "no_child": "kids=0", "no_partner": "couple=0", "married_opposite": "couple=1", "married_same": "couple=2", "cohabiting_opposite": "couple=3", "cohabiting_same": "couple=4",
    "married": "couple IN (1,2)", "cohabiting": "couple IN (3,4)", "with_relatives": "size>1 AND relatives=1", "family": "fam", "alone": "size=1", "not_alone": "size>1", "three_generations": "generations>=3", "couple_with_child": "couple>0 AND kids>0",
    "couple_without_child": "couple>0 AND kids=0", "single_with_child": "couple=0 AND kids>0", "others_only": "size>1 AND NOT fam AND couple=0",
}


@register("recode_household_flags", HOUSE + f"SELECT unit, {', '.join(f'CAST({c} AS INTEGER) AS {n}' for n, c in FLAG_SQL.items())} FROM k")
def recode_household_flags(spark, sf):
    """Twenty flags of households: children, couples, relatives, size and generations."""
    return households(spark, sf).select("unit", *[c.alias(n) for n, c in house_flags().items()])


@register("recode_published_household", HOUSE + """SELECT unit, CASE WHEN couple IN (1,2) THEN '1' WHEN fam THEN CASE WHEN sex=1 THEN '2' ELSE '3' END WHEN sex=1 THEN CASE WHEN size=1 THEN '4' ELSE '5' END ELSE CASE WHEN size=1 THEN '6' ELSE '7' END END AS hht,
 CASE WHEN couple IN (1,2) THEN CASE WHEN kids>0 THEN '1' ELSE '2' END WHEN couple>2 THEN CASE WHEN kids>0 THEN '3' ELSE '4' END WHEN sex=1 THEN CASE WHEN size=1 THEN '5' ELSE '6' END ELSE CASE WHEN size=1 THEN '7' ELSE '8' END END AS hht2,
 CASE WHEN couple=0 THEN '5' ELSE CAST(couple AS VARCHAR) END AS cplt, CASE WHEN couple>2 THEN CAST(sex AS VARCHAR) ELSE '5' END AS upart, CASE WHEN generations>=3 THEN '2' ELSE '1' END AS multg, CAST(kids AS VARCHAR) AS paoc,
 lpad(CAST(CASE WHEN age>=75 THEN 9 WHEN age>=65 THEN 8 WHEN age>=60 THEN 7 WHEN age>=55 THEN 6 WHEN age>=45 THEN 5 WHEN age>=35 THEN 4 WHEN age>=25 THEN 3 WHEN age>=15 THEN 2 ELSE 1 END AS VARCHAR),2,'0') AS hhldrage,
 CASE WHEN adults>0 THEN '2' ELSE '1' END AS p18, CASE WHEN oldest>=60 THEN '2' ELSE '1' END AS p60, CASE WHEN oldest>=65 THEN '2' ELSE '1' END AS p65, CASE WHEN oldest>=75 THEN '2' ELSE '1' END AS p75, CAST(sex AS VARCHAR) AS hhsex FROM k""")
def recode_published_household(spark, sf):
    """Published codes of households from their flags, the householder and the ages of their persons."""
    codes = recode.published_household(house_flags(), F.col("sex"), F.col("age"), F.col("oldest"), F.col("adults"))
    return households(spark, sf).select("unit", *[c.alias(n) for n, c in codes.items()])


@register("recode_fill_not_in_universe", "SELECT c_custkey AS unit, 0 AS zero, 999 AS nines, '00' AS text FROM customer", base=False)
def recode_fill_not_in_universe(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("unit"), recode.filler("int", 3, True).alias("zero"), recode.filler("int", 3, False).alias("nines"), recode.filler("string", 2, True).alias("text"))


@register("recode_level_labels", "SELECT geocode, CASE flag WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE '-1' END AS label, orig FROM cells")
def recode_level_labels(spark, sf):
    return cells(spark, sf).select("geocode", recode.level_labels(F.col("flag"), ["A", "N"]).alias("label"), "orig")


@register("recode_strip_agg_names", "SELECT geocode, CAST(sum(orig) AS BIGINT) AS orig, CAST(max(band) AS INTEGER) AS band FROM cells GROUP BY 1")
def recode_strip_agg_names(spark, sf):
    g = cells(spark, sf).groupBy("geocode").agg({"orig": "sum", "band": "max"})
    return g.toDF(*[c.partition("(")[2].rstrip(")") or c for c in g.columns])


PERSON = "geocode string, flag int, status int, band int"
CELL = "((flag*2+status)*5+band)"


@register("io_read_delimited", "SELECT geocode, flag, status, band FROM persons")
def io_read_delimited(spark, sf):
    path = files.scratch(spark, "delimited")
    files.write_delimited(persons(spark, sf).select("geocode", *DIMS), path)
    return files.read_delimited(spark, path, PERSON)


@register("io_read_pipe_comments", "SELECT geocode, flag, status, band FROM persons WHERE flag<>0")
def io_read_pipe_comments(spark, sf):
    path = files.scratch(spark, "comments")
    mark = F.when(F.col("flag") == 0, "#").otherwise("")
    persons(spark, sf).select(F.concat(mark, F.concat_ws("|", "geocode", *[F.col(d).cast("string") for d in DIMS])).alias("value")).write.text(path)
    return files.read_delimited(spark, path, PERSON, header=False, comment="#")


LAYOUT = [("geocode", 1, 10, "string"), ("flag", 11, 1, "int"), ("status", 12, 1, "int"), ("band", 13, 2, "int")]


@register("io_read_fixed_width", "SELECT geocode, flag, status, band FROM persons")
def io_read_fixed_width(spark, sf):
    path = files.scratch(spark, "fixed")
    files.write_fixed_width(persons(spark, sf), path, LAYOUT)
    return files.read_fixed_width(spark, path, LAYOUT)


TYPES = {
    "H": [("geocode", 2, 10, "string"), ("unit", 12, 8, "int"), ("size", 20, 6, "int")],
    "P": [("geocode", 2, 10, "string"), ("unit", 12, 8, "int"), ("qty", 20, 6, "int")],
}


@register("io_read_record_type", "SELECT 'H' AS kind, u.geocode, u.unit, count(p.unit) AS number FROM units u LEFT JOIN persons p ON p.unit=u.unit GROUP BY ALL HAVING count(p.unit)>0 UNION ALL SELECT 'P', geocode, unit, qty FROM persons")
def io_read_record_type(spark, sf):
    """Household and person lines in one file, each read by its own layout; only households that hold persons are kept."""
    path = files.scratch(spark, "types")
    line = lambda kind, number: F.concat(F.lit(kind), F.rpad("geocode", 10, " "), F.rpad(F.col("unit").cast("string"), 8, " "), F.rpad(F.col(number).cast("string"), 6, " ")).alias("value")
    p = persons(spark, sf)
    size = units(spark, sf).join(p.groupBy("unit").agg(F.count("*").alias("size")), "unit", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    size.select(line("H", "size")).union(p.select(line("P", "qty"))).write.text(path)
    found = files.read_record_types(spark, path, TYPES)
    h = found["H"].filter("size > 0").select(F.lit("H").alias("kind"), "geocode", "unit", F.col("size").alias("number"))
    return h.union(found["P"].select(F.lit("P"), "geocode", "unit", "qty")).withColumn("number", F.col("number").cast("long"))


@register("io_filter_test_area", "SELECT geocode, count(*) AS n FROM persons WHERE geocode LIKE '2%' GROUP BY 1")
def io_filter_test_area(spark, sf):
    return persons(spark, sf).filter(F.col("geocode").startswith("2")).groupBy("geocode").agg(F.count("*").alias("n"))


@register("io_read_geo_reference", "SELECT unit AS oidtb, geocode FROM units")
def io_read_geo_reference(spark, sf):
    """A block reference file of code parts, some lines twice: parts are put together to the working code, and a part that is null fails."""
    path = files.scratch(spark, "reference")
    u = units(spark, sf).select(F.col("unit").alias("oidtb"), *[F.substring("geocode", at, n).alias(c) for c, at, n in (("state", 1, 1), ("county", 2, 2), ("tract", 4, 2), ("block", 6, 5))])
    files.write_delimited(u.union(u.filter("oidtb % 3 = 0")), path)
    r = files.read_delimited(spark, path, "oidtb long, state string, county string, tract string, block string")
    return files.required(r, ["oidtb", "state", "county", "tract", "block"]).select("oidtb", F.concat("state", "county", "tract", "block").alias("geocode")).distinct()


@register("io_read_crosswalk_map", "SELECT c_custkey AS unit, coalesce(s.n,'none') AS primgeo FROM customer LEFT JOIN (SELECT s_nationkey AS k, CAST(count(*) AS VARCHAR) AS n FROM supplier WHERE s_nationkey%2=0 GROUP BY 1) s ON c_nationkey=k", base=False)
def io_read_crosswalk_map(spark, sf):
    """Codes by a map file that lacks some keys."""
    path = files.scratch(spark, "map")
    s = table(spark, sf, "supplier").filter("s_nationkey % 2 = 0").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count("*").cast("string").alias("primgeo"))
    files.write_delimited(s, path)
    c = files.read_mapped(spark, table(spark, sf, "customer").select("c_custkey", "c_nationkey"), path, "c_nationkey", "primgeo", "none")
    return c.select(F.col("c_custkey").alias("unit"), "primgeo")


@register("io_read_land_area", "SELECT p_partkey AS id, round(CAST(p_retailprice*1000000 AS DOUBLE)/2589988,6) AS land, round(CAST(p_size*1000000 AS DOUBLE)/2589988,6) AS water, round(CAST(p_retailprice*1000000 AS DOUBLE)/2589988+CAST(p_size*1000000 AS DOUBLE)/2589988,6) AS area FROM part", base=False)
def io_read_land_area(spark, sf):
    path = files.scratch(spark, "areas")
    files.write_delimited(table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") * 1000000).cast("double").alias("land"), (F.col("p_size") * 1000000).cast("double").alias("water")), path)
    return files.read_areas(spark, path, "id").select("id", *[F.round(c, 6).alias(c) for c in ("land", "water", "area")])


@register("io_read_noisy_by_level", "SELECT level, geocode, flag, status, band, priv FROM frame WHERE level IN (1,3)")
def io_read_noisy_by_level(spark, sf):
    """Saved measurements partitioned by level; the level filter prunes folders."""
    path = files.scratch(spark, "noisy")
    frame(spark, sf).drop("orig").write.partitionBy("level").parquet(path)
    return spark.read.parquet(path).filter(F.col("level").isin(1, 3)).select("level", "geocode", *DIMS, "priv")


@register("io_read_synthetic_as_raw", "SELECT geocode, flag, status, band, priv AS orig FROM frame WHERE level=10 AND priv>0")
def io_read_synthetic_as_raw(spark, sf):
    """Written records read as new input: no required field is null, and counts by geocode equal the invariants saved beside them."""
    out, saved = files.scratch(spark, "synthetic"), files.scratch(spark, "invariants")
    protected = frame(spark, sf).filter("level = 10")
    files.write_delimited(files.expand(protected.select("geocode", *DIMS, "priv"), "priv"), out)
    protected.filter("priv > 0").groupBy("geocode").agg(F.sum("priv").alias("total")).write.parquet(saved)
    records = files.read_as_raw(files.read_delimited(spark, out, PERSON), ["geocode", *DIMS], ["geocode"], spark.read.parquet(saved), "total")
    return hist.count_by_cell(records, ["geocode"], DIMS)


@register("io_read_experiment_runs", "SELECT geocode, flag, status, band, n, run_id, plb, budget_group FROM (SELECT geocode, flag, status, band, orig AS n, 'a' AS run_id, 1.0::DOUBLE AS plb, 'low' AS budget_group FROM frame WHERE level=10 UNION ALL SELECT geocode, flag, status, band, priv, 'b', 4.0::DOUBLE, 'high' FROM frame WHERE level=10)")
def io_read_experiment_runs(spark, sf):
    """Two runs, each saved by itself, read as one frame."""
    f = frame(spark, sf).filter("level = 10")
    runs = {name: (files.scratch(spark, f"run-{name}"), plb, group) for name, plb, group in (("a", 1.0, "low"), ("b", 4.0, "high"))}
    for (path, *_), value in zip(runs.values(), ("orig", "priv")):
        f.select(F.col(value).alias("n"), *DIMS, "geocode").write.parquet(path)
    return files.read_runs(spark, runs, ["geocode", *DIMS, "n"])


@register("io_read_state_from_path", "SELECT 'v'||substr(geocode,1,1) AS state, count(*) AS n FROM persons GROUP BY 1")
def io_read_state_from_path(spark, sf):
    """The state is the last part of each file's name, as in unit_counts_v3.txt."""
    path = files.scratch(spark, "states")
    p = persons(spark, sf).select("geocode")
    files.write_named(p, path, F.concat(F.lit("unit_counts_v"), F.substring("geocode", 1, 1), F.lit(".txt")))
    return spark.read.option("recursiveFileLookup", "true").text(path).groupBy(files.file_part().alias("state")).agg(F.count("*").alias("n"))


@register("sink_microdata", "SELECT geocode, flag, status, band FROM frame, unnest(generate_series(1, priv)) WHERE level=10")
def sink_microdata(spark, sf):
    path = files.scratch(spark, "microdata")
    records = files.expand(frame(spark, sf).filter("level = 10").select("geocode", *DIMS, "priv"), "priv")
    files.write_delimited(records, path)
    return files.read_delimited(spark, path, PERSON)


@register("sink_microdata_numbered", "SELECT geocode, flag, status, band, row_number() OVER (ORDER BY geocode, flag, status, band)-1 AS epnum FROM persons")
def sink_microdata_numbered(spark, sf):
    return files.numbered_records(cells(spark, sf), "orig", ["geocode", *DIMS])


@register("sink_household_units", "SELECT t.geocode, CAST(n-coalesce(h,0) AS BIGINT) AS n FROM (SELECT substr(geocode,1,3) AS geocode, count(*) AS n FROM units GROUP BY 1) t LEFT JOIN (SELECT substr(geocode,1,3) AS geocode, count(DISTINCT unit) AS h FROM persons WHERE ostatus='P' GROUP BY 1) p ON t.geocode=p.geocode WHERE n-coalesce(h,0)>0")
def sink_household_units(spark, sf):
    """Vacant rows beside households: as many as the difference of the two counts."""
    state = F.substring("geocode", 1, 3).alias("geocode")
    h = persons(spark, sf).filter("ostatus = 'P'").select(state, "unit").distinct()
    t = units(spark, sf).groupBy(state).agg(F.count("*").alias("t"))
    return files.expand(files.residual_units(h, t, ["geocode"], "t"), "n").groupBy("geocode").agg(F.count("*").alias("n"))


@register("sink_household_rows", "SELECT geocode, 'household' AS kind, count(DISTINCT unit) AS n FROM (SELECT substr(geocode,1,3) AS geocode, unit FROM persons WHERE ostatus='P' AND unit_type NOT IN ('BUILDING','MACHINERY')) GROUP BY 1 UNION ALL SELECT t.geocode, 'vacant', CAST(n-coalesce(h,0) AS BIGINT) FROM (SELECT substr(geocode,1,3) AS geocode, count(*) AS n FROM units WHERE unit_type NOT IN ('BUILDING','MACHINERY') GROUP BY 1) t LEFT JOIN (SELECT substr(geocode,1,3) AS geocode, count(DISTINCT unit) AS h FROM persons WHERE ostatus='P' AND unit_type NOT IN ('BUILDING','MACHINERY') GROUP BY 1) p ON t.geocode=p.geocode WHERE n-coalesce(h,0)>0 UNION ALL SELECT substr(geocode,1,3), 'facility '||unit_type, count(*) FROM units WHERE unit_type IN ('BUILDING','MACHINERY') GROUP BY ALL")
def sink_household_rows(spark, sf):
    """Household records, a row for each vacant unit and one for each facility of each type, written as one file and counted from it."""
    state, facility = F.substring("geocode", 1, 3).alias("geocode"), F.col("unit_type").isin("BUILDING", "MACHINERY")
    u, path = units(spark, sf), files.scratch(spark, "units")
    h = persons(spark, sf).filter(~facility).filter("ostatus = 'P'").select(state, "unit").distinct()
    t = u.filter(~facility).groupBy(state).agg(F.count("*").alias("t"))
    vacant = files.expand(files.residual_units(h, t, ["geocode"], "t"), "n").select("geocode", F.lit("vacant").alias("kind"))
    rows = h.select("geocode", F.lit("household").alias("kind")).unionByName(vacant)
    rows = rows.unionByName(u.filter(facility).select(state, F.concat(F.lit("facility "), "unit_type").alias("kind")))
    files.write_delimited(rows, path)
    return files.read_delimited(spark, path, "geocode string, kind string").groupBy("geocode", "kind").agg(F.count("*").alias("n"))


@register("sink_occupancy_counts", "SELECT geocode, count(*)-count(DISTINCT o_custkey) AS vacant_count, count(DISTINCT o_custkey) AS occupied_count FROM units LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus='P') ON o_custkey=unit GROUP BY 1")
def sink_occupancy_counts(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("unit")).distinct().withColumn("occ", F.lit(1))
    u = units(spark, sf).join(o, "unit", "left").withColumn("occ", F.coalesce("occ", F.lit(0)))
    return u.groupBy("geocode").agg(F.sum(1 - F.col("occ")).cast("long").alias("vacant_count"), F.sum("occ").cast("long").alias("occupied_count"))


@register("sink_cap_to_reference", "SELECT geocode, flag, status, band, least(priv, orig) AS priv FROM frame WHERE level=10")
def sink_cap_to_reference(spark, sf):
    f = frame(spark, sf).filter("level = 10")
    keys = ["geocode", *DIMS]
    return files.cap(f.select(*keys, "priv"), f.select(*keys, F.col("orig").alias("priv")), keys, "priv")


@register("sink_reallocate_tenure", "SELECT unit, unit_type, geocode3, CASE WHEN unit_type<>'BUILDING' THEN NULL WHEN r<=2 THEN 'mortgage' ELSE 'owned' END AS tenure FROM (SELECT unit, unit_type, substr(geocode,1,3) AS geocode3, row_number() OVER (PARTITION BY substr(geocode,1,3), unit_type='BUILDING' ORDER BY unit) AS r FROM units)")
def sink_reallocate_tenure(spark, sf):
    u = units(spark, sf).withColumn("geocode3", F.substring("geocode", 1, 3)).drop("geocode")
    k = u.select("geocode3").distinct().withColumn("k", F.lit(2))
    return files.reallocate(u, k, ["geocode3"], F.col("unit_type") == "BUILDING", ["unit"], "mortgage", "owned", "tenure").select("unit", "unit_type", "geocode3", "tenure")


@register("sink_reallocate_pairs", "SELECT unit, unit_type, geocode3, CASE unit_type WHEN 'BUILDING' THEN CASE WHEN r<=n//3 THEN 'mortgage' ELSE 'owned' END WHEN 'FURNITURE' THEN CASE WHEN r<=n-1 THEN 'rented' ELSE 'no pay' END END AS tenure FROM (SELECT unit, unit_type, substr(geocode,1,3) AS geocode3, row_number() OVER w AS r, count(*) OVER (PARTITION BY substr(geocode,1,3), unit_type) AS n FROM units WINDOW w AS (PARTITION BY substr(geocode,1,3), unit_type ORDER BY unit))")
def sink_reallocate_pairs(spark, sf):
    """Two coarse categories split to the totals of a second table; what is left must be what that table says."""
    u = units(spark, sf).withColumn("geocode3", F.substring("geocode", 1, 3)).drop("geocode")
    n = u.filter("unit_type in ('BUILDING', 'FURNITURE')").groupBy("geocode3", "unit_type").agg(F.count("*").alias("n"))
    k = F.when(F.col("unit_type") == "BUILDING", F.floor(F.col("n") / 3)).otherwise(F.col("n") - 1)
    targets = n.select("geocode3", "unit_type", k.alias("k"), (F.col("n") - k).alias("left"))
    pairs = {"BUILDING": ("mortgage", "owned"), "FURNITURE": ("rented", "no pay")}
    return files.reallocate_pairs(u, ["geocode3"], "unit_type", targets, pairs, ["unit"], "tenure").select("unit", "unit_type", "geocode3", "tenure")


@register("sink_level_columns", "SELECT substr(geocode,1,1) AS region, substr(geocode,1,3) AS nation, substr(geocode,1,5) AS tract, flag, count(*) AS n FROM persons GROUP BY ALL")
def sink_level_columns(spark, sf):
    cut = [F.substring("geocode", 1, n).alias(c) for c, n in (("region", 1), ("nation", 3), ("tract", 5))]
    return persons(spark, sf).groupBy(*cut, "flag").agg(F.count("*").alias("n"))


@register("sink_histogram_parquet", "SELECT geocode, flag, status, band, orig FROM cells")
def sink_histogram_parquet(spark, sf):
    path = files.scratch(spark, "histogram")
    cells(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


@register("sink_noisy_by_level", "SELECT level, geocode, flag, status, band, priv FROM frame")
def sink_noisy_by_level(spark, sf):
    path = files.scratch(spark, "levels")
    frame(spark, sf).drop("orig").write.partitionBy("level").parquet(path)
    return spark.read.parquet(path).select("level", "geocode", *DIMS, "priv")


@register("sink_measurements_long", f"SELECT 'detailed' AS query, CASE WHEN geocode='' THEN '0' ELSE geocode END AS geocode, {CELL} AS cell, priv AS value FROM frame")
def sink_measurements_long(spark, sf):
    """Measurements as a flat delimited file, read back; the root is written as 0."""
    path = files.scratch(spark, "measurements")
    root = F.when(F.col("geocode") == "", "0").otherwise(F.col("geocode"))
    files.write_delimited(frame(spark, sf).select(F.lit("detailed").alias("query"), root.alias("geocode"), hist.flat_index(DIMS, SIZES).alias("cell"), F.col("priv").alias("value")), path)
    return files.read_delimited(spark, path, "query string, geocode string, cell int, value long")


DENSE = ", g AS (SELECT DISTINCT geocode FROM frame WHERE level=3), a AS (SELECT * FROM g, (SELECT unnest([0,1,2]) AS flag), (SELECT unnest([0,1]) AS status), (SELECT unnest([0,1,2,3,4]) AS band)), s AS (SELECT geocode, flag, status, band, CASE WHEN geocode LIKE '1%' THEN 0 ELSE orig END AS orig, CASE WHEN geocode LIKE '1%' THEN 0 ELSE priv END AS priv FROM frame WHERE level=3) "


@register("sink_dense_or_sparse_df", DENSE + "SELECT 'dense' AS kind, a.geocode, a.flag, a.status, a.band, coalesce(orig,0) AS orig, coalesce(priv,0) AS priv FROM a LEFT JOIN s ON a.geocode=s.geocode AND a.flag=s.flag AND a.status=s.status AND a.band=s.band UNION ALL SELECT 'sparse', * FROM s WHERE orig<>0 OR priv<>0 UNION ALL SELECT DISTINCT 'sparse', geocode, 0, 0, 0, 0, 0 FROM s WHERE geocode LIKE '1%'")
def sink_dense_or_sparse_df(spark, sf):
    """Both forms of one histogram in which a region holds nothing."""
    empty = F.col("geocode").startswith("1")
    f = frame(spark, sf).filter("level = 3").select("geocode", *DIMS, *[F.when(empty, 0).otherwise(F.col(v)).cast("long").alias(v) for v in ("orig", "priv")])
    form = lambda dense: files.dense_or_sparse(f, ["geocode"], DIMS, SIZES, ["orig", "priv"], dense).select(F.lit("dense" if dense else "sparse").alias("kind"), "geocode", *DIMS, "orig", "priv")
    return form(True).unionByName(form(False))


@register("sink_microdata_df", "SELECT geocode, flag, status, band, CASE WHEN band>=2 THEN 'big' ELSE 'small' END AS size FROM persons")
def sink_microdata_df(spark, sf):
    return files.expand(cells(spark, sf), "orig").withColumn("size", F.when(F.col("band") >= 2, "big").otherwise("small"))


@register("sink_partition_by_prefix", "SELECT substr(geocode,1,3) AS prefix, count(*) AS n FROM persons GROUP BY 1")
def sink_partition_by_prefix(spark, sf):
    path = files.scratch(spark, "prefix")
    p = persons(spark, sf).withColumn("prefix", F.substring("geocode", 1, 3)).select("prefix", "geocode")
    p.repartitionByRange("prefix").write.partitionBy("prefix").parquet(path)
    return spark.read.schema("geocode string, prefix string").parquet(path).groupBy("prefix").agg(F.count("*").alias("n"))


@register("udtf_expand_rows", "SELECT geocode, flag, status, band FROM persons")
def udtf_expand_rows(spark, sf):
    return files.expand(cells(spark, sf), "orig")


@register("udaf_histogram_sum", f"SELECT {CELL} AS cell, CAST(sum(orig) AS BIGINT) AS n FROM cells GROUP BY 1")
def udaf_histogram_sum(spark, sf):
    """Sum of structured cell lists: exploded and summed, so that partial sums combine before the shuffle."""
    v = hist.sparse_vector(cells(spark, sf).withColumn("cell", hist.flat_index(DIMS, SIZES)), ["geocode"], "cell", "orig")
    return v.select(F.explode("cells").alias("x")).groupBy("x.cell").agg(F.sum("x.orig").alias("n"))


@register("udf_recoder_plugin", "SELECT orderkey, run, qty, qty*2+flag AS code FROM persons")
def udf_recoder_plugin(spark, sf):
    """A user's vectorised function in place of a recode expression."""

    @F.pandas_udf("int")
    def user(qty: pd.Series, flag: pd.Series) -> pd.Series:
        return (qty * 2 + flag).astype("int32")

    return persons(spark, sf).select("orderkey", "run", "qty", user("qty", "flag").alias("code"))


@register("udf_metric_plugin", "SELECT level, geocode, CAST(sum(abs(priv-orig)) AS BIGINT) AS l1, CAST(max(abs(priv-orig)) AS BIGINT) AS farthest FROM frame GROUP BY ALL")
def udf_metric_plugin(spark, sf):
    """A metric chosen by its name, among them one of the user's."""
    own = {"farthest": lambda priv, orig: F.max(F.abs(priv - orig))}
    return metrics.by_name(frame(spark, sf), ["level", "geocode"], ["l1", "farthest"], own=own)


DRAWS = f"SELECT state, CAST(lo+floor({uniform_sql(11, 'i')}*c) AS BIGINT) AS i FROM (SELECT substr(geocode,1,1) AS state, i, min(i) OVER (PARTITION BY substr(geocode,1,1)) AS lo, count(*) OVER (PARTITION BY substr(geocode,1,1)) AS c FROM n)"


@register("measure_bootstrap", f", n AS (SELECT geocode, flag, status, band, row_number() OVER (ORDER BY geocode, flag, status, band)-1 AS i FROM persons) SELECT d.state, n.geocode, n.flag, n.status, n.band, count(*) AS n FROM ({DRAWS}) d JOIN n ON n.i=d.i GROUP BY ALL")
def measure_bootstrap(spark, sf):
    """Resampled histogram: every record of a state draws one of its state, so state totals are kept and blocks and cells vary."""
    c = cells(spark, sf).withColumn("state", F.substring("geocode", 1, 1))
    return resample.bootstrap(c, "state", ["geocode", *DIMS], "orig", seed=11)
