"""Stand-in microdata on the given tables, in Spark and as SQL text, and the registry of queries.

A customer is a unit, a line item a person of the unit, and the geocode is
region, nation, a tract-like group and the customer. ``priv`` is a fixed formula
in place of noise, so that every metric has an exact expected value.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import hist, query

DIMS, SIZES = ["flag", "status", "band"], [3, 2, 5]
LEVELS = [0, 1, 3, 5, 10]
SCHEMA = query.Schema(
    dict(zip(DIMS, SIZES)),
    {
        "low_band": ("band", {"low": [0, 1], "high": [3, 4]}),
        "returned": ("flag", {"returned": [0, 2], "kept": [1]}),
        "any_band": ("band", {"first": [0, 1, 2], "last": [2, 3, 4]}),
    },
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Shuffled bytes that adaptive execution packs into one task at most. They are compressed, and sorted or hashed rows take about 35 times as much memory.
TASK_BYTES = 16 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def bound_tasks(spark: SparkSession) -> None:
    """Lower the advisory size of a shuffled partition to TASK_BYTES; a lower one stays. More rows then make more tasks, not larger ones."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get(ADVISORY).strip().lower()).groups()
    if int(number) << 10 * " kmgt".index(unit or " ") > TASK_BYTES:
        spark.conf.set(ADVISORY, f"{TASK_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_tasks(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def geocode():
    return F.concat(F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lpad((F.col("c_custkey") % 50).cast("string"), 2, "0"), F.lpad(F.col("c_custkey").cast("string"), 5, "0"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("unit_type"), geocode().alias("geocode"))


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(units(spark, sf_dir), F.col("o_custkey") == F.col("unit"))
    qty = F.col("l_quantity").cast("int")
    return joined.select(
        "geocode", "unit", "unit_type",
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("status"),
        F.floor((qty - 1) / 10).cast("int").alias("band"), qty.alias("qty"),
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("prio"), F.col("o_orderstatus").alias("ostatus"),
        F.col("l_linenumber").cast("int").alias("run"), F.col("l_discount").alias("p"), F.col("l_suppkey").alias("supplier"), F.col("l_orderkey").alias("orderkey"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-level histogram: geocode, dims, orig."""
    return hist.count_by_cell(persons(spark, sf_dir), ["geocode"], DIMS)


def protected(frame: DataFrame) -> DataFrame:
    """Add the stand-in ``priv``."""
    shift = (hist.flat_index(DIMS, SIZES) * 7 + F.length("geocode") * 3 + F.coalesce(F.ascii(F.substring("geocode", -1, 1)), F.lit(0))) % 7 - 3
    return frame.withColumn("priv", F.greatest(F.lit(0), F.col("orig") + shift).cast("long"))


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis frame: level, geocode, dims, orig, priv for all levels."""
    return protected(hist.roll_up(cells(spark, sf_dir), "geocode", DIMS, LEVELS, ["orig"]))


SQL_BASE = """WITH units AS (
 SELECT c_custkey AS unit, c_mktsegment AS unit_type, CAST(n_regionkey AS VARCHAR) || lpad(CAST(n_nationkey AS VARCHAR),2,'0') || lpad(CAST(c_custkey % 50 AS VARCHAR),2,'0') || lpad(CAST(c_custkey AS VARCHAR),5,'0') AS geocode
 FROM customer JOIN nation ON c_nationkey = n_nationkey),
persons AS (
 SELECT geocode, unit, unit_type, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flag, CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS status,
  CAST(floor((CAST(l_quantity AS INTEGER)-1)/10) AS INTEGER) AS band, CAST(l_quantity AS INTEGER) AS qty, CAST(substr(o_orderpriority,1,1) AS INTEGER)-1 AS prio, o_orderstatus AS ostatus,
  CAST(l_linenumber AS INTEGER) AS run, l_discount AS p, l_suppkey AS supplier, l_orderkey AS orderkey
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN units ON o_custkey=unit),
cells AS (SELECT geocode, flag, status, band, count(*) AS orig FROM persons GROUP BY ALL),
levels AS (SELECT unnest([0,1,3,5,10]) AS level),
rolled AS (SELECT level, substr(geocode,1,level) AS geocode, flag, status, band, CAST(sum(orig) AS BIGINT) AS orig FROM cells, levels GROUP BY ALL),
frame AS (SELECT *, CAST(greatest(0, orig + (((flag*2+status)*5+band)*7 + length(geocode)*3 + CASE WHEN geocode='' THEN 0 ELSE ascii(right(geocode,1)) END) % 7 - 3) AS BIGINT) AS priv FROM rolled)
"""


def register(name: str, sql: str | None = None, base: bool = True):
    """Register a query and, where SQL can express it, its DuckDB text (behind the stand-in CTEs)."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = (SQL_BASE + sql) if base else sql
        return f

    return put
