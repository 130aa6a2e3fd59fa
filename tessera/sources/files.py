"""Reading and writing record files: delimited, fixed-width, by record type; histograms as Parquet."""

from __future__ import annotations

import itertools
import tempfile
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import hist
from tessera.operators import order as ranks

_n = itertools.count()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; in a temporary one only where it is unset and all tasks run in this process (tests)."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir")
    if not base and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base or tempfile.mkdtemp(prefix='files-')}/{name}-{sc.applicationId}-{next(_n)}"


def read_delimited(spark: SparkSession, paths: list[str] | str, schema: str, sep: str = "|", header: bool = True, comment: str | None = None) -> DataFrame:
    """Delimited text under a declared schema; comment lines are skipped, column names lower-cased. No paths: an empty table of the schema."""
    if not paths:
        empty = spark.createDataFrame([], schema)
        return empty.toDF(*[c.lower() for c in empty.columns])
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "FAILFAST")
    df = (reader.option("comment", comment) if comment else reader).csv(paths)
    return df.toDF(*[c.lower() for c in df.columns])


def read_record_types(spark: SparkSession, path: str, layouts: dict[str, list[tuple[str, int, int, str]]], at: int = 1) -> dict[str, DataFrame]:
    """One frame per record type of a file whose lines of several types share it, told by the text that starts in column ``at``."""
    return {kind: read_fixed_width(spark, path, layout, F.substring("value", at, len(kind)) == kind) for kind, layout in layouts.items()}


def file_part(position: int = -1, sep: str = "_") -> Column:
    """Part of the name of the file a row comes from, without its ending: the last one by default."""
    parts = F.split("_metadata.file_path", "/")
    # a file that Spark has written in parts is a folder of that name
    name = F.when(F.element_at(parts, -1).startswith("part-"), F.element_at(parts, -2)).otherwise(F.element_at(parts, -1))
    return F.element_at(F.split(F.regexp_replace(name, r"\..*$", ""), sep), position)


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 64


def write_named(frame: DataFrame, folder: str, name: Column) -> None:
    """Lines of a one-column frame into files named by a column, all in one write: each is a folder ``file=name`` of part files, so that readers see the name in their path.

    Each task writes its own rows, a part for each name it holds: lines are not brought together by name, so few names don't make few large tasks.
    Up to OPEN_FILES names of a task are open at once and need no sort; beyond that Spark sorts what is left.
    """
    conf = frame.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, str(OPEN_FILES))
    try:
        frame.withColumn("file", name).write.partitionBy("file").text(folder)
    finally:
        conf.set(WRITERS, before)


def read_mapped(spark: SparkSession, frame: DataFrame, path: str, key: str, value: str, missing: str) -> DataFrame:
    """``frame`` with ``value`` from a delimited map file (key, value), read as text; keys that the file lacks get ``missing``."""
    m = read_delimited(spark, path, f"{key} string, {value} string").withColumnRenamed(key, "_k").dropDuplicates(["_k"])
    joined = frame.join(m, frame[key].cast("string") == F.col("_k"), "left").drop("_k")
    return joined.withColumn(value, F.coalesce(value, F.lit(missing)))


SQUARE_METRES = 2589988  # of a square mile, as the area files are read


def read_areas(spark: SparkSession, path: str, key: str, land: str = "land", water: str = "water") -> DataFrame:
    """Areas in square miles from a delimited file of square metres: key, land, water, area."""
    a = read_delimited(spark, path, f"{key} long, {land} double, {water} double")
    miles = lambda c: F.col(c) / SQUARE_METRES
    return a.select(key, miles(land).alias("land"), miles(water).alias("water"), (miles(land) + miles(water)).alias("area"))


def read_as_raw(records: DataFrame, required: list[str], keys: list[str], saved: DataFrame, value: str) -> DataFrame:
    """A protected output taken as input: fails on a null in a required field, and on keys whose count differs from the saved invariant."""
    lost = records.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict()
    if bad := {c: n for c, n in lost.items() if n}:
        raise ValueError(f"required fields with nulls: {bad}")
    now = records.groupBy(*keys).agg(F.count("*").alias("_n"))
    apart = now.join(saved.select(*keys, F.col(value).alias("_s")), keys, "full").filter(~F.col("_n").eqNullSafe(F.col("_s"))).limit(5).collect()
    if apart:
        raise ValueError(f"counts differ from the saved invariants: {apart}")
    return records


def read_runs(spark: SparkSession, runs: dict[str, tuple[str, float, str]], columns: list[str]) -> DataFrame:
    """Saved runs as one frame: run id -> (Parquet path, privacy-loss budget, group of budgets); fixed order of columns, then run_id, plb and budget_group."""
    one = lambda name, path, plb, group: spark.read.parquet(path).select(*columns, F.lit(name).alias("run_id"), F.lit(float(plb)).alias("plb"), F.lit(group).alias("budget_group"))
    return reduce(DataFrame.unionByName, [one(name, *at) for name, at in runs.items()])


def required(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The frame; reading a row with a null in one of the columns fails."""
    told = lambda c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(frame.schema[c].dataType))
    return frame.withColumns({c: told(c) for c in columns})


def linked_sample(units: DataFrame, persons: DataFrame, key: str, chosen: Column, vacant: int = 0, facility: Column | None = None, facilities: int = 0) -> DataFrame:
    """Units whose key is chosen and all their persons, in one frame with ``kind``, and by key the first ``vacant`` units without persons and the first ``facilities`` units that are one."""
    lived = units.join(persons.select(key).distinct(), key, "left_semi").filter(chosen).withColumn("kind", F.lit("unit"))
    people = persons.filter(chosen).withColumn("kind", F.lit("person"))
    empty = units.join(persons.select(key).distinct(), key, "left_anti").orderBy(key).limit(vacant).withColumn("kind", F.lit("vacant"))
    out = lived.unionByName(people, allowMissingColumns=True).unionByName(empty, allowMissingColumns=True)
    if facility is None:
        return out
    return out.unionByName(units.filter(facility).orderBy(key).limit(facilities).withColumn("kind", F.lit("facility")), allowMissingColumns=True)


def write_with_metadata(frame: DataFrame, path: str, allocation: str, sep: str = "|") -> None:
    """Delimited files in ``path``/data and a sidecar in ``path``/meta: header, time of writing, rows counted on the way, text of the allocation."""
    seen = Observation()
    write_delimited(frame.observe(seen, F.count(F.lit(1)).alias("n")), f"{path}/data", sep)
    row = [(sep.join(frame.columns), datetime.now(UTC).isoformat(timespec="seconds"), str(seen.get["n"]), allocation)]
    frame.sparkSession.createDataFrame(row, METADATA).coalesce(1).write.json(f"{path}/meta")


METADATA = "header string, written string, n_rows string, allocation string"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).json(f"{path}/meta")


def dense_or_sparse(frame: DataFrame, keys: list[str], dims: list[str], sizes: list[int], values: list[str], dense: bool) -> DataFrame:
    """Rows per key and cell. Dense: every cell of every key, zeros filled in; sparse: cells with any value, and one all-zero row for a key without any."""
    if dense:
        return hist.densify(frame, keys, dims, sizes, values)
    there = reduce(lambda a, b: a | b, [F.coalesce(F.col(v), F.lit(0)) != 0 for v in values])
    full = frame.filter(there).select(*keys, *dims, *values)
    none = frame.select(*keys).distinct().join(full, keys, "left_anti")
    return full.unionByName(none.select(*keys, *[F.lit(0).alias(d) for d in dims], *[F.lit(0).cast("long").alias(v) for v in values]))


def read_fixed_width(spark: SparkSession, path: str, layout: list[tuple[str, int, int, str]], keep: Column | None = None) -> DataFrame:
    """Fixed-width text by a layout (name, first column from 1, width, type); ``keep`` is a predicate on the raw line ``value``."""
    lines = spark.read.text(path)
    lines = lines.filter(keep) if keep is not None else lines
    return lines.select(*[F.expr(f"try_cast(trim(substr(value, {at}, {width})) as {kind})").alias(name) for name, at, width, kind in layout])


def write_delimited(frame: DataFrame, path: str, sep: str = "|") -> None:
    frame.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def write_fixed_width(frame: DataFrame, path: str, layout: list[tuple[str, int, int, str]]) -> None:
    """Fixed-width lines; columns must follow each other without gaps."""
    parts = [F.rpad(F.coalesce(F.col(n).cast("string"), F.lit("")), w, " ") for n, _, w, _ in layout]
    frame.select(F.concat(*parts).alias("value")).write.mode("overwrite").text(path)


BLOCK = 1024


def expand(hist: DataFrame, count: str, at: str | None = None) -> DataFrame:
    """One row per record of a histogram; ``at`` names the record's number in its cell, from 0. Counts are cut in blocks, so no array is longer than BLOCK."""
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count).cast("long") - 1) / BLOCK))
    cut = hist.filter(F.col(count) > 0).withColumn("_b", F.explode(blocks))
    size = F.least(F.lit(BLOCK).cast("long"), F.col(count).cast("long") - F.col("_b") * BLOCK)
    each = cut.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    each = each.withColumn(at, F.col("_b") * BLOCK + F.col("_i")) if at else each
    return each.drop("_b", "_i", count)


def numbered(records: DataFrame, order: list[str], out: str = "epnum") -> DataFrame:
    """Dense 0-based record numbers over the whole output, without one task for all rows (see :func:`order.numbered`)."""
    return ranks.numbered(records, order, out)


def numbered_records(hist: DataFrame, count: str, order: list[str], out: str = "epnum") -> DataFrame:
    """Records of a histogram with their numbers: cells, not records, are put in order. They are written first, as cuts, totals and running sums each read them."""
    cells = ranks.running(kept(hist.filter(F.col(count) > 0), "cells"), order, F.col(count).cast("long"), "_first")
    return expand(cells, count, "_at").withColumn(out, F.col("_first") + F.col("_at")).drop("_first", "_at")


def kept(frame: DataFrame, name: str) -> DataFrame:
    """The frame as written to and read from the shared folder."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def residual_units(households: DataFrame, totals: DataFrame, keys: list[str], total: str, out: str = "n") -> DataFrame:
    """Vacant units per key: total units minus households, as counts to be expanded."""
    n = households.groupBy(*keys).agg(F.count("*").alias("_h"))
    return totals.join(n, keys, "left").select(*keys, (F.col(total) - F.coalesce("_h", F.lit(0))).alias(out)).filter(F.col(out) > 0)


def cap(estimate: DataFrame, published: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Cell-wise least of an estimate and a published count (none published: 0)."""
    p = published.select(*keys, F.col(value).alias("_p"))
    return estimate.join(p, keys, "left").withColumn(value, F.least(value, F.coalesce("_p", F.lit(0)))).drop("_p")


def reallocate(records: DataFrame, targets: DataFrame, keys: list[str], coarse: Column, order: list[str], first: str, rest: str, out: str) -> DataFrame:
    """Split a coarse category so that the first k records of each key (k from ``targets``) become ``first``, the others ``rest``."""
    rank = F.row_number().over(W.partitionBy(*keys, coarse).orderBy(*order))
    j = records.join(targets.select(*keys, F.col("k").alias("_k")), keys, "left").withColumn("_r", F.when(coarse, rank))
    return j.withColumn(out, F.when(F.col("_r").isNull(), F.lit(None)).when(F.col("_r") <= F.coalesce("_k", F.lit(0)), first).otherwise(rest)).drop("_k", "_r")


def reallocate_pairs(records: DataFrame, keys: list[str], coarse: str, targets: DataFrame, pairs: dict[str, tuple[str, str]], order: list[str], out: str) -> DataFrame:
    """Split several coarse categories at once: of category c with the pair (first, rest), the first k records of each key become ``first``, the others ``rest``.

    ``targets``: keys, ``coarse`` (its value), ``k`` and ``left``, the number that the rest must have (null: any); records of other categories keep a null.
    A key where fewer than k records stand, or where another number is left, fails when its rows are read. Ranks are taken within a key and category.
    """
    w = W.partitionBy(*keys, coarse)
    j = records.join(targets.select(*keys, F.col(coarse), F.col("k").alias("_k"), F.col("left").alias("_left")), [*keys, coarse], "left")
    j = j.withColumns({"_r": F.row_number().over(w.orderBy(*order)), "_n": F.count("*").over(w), "_k": F.coalesce("_k", F.lit(0))})
    off = (F.col("_n") < F.col("_k")) | (F.coalesce("_left", F.col("_n") - F.col("_k")) != F.col("_n") - F.col("_k"))
    names = F.lit(None).cast("string")
    for category, (first, rest) in pairs.items():
        names = F.when(F.col(coarse) == category, F.when(F.col("_r") <= F.col("_k"), first).otherwise(rest)).otherwise(names)
    told = F.when(F.col(coarse).isin(list(pairs)) & off, F.raise_error(F.concat(F.lit("the counts of a pair do not add up in "), F.concat_ws(",", *keys))).cast("string")).otherwise(names)
    return j.withColumn(out, told).drop("_k", "_left", "_r", "_n")
