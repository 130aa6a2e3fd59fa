"""What every operator with Python tasks needs: code on the executors, bounded batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 256
BATCH_BYTES = 16 << 20
_shipped: set[str] = set()


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> None:
    """Make this package importable in Python workers and bound Arrow batches.

    The package goes out once per application through ``addPyFile``, which the
    driver serves to executors that join or restart later. Batches are bounded
    in rows and bytes, so one task's memory doesn't depend on text lengths
    (a single text larger than the bound is a batch of its own).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # lists and sets per document: by hash for as many documents as a task has, instead of by sorting beyond 128
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "65536")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; a temporary one only where it is unset and all tasks run in this process (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """Materialise and cut lineage in the shared checkpoint folder; the shuffle files that led there go at once, not at some later collection of garbage."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        # a frame takes this setting when it is made
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(CLEANUP, before)


def text_key(text) -> list:
    """128-bit key of a text as two columns ``_ka`` and ``_kb``; equal texts have equal keys, null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("_ka"), F.xxhash64(F.lit(7), t).alias("_kb")]


SAMPLE_ROWS = 50_000


def cuts(df: DataFrame, column: str, bins: int) -> list:
    """Values that cut the rows into about ``bins`` ranges of equal size, ascending; a value that fills whole ranges stands repeatedly.

    Numbers: approximate quantiles. Other types: quantiles of the SAMPLE_ROWS rows with the least hashes. Cuts
    balance the work and nothing else, so a sample will do.
    """
    if bins < 2:
        return []
    if dict(df.select(F.col(column).alias("c")).dtypes)["c"] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return df.agg(F.percentile_approx(column, [i / bins for i in range(1, bins)], 10 * bins)).first()[0] or []
    others = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map")]
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("c"), F.xxhash64(*others).alias("h")).orderBy("h").limit(SAMPLE_ROWS)
    found = rows.agg(F.sort_array(F.collect_list("c")).alias("all")).select(F.array(*[F.get("all", F.floor(F.size("all") * (i / bins)).cast("int")) for i in range(1, bins)]).alias("cuts")).first()[0]
    return [c for c in found if c is not None]
