"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import keep


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """``node, label``: every node of an edge with the least node of its component (orderable type, nulls and loops ignored).

    Each round hangs all larger neighbours of a node on its least neighbour, then
    all smaller ones; minima are combined before the shuffle, and a hub's rows
    meet its one minimum in a join that Spark may split. The rounds needed grow
    as the logarithm of the number of nodes. Rounds are cut by checkpoints in the
    shared folder.
    """
    e = keep(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = keep(small.union(least).distinct())
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = e.select(F.col("v").alias("node")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("node", F.col("node").alias("label")))
        seen = state
    raise RuntimeError("components did not settle")


SALTS = 16


def least_of_component(values: DataFrame, labels: DataFrame, node: str, least: str) -> DataFrame:
    """``values`` (one row per node) with ``least`` replaced by the least one of the node's component (null only if all are).

    Nodes without a label are components of their own and join nothing; a large component's rows are dealt over SALTS tasks, and
    its minimum is sent to each.
    """
    own = labels.select(F.col("node").alias(node), "label").join(values.select(node, least), node)
    found = own.groupBy("label").agg(F.min(least).alias("_least")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = own.select(node, "label", F.pmod(F.xxhash64(node), F.lit(SALTS)).cast("int").alias("_salt"))
    of_node = dealt.join(found, ["label", "_salt"]).select(node, "_least")
    return values.join(of_node, node, "left").withColumn(least, F.coalesce("_least", least)).drop("_least")
