"""Reproducible shuffle into shards by a Feistel permutation over global row numbers.

Rows are numbered 0..n-1 in a total order, the number is permuted by a keyed
Feistel network with cycle walking, and the permuted number gives the place:
``shard = p % shards`` and ``slot = p // shards``. So the counts of two shards
differ by one at most, slots have no gaps, and the place of any row number (and
the row number of any place, see :func:`inverse`) can be computed without data.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.runtime import cuts

ROUNDS = 6
WALKS = 48


def _sides(n: Column) -> tuple[Column, Column]:
    """Sizes a, b of the two halves: a*b >= n, and a*b - n < a, so nearly every walk ends at once."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    return a, F.greatest(F.floor((n + a - 1) / a).cast("long"), F.lit(1))


def _rounds(x: Column, n: Column, key: int, back: bool = False) -> Column:
    a, b = _sides(n)
    pair = F.struct(F.pmod(x, a).alias("l"), F.floor(x / a).cast("long").alias("r"))

    # one struct per round, so each round's hash is evaluated once
    def step(p: Column, r: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(key)), r.cast("string"), F.when(r % 2 == 0, p["r"]).otherwise(p["l"]).cast("string"))
        h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
        h = -h if back else h
        return F.struct(
            F.when(r % 2 == 0, F.pmod(p["l"] + h, a)).otherwise(p["l"]).alias("l"),
            F.when(r % 2 == 0, p["r"]).otherwise(F.pmod(p["r"] + h, b)).alias("r"),
        )

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(i) for i in order]), pair, step, lambda p: p["r"] * a + p["l"])


def _walk(x: Column, n: Column, key: int, back: bool) -> Column:
    """Apply the permutation of [0, a*b) until the value is below n.

    a*b - n < a, so a step leaves [0, n) with a chance of about 1/sqrt(n) and
    WALKS steps suffice for any n (for n below WALKS**2 the cycle itself is
    shorter); the query fails rather than give a wrong place.
    """
    once = _rounds(x, n, key, back)
    more = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), once, lambda y, _: F.when(y < n, y).otherwise(_rounds(y, n, key, back)))
    return F.when(more < n, more).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def permute(x: Column, n: Column, key: int = 0) -> Column:
    """Place of row number ``x`` among ``n`` (long columns, 0 <= x < n)."""
    return _walk(x.cast("long"), n.cast("long"), key, False)


def inverse(place: Column, n: Column, key: int = 0) -> Column:
    """Row number that :func:`permute` takes to ``place``."""
    return _walk(place.cast("long"), n.cast("long"), key, True)


def number_rows(df: DataFrame, order: list[str], uniform: str | None = None, side: int = 32, parts: int = 64) -> DataFrame:
    """``df`` with ``_row`` (0..n-1 in the order of the columns) and ``_n``, without a single-task sort.

    The first ordering column, of any type with an order, is cut at approximate quantiles (at most side**2 - 1
    values fetched) into ranges; a value that fills whole ranges gets one of its own, which is dealt to ``parts`` further ones by
    ``uniform``, the second ordering column, if that is spread evenly over 0..2**32-1. Rows are ranked inside each range, and the ranges'
    row counts, a table of at most 2 * side**2 * parts rows, are added up. Null orders first;
    rows equal in all columns get any of their numbers.
    """
    first = F.col(order[0])
    found = cuts(df, order[0], side * side)
    hot = sorted({c for c, d in zip(found, found[1:]) if c == d})
    values = sorted(set(found))
    groups = [values[i : i + side] for i in range(0, len(values), side)] or [[]]
    below = lambda values: F.size(F.filter(F.array(*map(F.lit, values)), lambda c: c < first)) if values else F.lit(0)
    # two levels of comparisons: the group by the groups' last cuts, then the cut inside the group
    group = below([g[-1] for g in groups if g])
    inside = F.lit(0)
    if values:
        inner = F.array(*[F.array(*map(F.lit, g)) for g in groups])
        inside = F.coalesce(F.size(F.filter(F.get(inner, group), lambda c: c < first)), F.lit(0))
    range_ = F.when(first.isNull(), 0).otherwise(group * side + F.greatest(inside, F.lit(0)) + 1)
    part = F.lit(0)
    if hot:
        # a cut is the greatest value of its range: it goes behind the others, in order of the second column
        split = F.floor(F.coalesce(F.col(uniform), F.lit(0)) / ((1 << 32) // parts)).cast("int") if uniform else F.lit(0)
        part = F.when(first.isin(hot), 1 + split).otherwise(0)
    binned = df.withColumn("_bin", range_ * (parts + 1) + part)
    sizes = binned.groupBy("_bin").agg(F.count("*").alias("_c"))
    sizes = sizes.select("_bin", (F.sum("_c").over(W.orderBy("_bin")) - F.col("_c")).alias("_before"), F.sum("_c").over(W.partitionBy(F.lit(0))).alias("_n"))
    ranked = binned.withColumn("_rank", F.row_number().over(W.partitionBy("_bin").orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    return ranked.join(F.broadcast(sizes), "_bin").withColumn("_row", F.col("_before") + F.col("_rank") - 1).drop("_bin", "_before", "_rank")


def shard(docs: DataFrame, shards: int = 16, key: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law ``rows``, shard, slot, grown_shard (null under this law).

    ``size`` is the UTF-8 length plus 1 (null text: 1), ``text_crc32`` is null for
    a null text. Only these numbers are shuffled, never texts. Rows are numbered by
    doc_id, then text_crc32, then size, so the result doesn't depend on the order or
    partitioning of the input; rows equal in all three share their places among
    them. An empty table gives an empty result.
    """
    t = F.col(text).cast("binary")
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(t).alias("text_crc32"))
    placed = number_rows(rows, ["doc_id", "text_crc32", "size"], uniform="text_crc32").withColumn("_p", permute(F.col("_row"), F.col("_n"), key))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod("_p", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("_p") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
