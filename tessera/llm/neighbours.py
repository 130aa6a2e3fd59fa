"""Nearest neighbours by inner product with multi-index hashing of learned binary codes.

*Codes.* A row x becomes the signs of ``W (x' - m)``, where x' is x over the greatest norm with one more component that makes all norms equal,
so that large inner products are small angles; a query q becomes the signs of ``W q'`` (a common shift ranks nothing anew). ``W`` holds
rotations learned by iterative quantisation on a bounded sample: principal axes, then alternately signs and the orthogonal
matrix that brings the axes nearest to them. *Radius.* The Hamming radius is learned from the sample too: within it lie RECALL of the nearest
neighbours of sampled queries. In the whole table neighbours are nearer than in a sample, so recall can only be higher there.

*Index.* Rows are dealt into blocks of at most about BLOCK_ROWS by the hash of the vector. A block cuts its codes into substrings of SUBSTRING bits and
keeps, for each, its rows in order of the substring's value. Codes within radius r of a query agree with it to r // m bits in one of m
substrings (by pigeonhole; some to one bit less), so each query probes the values in those balls, checks the whole codes of what it finds against r,
and reranks the rows by their floats. A query that finds fewer than it needs in a block looks again with a larger radius. Queries visit every block, in lots of QUERY_ROWS; what leaves a
block is the best few of each query.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.runtime import prepare

SAMPLE_ROWS, SAMPLE_QUERIES = 8192, 512
BITS, SUBSTRING, ROUNDS = 128, 16, 30
RECALL = 0.97
BLOCK_ROWS, QUERY_ROWS, LEAST_BLOCKS = 1 << 16, 1 << 14, 12
ONES = np.array([bin(v).count("1") for v in range(1 << SUBSTRING)], np.uint8)


@functools.cache
def ball(radius: int) -> np.ndarray:
    """All substrings with at most ``radius`` bits set."""
    return np.flatnonzero(ONES <= radius).astype(np.uint16)


@dataclass
class Codes:
    """What was learned: the greatest norm, the mean of the scaled rows, the rotations (components x bits) and the radius."""

    norm: float
    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        return packed((lifted(x, self.norm) - self.mean) @ self.rotation > 0)

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        scale = np.linalg.norm(q, axis=1, keepdims=True)
        return packed(np.hstack([q / scale, np.zeros((len(q), 1))]) @ self.rotation > 0)


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows over the greatest norm, with a component that makes them unit vectors."""
    x = x / norm
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x, x)))[:, None]])


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as substrings."""
    return np.packbits(bits, axis=1).view(np.uint16)


def rotation(centred: np.ndarray, seed: int) -> np.ndarray:
    """Principal axes turned so that the rows lie near the corners of the cube (iterative quantisation)."""
    _, axes = np.linalg.eigh(centred.T @ centred)
    turned = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(axes), len(axes))))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(turned @ turn > 0, 1.0, -1.0).T @ turned)
        turn = (left @ right).T
    return axes @ turn


def learn(sample: np.ndarray, norm: float, k: int, bits: int = BITS, recall: float = RECALL) -> Codes:
    """Rotations and radius from a sample of rows; more bits than components take several rotations from other starts."""
    x = lifted(sample, norm)
    mean = x.mean(axis=0)
    turns = [rotation(x - mean, seed) for seed in range(-(-bits // x.shape[1]))]
    codes = Codes(norm, mean, np.hstack(turns)[:, :bits], bits)
    rows, queries = codes.of_rows(sample), codes.of_queries(sample[:SAMPLE_QUERIES])
    near = []
    for i, q in enumerate(queries):
        score = sample @ sample[i]
        score[i] = -np.inf
        best = np.argpartition(-score, min(k, len(score) - 1))[:k]
        near.append(ONES[rows[best[best != i]] ^ q].sum(axis=1, dtype=np.int64))
    near = np.concatenate(near) if near else np.zeros(0)
    codes.radius = int(np.quantile(near, recall, method="higher")) if len(near) else bits
    return codes


class Block:
    """Multi-index of a block of rows."""

    def __init__(self, codes: Codes, vectors: np.ndarray):
        self.codes, self.vectors = codes, vectors
        self.rows = codes.of_rows(vectors)
        self.tables = []
        for j in range(self.rows.shape[1]):
            order = np.argsort(self.rows[:, j], kind="stable").astype(np.int32)
            values, starts = np.unique(self.rows[order, j], return_index=True)
            self.tables.append((order, values, np.append(starts, len(order)).astype(np.int64)))

    def probe(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose codes are within the radius of the query's."""
        found, m = np.zeros(len(self.rows), bool), self.rows.shape[1]
        whole, rest = divmod(radius, m)
        for j, (order, values, starts) in enumerate(self.tables):
            # rest + 1 substrings may differ in whole bits, the others in one less: else all m differ in more than radius together
            reach = min(whole - (j > rest), SUBSTRING)
            if reach < 0:
                continue
            if len(masks := ball(reach)) < len(values):
                wanted = query[j] ^ masks
                at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                at = at[values[at] == wanted]
            else:
                at = np.flatnonzero(ONES[values ^ query[j]] <= reach)
            length = starts[at + 1] - starts[at]
            ends = np.cumsum(length)
            if len(at):
                found[order[np.arange(ends[-1]) + np.repeat(starts[at] - ends + length, length)]] = True
        rows = np.flatnonzero(found)
        return rows[ONES[self.rows[rows] ^ query].sum(axis=1, dtype=np.int64) <= radius]

    def nearest(self, q: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, list[float]]:
        """Up to k nearest rows that the probing finds, at least k if there are as many, best first, with their scores."""
        radius, bits = self.codes.radius, SUBSTRING * self.rows.shape[1]
        rows = self.probe(code, radius)
        while len(rows) < min(k, len(self.rows)) and radius < bits:
            radius = min(bits, radius + self.rows.shape[1])
            rows = self.probe(code, radius)
        score = self.vectors[rows] @ q
        if len(rows) > 2 * k:
            best = np.argpartition(-score, 2 * k)[: 2 * k]
            # rounding of the fast product can't move a row past k others
            rows, score = rows[best], score[best]
        exact = [math.fsum(products) for products in (self.vectors[rows] * q).tolist()]
        order = sorted(range(len(rows)), key=lambda i: -exact[i])[:k]
        return rows[order], [exact[i] for i in order]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def stacked(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds its k nearest others, by inner product in double precision.

    Null vectors, vectors with a null or non-finite component, zero vectors and rows without an id take no part, nor do vectors of another length than the
    commonest (ties: the shorter). Rows that repeat in id and vector count once; rows with the query's id are not its neighbours. Equal vectors are searched
    once, and the k + 1 least ids of each stand for it; equal scores are in order of the id. Fewer rows than k + 1: all others. Recall is below 1, see above; scores and order are exact. The
    sample is the ``sample_rows`` rows with the least hashes. An empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark, 4096)
    v = F.col("vector")
    rows = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), queries.alias("asks"))
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy(F.size(v).alias("width")).agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("norm"), F.count_if("asks").alias("asking")).orderBy(F.desc("n"), "width").first()
    id_type, item = rows.schema["vec_id"].dataType, rows.schema["vector"].dataType
    if sizes is None:
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", id_type), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", id_type), T.StructField("score", T.DoubleType())]))
    width = sizes.width
    rows = rows.filter(F.size(v) == width)
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id"), F.xxhash64("vector")).limit(sample_rows).toArrow()
    codes = learn(stacked(sample.column("vector").combine_chunks(), width), sizes.norm, k)
    n_blocks = max(least_blocks, -(-sizes.n // block_rows))
    n_lots = max(1, -(-sizes.asking // query_rows))

    keyed = rows.withColumn("key", F.unhex(F.md5(v.cast("string").cast("binary"))))
    order = W.partitionBy("key").orderBy("vec_id")
    few = keyed.select("key", "vec_id", "vector").distinct().withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    members = few.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))
    asked = keyed.filter("asks").groupBy("key").agg(F.first("vector").alias("vector"))
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    no_ids = F.lit(None).cast(T.ArrayType(id_type)).alias("ids")
    base = members.select(part(n_blocks, 1).alias("block"), every(n_lots).alias("lot"), F.lit(0).alias("kind"), "key", "ids", "vector")
    asks = asked.withColumn("lot", part(n_lots, 2)).select(every(n_blocks).alias("block"), "lot", F.lit(1).alias("kind"), "key", no_ids, "vector")
    met = base.unionByName(asks).repartition(n_blocks * n_lots, "block", "lot").sortWithinPartitions("block", "lot", "kind")
    out = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, ids, block = None, [], [], None
        for batch in batches:
            kinds = np.stack([batch.column(c).to_numpy() for c in ("block", "lot", "kind")], axis=1)
            cuts = np.flatnonzero(np.concatenate(([True], (kinds[1:] != kinds[:-1]).any(axis=1), [True])))
            for a, b in zip(cuts, cuts[1:]):
                own, x = batch.slice(a, b - a), None
                if at != tuple(kinds[a, :2]):
                    at, held, ids, block = tuple(kinds[a, :2]), [], [], None
                x = stacked(own.column("vector"), width)
                if kinds[a, 2] == 0:
                    held.append(x)
                    ids += own.column("ids").to_pylist()
                    continue
                if block is None and held:
                    block, held = Block(codes, np.concatenate(held)), []
                if block is None:
                    continue
                found = []
                for q, code in zip(x, codes.of_queries(x)):
                    at_rows, scores = block.nearest(q, code, k + 1)
                    pairs = sorted(((s, i) for r, s in zip(at_rows, scores) for i in ids[r]), key=lambda p: (-p[0], p[1]))[: k + 1]
                    found.append(pairs)
                yield pa.RecordBatch.from_arrays([own.column("key"), pa.array([[i for _, i in p] for p in found], arrow.field("ids").type), pa.array([[s for s, _ in p] for p in found], arrow.field("scores").type)], schema=arrow)

    pairs = met.mapInArrow(search, out).select("key", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select("key", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))
    best = pairs.withColumn("_r", F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_r") <= k + 1)
    lists = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
    named = keyed.filter("asks").select(F.col("vec_id").alias("query_id"), "key").distinct().join(lists, "key")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = named.select("query_id", F.posexplode(others).alias("rank", "_p"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("_p.vec_id").alias("vec_id"), (-F.col("_p.far")).alias("score"))
