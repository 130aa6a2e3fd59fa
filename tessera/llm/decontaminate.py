"""Benchmark decontamination by size-partitioned MinHash containment search.

Items (short) are looked for in documents (often long). Both are sets of
five-word shingles; an item leaks into a document that has at least 0.8 of its
shingles. Jaccard similarity can't see this when the sizes differ, so documents
are partitioned by size (powers of two) and items get a signature per partition.
A signature is a one-permutation MinHash: the hash range is cut into bins, 2 to 4
for each shingle of the largest document of the partition, and the least hash of
each bin stands for it. An item and a document are a candidate pair if the
minima of any bin agree. A shared shingle is its bin's minimum with
a chance of at least 0.78, so an item with m shared shingles is overlooked with a chance
below 0.22**m. Items of up to SMALL shingles are a size partition of their
own with a table of their own, where every shingle has its own bin and nothing is overlooked; the others are
sought by signature all the same.
Candidates are verified exactly, on the words themselves.

Up to BLOCK_ITEMS items of BLOCK_BYTES in all go to the tasks with the function, and documents are not shuffled.
A larger benchmark stays distributed: signatures of documents and items meet in a join, and the candidates'
texts after them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.rolling import mix, prefixes, stretch
from tessera.llm.runtime import prepare, text_key

SHINGLE = 5
THRESHOLD = 0.8
SMALL = 12
BLOCK_ITEMS = 50_000
BLOCK_BYTES = 32 << 20
VERIFIED_ITEMS = 64
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_IS_WORD = np.array([bool(_WORD.fullmatch(bytes([i]))) for i in range(256)])
_CODE = mix(np.arange(1, 257, dtype=np.uint64))


def words(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of characters beyond ASCII."""
    return _WORD.findall(text.lower().encode())


def word_hashes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode(), np.uint8)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = _IS_WORD[codes]
    edge = np.diff(inside)
    return stretch(prefixes(_CODE[codes]), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words (none if there are fewer)."""
    start = np.arange(max(len(hashes) - size + 1, 0))
    return np.unique(stretch(prefixes(hashes), start, start + size))


def minima(hashes: np.ndarray, shift: int) -> np.ndarray:
    """Least hash of each bin; sorted distinct hashes in, bins are their leading bits."""
    bins = hashes >> np.uint64(shift)
    return hashes[np.concatenate(([True], bins[1:] != bins[:-1]))] if len(hashes) else hashes


def size_class(n: int) -> int:
    return max(n - 1, 0).bit_length()


def bits(cls: int) -> int:
    """Bits of a hash that don't tell its bin, in a size class."""
    return max(64 - cls - 1, 1)


class Items:
    """Signatures of one block of items."""

    def __init__(self, rows: list[tuple], size: int, threshold: float):
        self.threshold = threshold
        self.ids, self.words, self.sizes, self.hashes = [], [], [], []
        for item, text in rows:
            w = words(text or "")
            if w:
                self.ids.append(item)
                self.words.append(w)
                self.sizes.append(min(size, len(w)))
                self.hashes.append(shingle_hashes(word_hashes(text), self.sizes[-1]))
        self.tables: dict[tuple[int, int | None], tuple] = {}
        self.small = {s: any(len(h) <= SMALL for h, z in zip(self.hashes, self.sizes) if z == s) for s in set(self.sizes)}

    def table(self, size: int, cls: int | None) -> tuple:
        """A filter on leading bits, sorted hashes and their items: signatures for the documents of a size partition, or (None) all shingles of the small items."""
        if (size, cls) not in self.tables:
            of = [i for i in range(len(self.ids)) if self.sizes[i] == size and (len(self.hashes[i]) <= SMALL) == (cls is None)]
            signed = [self.hashes[i] if cls is None else minima(self.hashes[i], bits(cls)) for i in of]
            values = np.concatenate(signed) if signed else np.zeros(0, np.uint64)
            owner = np.repeat(of, [len(h) for h in signed]).astype(np.int64)
            order = np.argsort(values, kind="stable")
            maybe = np.zeros(1 << 20, bool)
            maybe[values >> np.uint64(44)] = True
            self.tables[size, cls] = maybe, values[order], owner[order]
        return self.tables[size, cls]

    def candidates(self, size: int, hashes: np.ndarray) -> set[int]:
        """Items that agree with a document's signature, and small items that share a shingle with it."""
        cls = size_class(len(hashes))
        sought = [(minima(hashes, bits(cls)), cls)] + ([(hashes, None)] if self.small[size] else [])
        near: set[int] = set()
        for signature, kind in sought:
            maybe, values, owner = self.table(size, kind)
            signature = signature[maybe[signature >> np.uint64(44)]]
            lo, hi = np.searchsorted(values, signature, "left"), np.searchsorted(values, signature, "right")
            near.update(int(owner[j]) for a, b in zip(lo[hi > lo], hi[hi > lo]) for j in range(a, b))
        return near

    def found(self, text: str, every: bool = False) -> list[tuple]:
        """(item, shared, shingles) of the items in a text; ``every``: all items are candidates."""
        w = word_hashes(text)
        out = []
        for size in sorted(set(self.sizes)):
            hashes = shingle_hashes(w, size)
            if not len(hashes):
                continue
            exact = None
            for i in [k for k, z in enumerate(self.sizes) if z == size] if every else sorted(self.candidates(size, hashes)):
                need = self.threshold * len(self.hashes[i]) - 1e-9
                if np.isin(self.hashes[i], hashes, assume_unique=True).sum() >= need:
                    if exact is None:
                        t = words(text)
                        exact = {tuple(t[k : k + size]) for k in range(len(t) - size + 1)}
                    mine = self.words[i]
                    own = {tuple(mine[k : k + size]) for k in range(len(mine) - size + 1)}
                    shared = len(own & exact)
                    if shared >= self.threshold * len(own) - 1e-9:
                        out.append((self.ids[i], shared, len(own)))
        return out


def leaks_type(kind: str) -> str:
    return f"array<struct<item_id:{kind},shared:int,shingles:int>>"


def as_leaks(found: list[tuple]) -> list[dict]:
    return [{"item_id": i, "shared": n, "shingles": m} for i, n, m in found]


def leaks(text: Column, items: list[tuple], kind: str, size: int, threshold: float) -> Column:
    """Items of one block that leak into each text."""

    @F.pandas_udf(leaks_type(kind))
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Items(items, size, threshold)
        for s in texts:
            yield pd.Series([as_leaks(block.found(t or "")) for t in s], dtype=object)

    return run(text)


def least_class(hashes: np.ndarray) -> np.ndarray:
    """For each of an item's sorted hashes the least size class from which on it is its bin's minimum; all 0 for small items.

    Bins only get finer with the class, so it stays the minimum: the class is told by the leading bits shared with the hash before it.
    """
    if len(hashes) <= SMALL:
        return np.zeros(len(hashes), np.int32)
    shared = np.array([64 - int(x).bit_length() for x in hashes[1:] ^ hashes[:-1]])
    # apart as soon as a bin has one bit more than they share: 64 - bits(c) > shared
    return np.concatenate(([0], shared)).astype(np.int32)


def joined_leaks(docs: DataFrame, items: DataFrame, kind: str, size: int, threshold: float, text: str, out: str) -> DataFrame:
    """The same for a benchmark of any size: by joins on signatures (with small items: on all shingles of the documents)."""
    doc_key, item_key = ["_ka", "_kb"], ["_ia", "_ib"]
    items = items.select("i", "t", F.xxhash64("i", "t").alias("_ia"), F.xxhash64(F.lit(7), "i", "t").alias("_ib"))

    def of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for a, c, t in zip(b["_ia"], b["_ib"], b["t"]):
                w = word_hashes(t)
                n = min(size, len(w))
                h = shingle_hashes(w, n) if n else w
                rows += [(a, c, n, x, k, len(h) <= SMALL) for x, k in zip(h.view(np.int64).tolist(), least_class(h).tolist())]
            yield pd.DataFrame(rows, columns=["_ia", "_ib", "size", "hash", "from_class", "small"])

    signed = items.mapInPandas(of_items, "_ia long, _ib long, size int, hash long, from_class int, small boolean")
    kinds = [tuple(r) for r in signed.select("size", "small").distinct().collect()]  # two for each size of shingle at most

    def of_docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for a, c, t in zip(b["_ka"], b["_kb"], b["text"]):
                w = word_hashes(t)
                for n in {k for k, _ in kinds}:
                    h = shingle_hashes(w, n)
                    cls = size_class(len(h))
                    low = minima(h, bits(cls))
                    sent = h if (n, True) in kinds else low
                    rows.append(pd.DataFrame({"_ka": a, "_kb": c, "size": n, "hash": sent.view(np.int64), "class": np.where(np.isin(sent, low, assume_unique=True), cls, -1)}))
            yield pd.concat(rows) if rows else pd.DataFrame([], columns=["_ka", "_kb", "size", "hash", "class"])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select("text", *text_key(F.col("text")))
    sent = texts.select(*doc_key, "text").mapInPandas(of_docs, "_ka long, _kb long, size int, hash long, class int")
    near = sent.join(signed, ["size", "hash"]).filter(F.col("small") | (F.col("class") >= F.col("from_class"))).select(*doc_key, *item_key).distinct()
    # a document's candidates are verified in lots, so that a task never holds the texts of all of them
    lots = near.groupBy(*doc_key).agg((1 + F.floor(F.count("*") / VERIFIED_ITEMS)).alias("_lots"))
    dealt = near.join(lots, doc_key).withColumn("_lot", F.pmod(F.xxhash64(*item_key), F.col("_lots")))
    asked = dealt.join(items.dropDuplicates(["i", "t"]), item_key).groupBy(*doc_key, "_lot").agg(F.collect_list(F.struct("i", "t")).alias("_items"))

    @F.pandas_udf(leaks_type(kind))
    def verify(texts: pd.Series, asked: pd.Series) -> pd.Series:
        return pd.Series([as_leaks(Items([(x["i"], x["t"]) for x in a], size, threshold).found(t, every=True)) for t, a in zip(texts, asked)], dtype=object)

    found = texts.dropDuplicates(doc_key).join(asked, doc_key).select(*doc_key, verify("text", "_items").alias("_found"))
    one = found.groupBy(*doc_key).agg(F.array_sort(F.flatten(F.collect_list("_found"))).alias("_found"))
    keyed = docs.withColumn("_key", F.struct(*text_key(F.col(text))))
    joined = keyed.join(one.select(F.struct(*doc_key).alias("_key"), "_found"), "_key", "left")
    return joined.withColumn(out, F.coalesce("_found", F.array().cast(leaks_type(kind)))).drop("_key", "_found")


def with_leaks(docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "leaks") -> DataFrame:
    """``docs`` with the array of items (item_id, shared, shingles) that leak into each document.

    ``item_id`` may be of any type with an order. An item of fewer than ``size`` words is one shingle, its whole sequence of words.
    Items and documents without words, null texts among them, match nothing;
    items repeated in id and text are reported once, repeated documents answered alike; other
    columns pass through (one named ``out`` is replaced). Very long texts are searched whole. Without items, every array is empty.
    """
    spark = docs.sparkSession
    prepare(spark)
    items = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).filter(F.col("t").isNotNull()).distinct()
    kind = items.schema["i"].dataType.simpleString()
    n, size_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    if n > BLOCK_ITEMS or size_bytes > BLOCK_BYTES:
        return joined_leaks(docs, items, kind, size, threshold, text, out)
    return docs.withColumn(out, leaks(F.col(text), [tuple(r) for r in items.collect()], kind, size, threshold))


def leaking_pairs(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """doc_id, item_id, shared, shingles, containment: a row per document and item that leaks into it."""
    return (
        with_leaks(docs, benchmark, out="_leaks", **options)
        .select(F.col(doc_id).alias("doc_id"), F.explode("_leaks").alias("l"))
        .select("doc_id", "l.*", F.round(F.col("l.shared") / F.col("l.shingles"), 6).alias("containment"))
    )
