"""Document fingerprints by winnowing.

The rolling hashes of all k-grams of characters slide past windows of w hashes;
each window keeps its least hash, the rightmost on ties. Any match of at least
w + k - 1 characters between two texts leaves a common hash in both, and none
shorter than k does. Positions are kept, so a common hash leads to the match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.rolling import distinct_runs, mix, prefixes, sliding_argmin, stretch
from tessera.llm.runtime import cuts, prepare

GRAM = 12
WINDOW = 20
ROWS_PER_RANGE = 2000
MAX_RANGES = 1 << 16


def points(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def winnow(codes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, in order of position.

    A text shorter than ``gram`` has one hash, of all of it; with fewer than
    ``window`` grams there is one window; an empty text has none.
    """
    if len(codes) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    sums = prefixes(mix(codes.astype(np.uint64) + np.uint64(1)))
    gram = min(gram, len(codes))
    start = np.arange(len(codes) - gram + 1)
    hashes = stretch(sums, start, start + gram)
    at = distinct_runs(sliding_argmin(hashes, min(window, len(hashes))))
    return hashes[at], at


def digest(hashes: np.ndarray, at: np.ndarray) -> str:
    """128-bit digest of hashes and positions, in hexadecimal."""
    h = hashlib.blake2b(hashes.astype("<u8").tobytes(), digest_size=16)
    h.update(at.astype("<i4").tobytes())
    return h.hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes (sorted, distinct); 1 if both are empty."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Winnowed hashes of each text, ``array<struct<hash, position>>``; null and empty texts give an empty array."""

    @F.pandas_udf("array<struct<hash:long,position:int>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            kept = (winnow(points(t or ""), gram, window) for t in s)
            yield pd.Series([[{"hash": h, "position": p} for h, p in zip(hs.view(np.int64).tolist(), at.tolist())] for hs, at in kept], dtype=object)

    return run(text)


def ranges(docs: DataFrame, doc_id: str) -> tuple[Column, list[tuple]]:
    """Range number of a row by descending id, and for each range in order its first id (any type with an order, or null).

    The cuts are approximate quantiles, one per ROWS_PER_RANGE rows, at most
    MAX_RANGES; only they and the first ids reach the driver.
    """
    n = docs.count()
    bins = min(MAX_RANGES, n // ROWS_PER_RANGE + 1)
    found = sorted(set(cuts(docs, doc_id, bins)))
    side = max(1, int(len(found) ** 0.5))
    groups = [found[i : i + side] for i in range(0, len(found), side)]
    value = F.col(doc_id)
    below = lambda values: F.size(F.filter(values, lambda c: c < value))
    if not found:
        number = F.lit(0)
    else:
        group = below(F.array(*[F.lit(g[-1]) for g in groups]))
        inside = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group)
        number = F.lit(len(found)) - (group * side + F.when(inside.isNull(), 0).otherwise(below(inside)))
        number = F.when(value.isNull(), len(found)).otherwise(number)
    heads = docs.select(value.alias("id"), number.alias("range")).groupBy("range").agg(F.max("id").alias("head"))
    return number, sorted((r["range"], r["head"]) for r in heads.collect())


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (range, guest, doc_id, order, text) such that within a range, in this order, each row's next document follows it.

    Ids descend, null last; equal ids go by a hash of the text. The first row of
    each range is also a guest at the end of the range before it (the very first
    one at the end of the last range). Texts are shuffled once.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    number, heads = ranges(rows, "doc_id")
    rows = rows.select(number.cast("int").alias("range"), F.lit(False).alias("guest"), "doc_id", F.xxhash64("text").alias("order"), "text")
    if not heads:
        return rows
    hosts = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}
    ids = [h for _, h in heads]
    kind = dict(docs.select(F.col(doc_id).alias("doc_id")).dtypes)["doc_id"]
    first = docs.sparkSession.createDataFrame([(r, hosts[r], h) for r, h in heads], f"range int, host int, head {kind}")
    candidates = rows.filter(F.col("doc_id").isin([i for i in ids if i is not None]) | F.col("doc_id").isNull())
    same = (candidates["range"] == first["range"]) & candidates["doc_id"].eqNullSafe(first["head"])
    starts = candidates.join(F.broadcast(first), same).select(candidates["*"], "host")
    # among equal ids the first by hash; copies of it are all the same
    least = starts.groupBy("host").agg(F.min("order").alias("least"))
    one = starts.join(F.broadcast(least), "host").filter("order = least").dropDuplicates(["host"])
    return rows.unionByName(one.select(F.col("host").alias("range"), F.lit(True).alias("guest"), "doc_id", "order", "text"))


RESULT = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_kept int"


def compare(gram: int, window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            out = []
            for rng, doc_id, guest, text in zip(b["range"], b["doc_id"], b["guest"], b["text"]):
                codes = points(text)
                hashes, at = winnow(codes, gram, window)
                mine = np.unique(hashes)
                if held is not None and held[0] == rng:
                    _, before, its_codes, its_hashes, its_at, its_set = held
                    half = len(its_codes) // 2
                    edited = np.concatenate((its_codes[: len(its_codes) - half], codes[:half]))
                    e_hashes, e_at = winnow(edited, gram, window)
                    sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode()).hexdigest()
                    out.append((before, len(its_codes), sha, digest(its_hashes, its_at), digest(e_hashes, e_at), likeness(its_set, np.unique(e_hashes)), likeness(its_set, mine), len(its_hashes)))
                held = None if guest else (rng, doc_id, codes, hashes, at, mine)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_kept"])

    return run


def edited_fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each document and of its edited text.

    The edited text has the last floor(n/2) characters replaced by the first as
    many (or all) of the next document by descending id; the last is followed by
    the first, a single document by itself. One row per document: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_kept
    (number of hashes kept). Null texts count as empty, null ids come last, rows
    with equal ids go by a hash of the text. Other columns are not read. An empty
    table gives an empty result.
    """
    prepare(docs.sparkSession)
    kind = dict(docs.select(F.col(doc_id).alias("doc_id")).dtypes)["doc_id"]
    rows = with_next(docs, doc_id, text).repartition("range").sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), "order")
    # ids travel as text: null among integers would turn them into floats
    found = rows.select("range", "guest", F.col("doc_id").cast("string"), "text").mapInPandas(compare(gram, window), RESULT)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
