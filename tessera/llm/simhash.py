"""SimHash fingerprints and their near-duplicate classes, by meet-in-the-middle ball hashing.

Fingerprints link at ``RADIUS`` or fewer differing bits. Two such fingerprints have
a word in the middle, within half the radius of both: each fingerprint emits all
words within half the radius, and fingerprints that emit the same word collide.
The other way round, what meets at a word lies within the radius by the triangle
inequality (verified all the same), so a word's fingerprints form a chain of
links: no pairs within a group are listed, however large it is.

The words need not be shuffled one by one. They are dealt by their first
``PREFIX`` bits: a fingerprint goes once to every prefix that one of its words
has (137 rows instead of 2081 words for 16 bits), with the radius left for the
other bits, and the words themselves are made and sorted inside the tasks. Each task sends on
a spanning forest of its collisions, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components, least_of_component
from tessera.llm.runtime import keep, prepare

SHINGLE = 4
SEED = 42
RADIUS = 4
PREFIX = 16
SLAB = 1 << 21
_LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """64-bit word whose bits are set in over half of the hashes (none: zero)."""
    n = len(hashes)
    if n == 0:
        return 0
    starts = np.arange(0, n, 255)
    out = 0
    for bit in range(8):
        # eight counters side by side in each sum of up to 255 hashes
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, starts)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for lane in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(lane) + bit)
    return out


def shingles(text: str, size: int = SHINGLE) -> list[bytes]:
    """Shingles of ``size`` words, repeats included: A-Z lower-cased, words split at ASCII white space, joined by spaces."""
    words = text.encode().lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [joined[s : e - 1] for s, e in zip(ends, ends[size:])]


def fingerprint_of(text: str, size: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles(text, size)), np.uint64)
    return majority(hashes)


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """SimHash of a text as a signed long; null and wordless texts give 0."""

    @F.pandas_udf("long")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([fingerprint_of(t or "", size) for t in s], np.uint64).view(np.int64))

    return run(text)


def masks(bits: int, radius: int) -> list[int]:
    """Words of ``bits`` bits with at most ``radius`` set."""
    return [sum(1 << i for i in c) for k in range(radius + 1) for c in combinations(range(bits), k)]


_masks: dict[tuple[int, int], np.ndarray] = {}


def mask_array(bits: int, radius: int) -> np.ndarray:
    if (bits, radius) not in _masks:
        _masks[bits, radius] = np.array(masks(bits, radius), np.uint64)
    return _masks[bits, radius]


def collisions(words: np.ndarray, left: np.ndarray, owner: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of owners that share a word within ``left[i]`` of ``words[i]`` in the low ``bits`` bits: chains, not all pairs.

    Beyond SLAB words at once, the next bit splits the work: words with that bit
    set and not set are made apart.
    """
    sizes = np.array([len(mask_array(bits, r)) for r in range(int(left.max()) + 1)])[left]
    if sizes.sum() > SLAB and bits > 0 and len(words) > 1:
        bit = np.uint64(1 << (bits - 1))
        for side in (np.uint64(0), bit):
            stays = (words & bit) == side
            new_left = np.where(stays, left, left - 1)
            ok = new_left >= 0
            if ok.sum() > 1:
                yield from collisions((words[ok] & ~bit) | side, new_left[ok], owner[ok], bits - 1)
        return
    made, by = [], []
    for r in np.unique(left):
        own = left == r
        m = mask_array(bits, int(r))
        made.append((words[own][:, None] ^ m[None, :]).ravel())
        by.append(np.repeat(owner[own], len(m)))
    made, by = np.concatenate(made), np.concatenate(by)
    order = np.argsort(made)
    same = np.flatnonzero(made[order[1:]] == made[order[:-1]])
    a, b = by[order[same]], by[order[same + 1]]
    yield a[a != b], b[a != b]


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each node's component, for nodes 0..n-1."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], m)
        np.minimum.at(new, label[b], m)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def forest(prefix_bits: int, radius: int):
    """Links among one task's rows (bucket, left, fp), which come in order of their buckets.

    Whole buckets go through memory together, up to about SLAB words, and each lot sends on a spanning forest of its collisions.
    """
    low = 64 - prefix_bits
    sizes = np.array([len(mask_array(low, r)) for r in range(radius // 2 + 1)])

    def lot(bucket: np.ndarray, left: np.ndarray, fp: np.ndarray) -> pa.RecordBatch | None:
        fps, owner = np.unique(fp, return_inverse=True)
        words = (bucket.astype(np.uint64) << np.uint64(low)) | (fp.view(np.uint64) & np.uint64((1 << low) - 1))
        edges = []
        for a, b in collisions(words, left, owner, low):
            near = np.bitwise_count(fps.view(np.uint64)[a] ^ fps.view(np.uint64)[b]) <= radius
            edges.append(np.unique(np.minimum(a, b)[near] * np.int64(len(fps)) + np.maximum(a, b)[near]))
        pairs = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        if not len(pairs):
            return None
        label = least_labels(len(fps), pairs // len(fps), pairs % len(fps))
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[label[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        waiting, asked = 0, SLAB
        for b in batches:
            if not b.num_rows:
                continue
            now = b.column("bucket").to_numpy().astype(np.int64), b.column("left").to_numpy().astype(np.int64), b.column("fp").to_numpy()
            held.append(now)
            waiting += int(sizes[now[1]].sum())
            if waiting >= asked:
                bucket, left, fp = (np.concatenate(x) for x in zip(*held))
                # the last bucket may go on
                cut = int(np.searchsorted(bucket, bucket[-1]))
                if cut:
                    found = lot(bucket[:cut], left[:cut], fp[:cut])
                    if found is not None:
                        yield found
                held = [(bucket[cut:], left[cut:], fp[cut:])]
                waiting = int(sizes[left[cut:]].sum())
                # a bucket that goes on is put together again only after it has doubled
                asked = max(SLAB, 2 * waiting)
        if held:
            found = lot(*(np.concatenate(x) for x in zip(*held)))
            if found is not None:
                yield found

    return run


def prefix_for(n: int) -> int:
    """Bits by which words are dealt for ``n`` fingerprints, so that a bucket holds about 100,000 rows at most: PREFIX or more, 32 at most."""
    return min(32, max(PREFIX, n.bit_length() - 9))


def link_forest(fps: DataFrame, radius: int = RADIUS, prefix: int | None = None) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints (column ``fp``) within ``radius`` bits, and no others."""
    prefix = prefix or prefix_for(fps.count())
    cover = masks(prefix, radius // 2)
    spread = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(radius // 2 - m.bit_count()).alias("left")) for m in cover]))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a fixed number of partitions: few fingerprints become many rows
    dealt = fps.select("fp").repartition(n, "fp").select("fp", spread.alias("s")).select(F.shiftrightunsigned("fp", 64 - prefix).bitwiseXOR(F.col("s.m")).alias("bucket"), "s.left", "fp")
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(forest(prefix, radius), "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE, prefix: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (least doc_id reachable over links, itself included).

    Documents with equal fingerprints, wordless and null texts among them (0), are
    linked. Repeated rows give repeated rows. Null doc_ids are kept; they are the
    component_id only where a component has no other. Other columns are not read.
    An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = keep(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), size).alias("fp")))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = components(link_forest(rows.select("fp").distinct(), radius, prefix))
    of_fp = least_of_component(least, labels, "fp", "least").withColumnRenamed("least", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def fingerprint_classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
