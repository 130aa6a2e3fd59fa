"""Exact repeats of long byte strings, by prefix-free parsing.

A byte is repeated if a string of ``length`` bytes covers it that also starts
anywhere else in the corpus. Suffix order answers this by comparing neighbours;
here only the first ``length`` bytes of a suffix matter, so suffixes need equal
names for equal beginnings, not a full order:

1. *Parse.* Rolling hashes of 8-grams trigger phrase starts where the hash is the
   smallest of ``window(length)`` (rightmost on ties). Every window in the middle of
   a string holds one, whatever the text, and the string alone tells which.
2. *Dictionary and parse.* Every string of ``length`` bytes belongs to the trigger
   of its middle window. The bytes around the trigger that
   all its strings share name it (the truncated suffix of the parse); a name that
   stands once in the corpus ends all its strings. Where all strings of a trigger
   (a longer name) recur together they are repeated, without a look at each.
3. *Corpus order.* Only what is left, the edges of repeated stretches, is expanded
   into single strings, which are named by 128 bits and counted.

A full suffix array of the dictionary would be as large as a corpus that repeats
little, and its order is not needed for equality; hence names instead of ranks.
A name is two 64-bit polynomial hashes: bytes are not compared.

Strings of a greater length are sought only inside the stretches that strings of a
smaller one cover, so a second length costs a share of the first.

The text itself is shuffled once, by its 128-bit key; what returns to it are
byte ranges. Equal texts share a key, so copies are searched once per place and
their rows answered together. Hot strings meet as counts over (name) keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.rolling import mix, prefixes, sliding_argmin, stretch
from tessera.llm.runtime import prepare, text_key

LENGTH = 400
#: About the least length in bytes of a passage of 50 words.
PASSAGE = 240
LEAST = 32
GRAM = 8
BLOCK = 1 << 20
_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def blocks(data: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping blocks of bounded size. Each string of ``length`` bytes that starts in [offset, offset + BLOCK) is inside its block.
    """
    codes = np.frombuffer(data, np.uint8)
    for at in range(0, max(len(codes) - length + 1, 0), BLOCK):
        yield at, codes[at : at + BLOCK + length - 1]


def window(length: int) -> int:
    """Grams among which the trigger of a string is chosen: about half the string, so that all strings of a trigger share the other half."""
    if length < LEAST:
        raise ValueError(f"strings of fewer than {LEAST} bytes are not sought")
    return length // 2


def anchors(codes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each trigger that owns strings: its name, the name of all its strings together, first and last start.

    A string belongs to the least hash of the ``window(length)`` grams in its middle.
    """
    if len(codes) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.lib.stride_tricks.sliding_window_view(codes, GRAM)
    words = np.ascontiguousarray(grams).view(np.uint64).ravel()
    wide = window(length)
    lead = (length - wide - GRAM + 1) // 2
    # the trigger of each string, by its start
    at = sliding_argmin((mix(words) >> np.uint64(32)).astype(np.uint32), wide)[lead : lead + len(codes) - length + 1].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:], [len(at)])) - 1
    p = at[first]
    sums = prefixes(_TABLE[codes])
    # strings start lead to lead + wide - 1 before their trigger: the bytes common to all of them
    name = stretch(sums, p - lead, p - lead - wide + 1 + length)
    whole = mix(stretch(sums, first, last + length) + ((p - first) << 32 | (p - last)).astype(np.uint64))
    return name, whole, first, last


ANCHORS = "name long, whole long, _ka long, _kb long, lo int, hi int, times int"


def settle(name: np.ndarray, whole: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names to be dealt by, and how often each place counts, for the places of one document.

    Of places equal in name and whole the first stands for all and counts twice:
    enough for others elsewhere. The rest recur already and need not meet any
    others, so they count twice as well, under names of their own. A line that a
    document repeats thus sends one row to its task, however often it stands there.
    """
    order = np.lexsort((whole, name))
    n, w = name[order], whole[order]
    same = (n[1:] == n[:-1]) & (w[1:] == w[:-1])
    again = np.concatenate(([False], same))
    times = np.ones(len(name), np.int32)
    times[order] = np.where(again | np.concatenate((same, [False])), 2, 1)
    name = name.copy()
    rest = order[again]
    name[rest] = mix(name[rest] ^ apart[rest])
    return name, times


def find_anchors(length: int):
    """Anchors of whole texts, or only of their ``runs`` (start * 2**32 + end) where there is such a column."""

    def parts(data: bytes, runs) -> Iterator[tuple]:
        for run in [len(data)] if runs is None else runs:
            start, end = int(run) >> 32, int(run) & 0xFFFFFFFF
            for at, codes in blocks(data[start:end], length):
                yield *anchors(codes, length), start + at

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for ka, kb, text, runs in zip(b["_ka"], b["_kb"], b["text"], b["runs"] if "runs" in b else repeat(None)):
                found = list(parts(text.encode(), runs))
                if found:
                    name, whole = (np.concatenate([p[i] for p in found]) for i in (0, 1))
                    lo, hi = (np.concatenate([p[i] + p[4] for p in found]) for i in (2, 3))
                    name, times = settle(name, whole, mix(lo.astype(np.uint64)) ^ np.uint64(ka & 0xFFFFFFFFFFFFFFFF))
                    out.append((name, whole, np.full(len(lo), ka), np.full(len(lo), kb), lo, hi, times))
            if out:
                name, whole, ka, kb, lo, hi, times = map(np.concatenate, zip(*out))
                yield pd.DataFrame({"name": name.view(np.int64), "whole": whole.view(np.int64), "_ka": ka, "_kb": kb, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32), "times": times})

    return run


STRINGS = "name long, part int, _ka long, _kb long, at int, hashes array<long>"
#: Strings of a place that travel together; equal strings stand equally far before their trigger, so they meet.
SLICE = 32


def expand(length: int):
    """Hashes of the single strings of the places listed in ``open`` (name, lo, hi), in slices by the distance to the trigger."""
    wide = window(length)
    lead = (length - wide - GRAM + 1) // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for ka, kb, text, places in zip(b["_ka"], b["_kb"], b["text"], b["open"]):
                codes = np.frombuffer(text.encode(), np.uint8)
                for at in range(0, len(codes), BLOCK):
                    # places start in their own block: hash only what these cover
                    own = [x for x in places if at <= x["lo"] < at + BLOCK]
                    if not own:
                        continue
                    part = codes[at : max(x["hi"] for x in own) + length]
                    sums = prefixes(_TABLE[part])
                    for x in own:
                        lo, hi = x["lo"] - at, x["hi"] - at
                        s = np.arange(lo, hi + 1)
                        hashes = stretch(sums, s, s + length).view(np.int64)
                        grams = np.lib.stride_tricks.sliding_window_view(part[lo + lead : lo + lead + wide + GRAM - 1], GRAM)
                        order = (mix(np.ascontiguousarray(grams).view(np.uint64).ravel()) >> np.uint64(32))[::-1]
                        # distance of the first string to the trigger, beyond the least
                        away = wide - 1 - int(np.argmin(order))
                        edges = [0, *range(away % SLICE + 1, hi - lo + 1, SLICE), hi - lo + 1]
                        rows += [(x["name"], (away - i) // SLICE, ka, kb, x["lo"] + i, hashes[i:j]) for i, j in zip(edges, edges[1:])]
            yield pd.DataFrame(rows, columns=["name", "part", "_ka", "_kb", "at", "hashes"])

    return run


def covered(ranges, length: int) -> np.ndarray:
    """Maximal runs (start * 2**32 + end) of bytes covered by strings that start in the ranges (lo * 2**32 + hi - lo)."""
    packed = np.sort(np.asarray(ranges, np.int64))
    lo = packed >> 32
    end = np.maximum.accumulate(lo + (packed & 0xFFFFFFFF) + length)
    new = np.concatenate(([True], lo[1:] > end[:-1]))
    return lo[new] << 32 | end[np.concatenate((new[1:], [True]))]


def spans(runs) -> list[tuple[int, int]]:
    return [] if runs is None else [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in runs]


def repeated_runs(docs: DataFrame, length: int, within: DataFrame | None = None) -> DataFrame:
    """Per distinct text (key ``_ka``, ``_kb``): ``runs``, its repeated bytes as array of start * 2**32 + end, end exclusive.

    ``docs`` has the columns of :func:`prepared`. Texts without a repeat have no row.
    ``within``: the result for a smaller length; only its runs are searched, as all shorter strings in a repeated one are repeated.
    """
    key = ["_ka", "_kb"]
    searched = docs.select(*key, "text")
    if within is not None:
        # doc_id comes along so that all joins read one and the same shuffle of the texts; no filter on the runs, which
        # would make them anew (runs that are too short have no anchors)
        searched = docs.join(within.select(*key, "runs"), key).select("doc_id", *key, "text", "runs")
    found = searched.mapInPandas(find_anchors(length), ANCHORS)
    same_whole, same_name = W.partitionBy("name", "whole"), W.partitionBy("name")
    counted = (
        found.withColumn("n_whole", F.sum("times").over(same_whole))
        .withColumn("first", F.row_number().over(same_whole.orderBy("_ka", "_kb", "lo")) == 1)
        .withColumn("n_name", F.sum("times").over(same_name))
        .filter("n_name > 1")
    )
    # settled: all strings of the place recur elsewhere. open: to be looked at one by one; with
    # them one place of each settled kind under the same name, as what they may be equal to
    settled = F.col("n_whole") > 1
    is_open = (F.col("n_whole") < F.col("n_name")) & (~settled | F.col("first"))
    # ranges travel as single longs; sets, because copies of a text send the same ones. Both kinds in one
    # column and a fixed number of partitions for the strings: so what two readers share is made once.
    # Start and length, not start and end: a set hashes a long by the xor of its halves, which is 0 wherever these are equal
    packed = lambda lo, hi: F.shiftleft(lo.cast("long"), 32) + (hi - lo)
    place = F.struct(F.when(settled, packed(F.col("lo"), F.col("hi"))).alias("settled"), F.when(is_open, F.struct("name", "lo", "hi")).alias("open"))
    listed = counted.groupBy(*key).agg(F.collect_set(F.when(settled | is_open, place)).alias("places"))
    part_of = lambda what: F.transform(F.filter("places", lambda x: x[what].isNotNull()), lambda x: x[what])
    strings = (
        docs.join(listed.select(*key, part_of("open").alias("open")).filter(F.size("open") > 0), key)
        .select("doc_id", *key, "text", "open")
        .mapInPandas(expand(length), STRINGS)
        .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name", "part")
        .select("name", "part", *key, "at", F.posexplode("hashes").alias("i", "hash"))
        .select("name", "part", "hash", *key, (F.col("at") + F.col("i")).alias("at"))
    )
    again = strings.withColumn("n", F.count("*").over(W.partitionBy("name", "part", "hash"))).filter("n > 1")
    single = again.groupBy(*key).agg(F.collect_set(packed(F.col("at"), F.col("at"))).alias("ranges"))
    both = listed.select(*key, part_of("settled").alias("ranges")).filter(F.size("ranges") > 0).unionByName(single)

    @F.pandas_udf("array<long>")
    def merged(ranges: pd.Series) -> pd.Series:
        return pd.Series([covered(r, length) for r in ranges], dtype=object)

    return both.groupBy(*key).agg(F.flatten(F.collect_list("ranges")).alias("ranges")).select(*key, merged("ranges").alias("runs"))


def prepared(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select("doc_id", "text", *text_key(F.col("text")))


def with_runs(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text (null as empty), runs: the document's repeated bytes (see :func:`repeated_runs`), null if it has none."""
    prepare(docs.sparkSession)
    rows = prepared(docs, doc_id, text)
    return rows.join(repeated_runs(rows, length), ["_ka", "_kb"], "left").select("doc_id", "text", "runs")


def with_spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, spans: for each document its repeated bytes as ``array<struct<start, end>>`` (UTF-8 offsets, end exclusive).

    Overlaps count, the document's own repeats count, matches never cross
    documents. A null text is taken as empty and, as any text shorter than
    ``length`` bytes, has no spans; repeated rows repeat each other in full. Very long
    texts are searched in blocks. ``length`` is ``LEAST`` bytes at least. Other
    columns of ``docs`` are not read. An empty table gives an empty result.
    """
    as_struct = lambda r: F.struct(F.shiftright(r, 32).cast("int").alias("start"), r.bitwiseAND(0xFFFFFFFF).cast("int").alias("end"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return with_runs(docs, length, doc_id, text).select("doc_id", "text", F.coalesce(F.transform("runs", as_struct), none).alias("spans"))


DIGEST = "n_removed long, n_spans long, kept_sha256 string"


def removal_digests(docs: DataFrame, length: int = LENGTH, passage: int = PASSAGE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes outside its spans, n_repeated.

    Spans as in :func:`with_spans`; ``n_repeated`` counts the bytes covered by repeated strings of ``passage`` bytes
    (``length`` at most), of which only those also covered by strings of ``length`` bytes are removed.
    """

    @F.pandas_udf(DIGEST)
    def digest(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = []
        for t, r in zip(texts, runs):
            data, at, h, gone, own = t.encode(), 0, hashlib.sha256(), 0, spans(r)
            for start, end in own:
                h.update(data[at:start])
                at = end
                gone += end - start
            h.update(data[at:])
            rows.append((gone, len(own), h.hexdigest()))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])

    prepare(docs.sparkSession)
    rows, key = prepared(docs, doc_id, text), ["_ka", "_kb"]
    shorter = repeated_runs(rows, min(passage, length))
    longer = repeated_runs(rows, length, within=shorter)
    bytes_of = F.aggregate("shorter", F.lit(0).cast("long"), lambda n, r: n + r.bitwiseAND(0xFFFFFFFF) - F.shiftright(r, 32))
    found = rows.join(longer, key, "left").join(shorter.withColumnRenamed("runs", "shorter"), key, "left")
    found = found.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.coalesce(bytes_of, F.lit(0)).alias("n_repeated"), digest("text", "runs").alias("_d"))
    return found.select("doc_id", "n_bytes", "_d.*", "n_repeated")


def remainder():
    """Column function (text, runs) -> the text without its repeated strings."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else cut(t, spans(r)) for t, r in zip(texts, runs)], dtype=object)

    return run


def cut(text: str, own) -> str:
    """The text without its spans; a character that a span covers only in part stays."""
    data, at, kept = text.encode(), 0, []
    for start, end in own:
        while start < len(data) and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        kept.append(data[at:start])
        at = max(end, start)
    kept.append(data[at:])
    return b"".join(kept).decode()
