"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent 1- to 3-grams of letters (words padded
by a blank), most frequent first. A document's own profile is compared to that
of each language by the out-of-place distance: the difference of ranks, summed
over the document's n-grams, and the greatest difference for those that the
language's profile lacks. The nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.runtime import prepare

RANKS = 400
PER_LANGUAGE = 4000
UNKNOWN = "und"
_BITS = np.uint64(21)
# markers above all code points, so that 1-, 2- and 3-grams never share a code
_ONE, _TWO = np.uint64(0x1FFFFF << 42), np.uint64(0x1FFFFE << 42)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, repeats included; empty if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    padded = np.zeros(len(codes) + 2, np.uint64)
    padded[1:-1] = np.where(is_letter, codes, 0)
    c = padded[np.concatenate(([True], (padded[1:] != 0) | (padded[:-1] != 0)))]
    if len(c) < 3:
        return np.zeros(0, np.uint64)
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate((c[c != 0] | _ONE, two | _TWO, three[c[1:-1] != 0]))


def top(text: str, ranks: int) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first, ties by code."""
    codes, counts = np.unique(ngrams(text), return_counts=True)
    return codes[np.argsort(-counts, kind="stable")[:ranks]]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", ranks: int = RANKS, per_language: int = PER_LANGUAGE) -> list[tuple[str, list[int]]]:
    """Profiles (language, n-gram codes in rank order) of the labelled rows of ``docs``.

    ``per_language`` bounds the sample: languages with more labelled rows keep
    each row with a chance of per_language / rows, by a hash of ``key`` and text.
    What reaches the driver is ``ranks`` codes per language. Rows with null text or
    language are left out.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).filter("text is not null and lang is not null")
    sizes = docs.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
    sample = rows.join(F.broadcast(sizes), "lang").filter(F.pmod(F.xxhash64("key", F.substring("text", 1, 64)), F.lit(1 << 20)) * F.col("n") < per_language * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, group in b.groupby("lang", sort=False):
                codes, counts = np.unique(np.concatenate([ngrams(t) for t in group["text"]]), return_counts=True)
                yield pd.DataFrame({"lang": name, "code": codes.view(np.int64), "n": counts})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "code"))).filter(F.col("rank") <= ranks)
    found: dict[str, list[int]] = {}
    for r in ranked.orderBy("lang", "rank").collect():
        found.setdefault(r["lang"], []).append(r["code"])
    return sorted(found.items())


PREDICTION = "lang string, score double"


def predict(text: Column, profiles: list[tuple[str, list[int]]], ranks: int = RANKS) -> Column:
    """Struct (lang, score) of each text; ``und`` with score 0 for null and for texts without a letter, or without profiles.

    ``score`` is 1 minus the mean out-of-place distance to the chosen language as a
    share of the greatest. Ties go to the language that sorts first.
    """

    @F.pandas_udf(PREDICTION)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [n for n, _ in profiles]
        known = np.unique(np.concatenate([np.array(c, np.int64) for _, c in profiles]).view(np.uint64)) if profiles else np.zeros(0, np.uint64)
        # rank of each known n-gram by language; far beyond all ranks where a profile lacks it
        table = np.full((len(names), len(known) + 1), 10 * ranks, np.int64)
        for i, (_, codes) in enumerate(profiles):
            table[i, np.searchsorted(known, np.array(codes, np.int64).view(np.uint64))] = np.arange(len(codes))
        for s in texts:
            out = []
            for t in s:
                mine = top(t, ranks) if t else ()
                if len(mine) == 0 or not names:
                    out.append((UNKNOWN, 0.0))
                    continue
                at = np.searchsorted(known, mine)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != mine)] = len(known)
                away = np.minimum(np.abs(table[:, at] - np.arange(len(mine))), ranks).sum(axis=1)
                best = int(np.argmin(away))
                out.append((names[best], 1.0 - float(away[best]) / (ranks * len(mine))))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return run(text)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id counts as the empty text, so it is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the rows that aren't held out.

    Null and letterless texts are ``und`` with score 0; repeated rows get equal results, and count as often as they stand when learning; whole texts are
    profiled, however long. Null ids are held out. Without a labelled row every prediction is ``und``. Other columns are not read. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    profiles = fit(docs.filter(~held_out(F.col(doc_id))), text, lang, doc_id)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), predict(F.col(text), profiles).alias("_p"))
    return rows.select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
