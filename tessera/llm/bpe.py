"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

A text is cut before encoding only where a non-space character is followed by
white space: no match of the pre-splitting pattern spans such a place, and no
look-ahead of the left part sees past it, so the ids of the parts joined are the
ids of the whole. Parts are bounded (``PART_CHARS``, extended to the next safe
place), which keeps the encoder's memory bounded for texts of any length.
Decoding joins the raw bytes of the ids; bytes are never decoded one id at a time.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import prepare

PART_CHARS = 1 << 18
_SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])")
_PROBE = ["a", "Z", "é", "日", "7", "'", "'s", ".", "!?", "_", "🙂", "\u0301"]
_cache: dict = {}


@functools.cache
def cuts_safely(pattern: str) -> bool:
    """Whether a pre-splitting pattern keeps a non-space and the white space behind it apart, as far as probes of all kinds of characters tell; if not, texts are encoded whole."""
    import regex

    split = regex.compile(pattern)
    probes = (a + b + space + c for a in ("", " ", "a", "\n") for b in _PROBE for space in (" ", "\t", "\r\n", "\n\n", "  ") for c in ("", "b", "9", ".", "\n"))
    return not any(_SAFE.search(m.group(), 1) for p in probes for m in split.finditer(p))


def load(path: str, pattern: str):
    """The encoding of a rank file (lines of base64 token and rank), one per worker process."""
    import tiktoken

    if (path, pattern) not in _cache:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _cache[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _cache[path, pattern]


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Consecutive parts of at least ``size`` characters (the last may be shorter), cut at safe places."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode_text(encoding, text: str, size: int = PART_CHARS) -> list[int]:
    """Ids of a whole text, without special tokens."""
    if len(text) <= size or not cuts_safely(encoding._pat_str):
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text, size):
        ids += encoding.encode_ordinary(part)
    return ids


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with an ``array<int>`` of token ids; a null text counts as empty, an empty text gives an empty array.

    Rows are independent: repeated rows give repeated results, other columns pass
    through untouched (a column already named ``out`` is replaced).
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def ids_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = load(path, pattern)
        for s in texts:
            yield pd.Series([encode_text(enc, t or "") for t in s], dtype=object)

    return docs.withColumn(out, ids_of(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``docs`` with the raw bytes of an id array; null ids give empty bytes. Ids outside the vocabulary fail the task."""
    prepare(docs.sparkSession)

    @F.pandas_udf("binary")
    def bytes_of(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = load(path, pattern)
        for s in arrays:
            yield pd.Series([enc.decode_bytes([] if a is None else [int(i) for i in a]) for a in s], dtype=object)

    return docs.withColumn(out, bytes_of(F.col(ids)))


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of the token count and the digests of the ids and of the bytes decoded from them.

    The same encoding and decoding as :func:`encode` and :func:`decode`, fused so
    that ids and bytes don't leave the task. Null counts as empty.
    """

    @F.pandas_udf(DIGEST)
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = load(path, pattern)
        names = [str(i) for i in range(enc.max_token_value + 1)]
        for s in texts:
            rows = []
            for t in s:
                ids = encode_text(enc, t or "")
                listed = ",".join(map(names.__getitem__, ids))
                rows.append((len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(enc.decode_bytes(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def encoded_digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null texts count as empty; repeated rows give repeated results; long texts are encoded in parts (see :func:`safe_parts`), a part
    without white space whole. Other columns are not read. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), round_trip(F.col(text), path, pattern).alias("_r")).select("doc_id", "_r.*")
