"""Fill-in-the-middle training texts by displacement scatter.

A text is cut into prefix, middle and suffix at two token places, and its parts are put in another order between
markers. A task works on the bytes of a whole Arrow batch at once: one scan finds the token starts, the cuts become the
changes of a difference array over the batch, its running sum is the output shift of every byte, and one scatter writes
all outputs. :func:`restore` finds the markers again and gathers the bytes back by the inverse shifts. Arrays
as long as a batch exist for one block of BLOCK bytes at a time, so a very long text costs itself and its output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.runtime import prepare

#: Markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = re.compile(b"|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))
PLAIN, PSM, SPM = "plain", "psm", "spm"
BLOCK = 1 << 21
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
LEAD = (np.arange(256) & 0xC0) != 0x80


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary array and the row bounds in them; null rows are empty."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def binary_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def blocks(n: int) -> Iterator[tuple[int, int]]:
    return ((a, min(a + BLOCK, n)) for a in range(0, n, BLOCK))


def token_starts(data: np.ndarray, bounds: np.ndarray, a: int, b: int) -> np.ndarray:
    """Places in [a, b) at which a token starts: a run of letters, or a code point that is no letter."""
    letter = LETTER[data[a:b]]
    starts = LEAD[data[a:b]]
    after_letter = np.concatenate(([bool(a) and LETTER[data[a - 1]]], letter[:-1]))
    starts &= ~(letter & after_letter)
    first = bounds[np.searchsorted(bounds, a) : np.searchsorted(bounds, b)]
    starts[first - a] = True
    return np.flatnonzero(starts) + a


def counts_before(data: np.ndarray, places: np.ndarray, flags) -> np.ndarray:
    """Number of flagged bytes before each of the places (any order); ``flags(a, b)`` lists those in [a, b)."""
    order = np.argsort(places, kind="stable")
    sorted_places, found, total = places[order], np.zeros(len(places), np.int64), 0
    for a, b in blocks(len(data)):
        at = flags(a, b)
        here = slice(np.searchsorted(sorted_places, a, "right" if a else "left"), np.searchsorted(sorted_places, b, "right"))
        found[here] = total + np.searchsorted(at, sorted_places[here])
        total += len(at)
    out = np.empty_like(found)
    out[order] = found
    return out


def places_of(data: np.ndarray, ranks: np.ndarray, flags) -> np.ndarray:
    """Place of the flagged byte of each rank (ranks from 0, any order; all exist)."""
    order = np.argsort(ranks, kind="stable")
    sorted_ranks, found, total = ranks[order], np.zeros(len(ranks), np.int64), 0
    for a, b in blocks(len(data)):
        at = flags(a, b)
        here = slice(np.searchsorted(sorted_ranks, total), np.searchsorted(sorted_ranks, total + len(at)))
        found[here] = at[sorted_ranks[here] - total]
        total += len(at)
    out = np.empty_like(found)
    out[order] = found
    return out


def shifts(n: int, at: np.ndarray, shift: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(a, b, shift of every byte in [a, b)): running sums of a difference array with a change of shift at each segment's start ``at`` (ascending)."""
    change = np.diff(shift, prepend=0)
    carry = 0
    for a, b in blocks(n):
        step = np.zeros(b - a, np.int64)
        here = slice(np.searchsorted(at, a), np.searchsorted(at, b))
        np.add.at(step, at[here] - a, change[here])
        step[0] += carry
        np.cumsum(step, out=step)
        carry = step[-1]
        yield a, b, step


def rows_with_markers(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each row contains a marker; markers across the bounds of rows don't count."""
    has = np.zeros(len(bounds) - 1, bool)
    view, at = memoryview(data), 0
    while m := MARKERS.search(view, at):
        row = np.searchsorted(bounds, m.start(), "right") - 1
        has[row] |= m.end() <= bounds[row + 1]
        at = m.start() + 1
    return has


def segments(bounds: np.ndarray, cut: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's three segments the starts in the text and in the output; markers' places in the output (P, S, M); output bounds."""
    starts = np.stack([bounds[:-1], cut[:, 0], cut[:, 1]], axis=1)
    size = np.stack([cut[:, 0] - bounds[:-1], cut[:, 1] - cut[:, 0], bounds[1:] - cut[:, 1]], axis=1)
    p, s, m = map(len, (PREFIX, SUFFIX, MIDDLE))
    changed = form > 0
    out = np.concatenate(([0], np.cumsum(size.sum(axis=1) + (p + s + m) * changed)))
    spm = form == 2
    marks = np.zeros((len(form), 3), np.int64)
    marks[:, 0] = out[:-1] + np.where(spm, s + size[:, 2], 0)
    marks[:, 1] = out[:-1] + np.where(spm, 0, p + size[:, 0])
    marks[:, 2] = out[:-1] + p + s + size[:, 0] + size[:, 2]
    to = np.stack([marks[:, 0] + p, marks[:, 2] + m, marks[:, 1] + s], axis=1)
    # a plain row stays one piece: its segments keep their distance
    to = np.where(changed[:, None], to, starts - bounds[:-1, None] + out[:-1, None])
    return starts, to, marks, out


def rearrange(data: np.ndarray, bounds: np.ndarray, h: np.ndarray, plain_from: int, spm_below: int) -> tuple[np.ndarray, ...]:
    """n, form (0 plain, 1 psm, 2 spm), code points of prefix and middle, output bytes and bounds of a batch; h: four hashes a row."""
    starts = lambda a, b: token_starts(data, bounds, a, b)
    before = counts_before(data, bounds, starts)
    n = np.diff(before)
    units = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    inner = units < n[:, None]
    cut = np.repeat(bounds[1:, None], 2, axis=1)
    cut[inner] = places_of(data, (before[:-1, None] + units)[inner], starts)
    plain = (n == 0) | rows_with_markers(data, bounds) | (h[:, 2] % 100 >= plain_from)
    form = np.where(plain, 0, np.where(h[:, 3] % 100 < spm_below, 2, 1))
    points = counts_before(data, np.concatenate([bounds[:-1], cut[:, 0], cut[:, 1]]), lambda a, b: np.flatnonzero(LEAD[data[a:b]]) + a).reshape(3, -1)
    at, to, marks, out_bounds = segments(bounds, cut, form)
    out = np.empty(out_bounds[-1], np.uint8)
    for a, b, shift in shifts(len(data), at.ravel(), (to - at).ravel()):
        out[np.arange(a, b) + shift] = data[a:b]
    for k, marker in enumerate((PREFIX, SUFFIX, MIDDLE)):
        out[marks[form > 0, k][:, None] + np.arange(len(marker))] = np.frombuffer(marker, np.uint8)
    return n, form, points[1] - points[0], points[2] - points[1], out, out_bounds


def put_back(out: np.ndarray, out_bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts and their bounds from outputs and forms: the markers are found again and every byte is gathered from its place."""
    marks = np.zeros((len(form), 3), np.int64)
    view = memoryview(out)
    for row in np.flatnonzero(form > 0):
        for m in MARKERS.finditer(view[out_bounds[row] : out_bounds[row + 1]]):
            marks[row, (PREFIX, SUFFIX, MIDDLE).index(m.group())] = out_bounds[row] + m.start()
    p, s, m = map(len, (PREFIX, SUFFIX, MIDDLE))
    changed, spm, end = form > 0, form == 2, out_bounds[1:]
    source = np.stack([marks[:, 0] + p, marks[:, 2] + m, marks[:, 1] + s], axis=1)
    size = np.stack([np.where(spm, marks[:, 2], marks[:, 1]) - source[:, 0], end - source[:, 1], np.where(spm, marks[:, 0], marks[:, 2]) - source[:, 2]], axis=1)
    size[~changed] = 0
    size[~changed, 0] = np.diff(out_bounds)[~changed]
    bounds = np.concatenate(([0], np.cumsum(size.sum(axis=1))))
    at = bounds[:-1, None] + np.cumsum(size, axis=1) - size
    source = np.where(changed[:, None], source, out_bounds[:-1, None] + at - bounds[:-1, None])
    text = np.empty(bounds[-1], np.uint8)
    for a, b, shift in shifts(len(text), at.ravel(), (source - at).ravel()):
        text[a:b] = out[np.arange(a, b) + shift]
    return text, bounds


FORMS = np.array([PLAIN, PSM, SPM])


def hashes(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32-bit groups of the sha256 of ``seed:doc_id`` as h1 to h4; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output (binary UTF-8).

    ``n`` counts tokens: runs of ASCII letters, and every other code point by itself. Prefix and middle end after h1 and h2 modulo n + 1
    tokens, the smaller first. ``plain`` keeps the text: empty and null texts (n 0), texts that contain a marker, and those with h3 % 100 >= ``plain_from``;
    their prefix_chars and middle_chars are null. Else ``spm`` (h4 % 100 < ``spm_below``) or ``psm``. The hashes depend on seed and doc_id alone, so
    repeated rows give repeated results and rows of one id are cut at like shares. Very long texts are one row of a batch of their own. Columns other than
    the two named are not read. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), *hashes(F.col(doc_id), seed))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            h = np.stack([batch.column(f"h{k}").to_numpy(zero_copy_only=False) for k in range(1, 5)], axis=1)
            n, form, prefix, middle, out, out_bounds = rearrange(data, bounds, h, plain_from, spm_below)
            none = form == 0
            columns = [batch.column("doc_id"), pa.array(n), pa.array(FORMS[form], pa.string()), pa.array(prefix, mask=none), pa.array(middle, mask=none), binary_array(out, out_bounds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    long = T.LongType()
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *[T.StructField(name, kind) for name, kind in (("n", long), ("form", T.StringType()), ("prefix_chars", long), ("middle_chars", long), ("output", T.BinaryType()))]])
    return rows.mapInArrow(work, schema)


def restore(output: Column, form: Column) -> Column:
    """The text (binary UTF-8) behind an output of :func:`fill_in_middle` and its form; a null output counts as empty."""

    @F.arrow_udf("binary")
    def texts(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            data, bounds = bytes_of(outputs)
            kinds = np.array([{PSM: 1, SPM: 2}.get(f, 0) for f in forms.to_pylist()], np.int64)
            yield binary_array(*put_back(data, bounds, kinds))

    return texts(output, form)


def infill_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256. Cases as in :func:`fill_in_middle`."""
    made = fill_in_middle(docs, doc_id=doc_id, text=text)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
