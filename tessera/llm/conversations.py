"""Repair of conversations by weighted interval parsing.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows may be kept, given another role, deleted, and
empty turns may be inserted, each at a cost; the cheapest repair is found by CYK over spans of rows. The repair grammar is in
Chomsky normal form: a nonterminal (p, q) stands for what takes the automaton of the pattern from state p to q, its rules are
(p, q) -> (p, r) (r, q) and the edits of a single row. A cell keeps the least (cost, audit) of each nonterminal, and is closed under insertions
on both sides. Cells are combined bottom-up by span length. A derivation is in one state at each place between two rows, so every split of a
span gives the same cell: one split a span is enough, spans of 1, 2, 4, ... rows are all that is needed, and cells of
different tasks compose. Equal costs: a span's audits of one cost are never prefixes of one another (a cost is fixed by the
audit), so the least audits of two halves make the least of both.

Rows are dealt by ranges of (conversation, turn, ...), so that a conversation with a third of all rows is parsed in many tasks;
the few cells of each conversation then meet its texts, which pass once, in order, through one task as a stream.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.runtime import prepare

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
#: Automaton of the pattern: state -> {initial: next state}. Start is 0, ends are 0 and 3.
STEPS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
#: Roles that may be given or inserted.
GIVEN = {"u": "user", "a": "assistant"}


def _reach() -> list[tuple[int, int]]:
    found = {(p, p) for p in STEPS}
    while more := {(p, r) for p, q in found for r in STEPS[q].values()} - found:
        found |= more
    return sorted(found)


NONTERMINALS = _reach()
PLACE = {pq: k for k, pq in enumerate(NONTERMINALS)}
#: Binary rules as places of (p, q), (p, r), (r, q).
RULES = [(PLACE[p, q], PLACE[p, r], PLACE[r, q]) for p, q in NONTERMINALS for r in STEPS if (p, r) in PLACE and (r, q) in PLACE]
Cell = list  # of (cost, audit) or None by nonterminal


def combine(left: Cell, right: Cell) -> Cell:
    """Cell of a span from those of its two parts."""
    out: Cell = [None] * len(NONTERMINALS)
    for whole, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost = x[0] + y[0]
            if out[whole] is None or cost <= out[whole][0]:
                found = (cost, x[1] + y[1])
                if out[whole] is None or found < out[whole]:
                    out[whole] = found
    return out


def _put(cell: Cell, p: int, q: int, found: tuple[int, str]) -> None:
    k = PLACE[p, q]
    if cell[k] is None or found < cell[k]:
        cell[k] = found


def insertions() -> Cell:
    """Cell of a span without rows: the cheapest insertions between each two states."""
    cell: Cell = [None] * len(NONTERMINALS)
    for p in STEPS:
        _put(cell, p, p, (0, ""))
        for initial, q in STEPS[p].items():
            if initial in GIVEN:
                _put(cell, p, q, (COST[INSERT], INSERT))
    for _ in STEPS:
        cell = combine(cell, cell)
    return cell


NO_ROWS = insertions()


def row_cell(initial: str, doomed: bool, truncated: bool) -> Cell:
    """Cell of a single row, closed under insertions before and after; a doomed row must be deleted."""
    cell: Cell = [None] * len(NONTERMINALS)
    more = TRUNCATED_COST if truncated else 0
    for p, steps in STEPS.items():
        _put(cell, p, p, (COST[DELETE], DELETE))
        for wanted, q in steps.items() if not doomed else ():
            if initial == wanted:
                _put(cell, p, q, (COST[KEEP] + more, KEEP))
            if wanted in GIVEN:
                _put(cell, p, q, (COST[REROLE] + more, REROLE))
    return combine(combine(NO_ROWS, cell), NO_ROWS)


_rows: dict = {}


def known_cell(*row) -> Cell:
    if row not in _rows:
        _rows[row] = row_cell(*row)
    return _rows[row]


def repeated(cell: Cell, times: int) -> Cell:
    """Cell of a span of equal rows, by doubling."""
    out, power = None, cell
    while times:
        if times & 1:
            out = power if out is None else combine(out, power)
        times >>= 1
        power = combine(power, power) if times else power
    return NO_ROWS if out is None else out


class Spans:
    """Bottom-up parse of rows that arrive in order: neighbouring spans of one length become a span of twice the length as soon as both are there."""

    def __init__(self) -> None:
        self.open: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        length = 1
        while self.open and self.open[-1][0] == length:
            cell = combine(self.open.pop()[1], cell)
            length *= 2
        self.open.append((length, cell))

    def cell(self) -> Cell:
        out = NO_ROWS
        for _, cell in reversed(self.open):
            out = combine(cell, out)
        return out


def best(cell: Cell) -> tuple[int, str]:
    """Least (cost, audit) that leads from the start to an end of the pattern."""
    return min(cell[PLACE[0, q]] for q in ENDS if cell[PLACE[0, q]] is not None)


# Order of the rows of a conversation: by turn (nulls first), then role, then digest of the text.
KEY = ["turn", "role", "digest"]
COUNTS = ["n_rows", "blank", "duplicate", "truncated", "illegal", "turns"]
BLOCK = T.StructType(
    [T.StructField("cost", T.ArrayType(T.LongType())), T.StructField("audit", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))]
    + [T.StructField(c, T.LongType()) for c in ("low", "high")] + [T.StructField(c, T.StringType()) for c in ("first", "last")]
)


def summary(entries: Iterable[tuple]) -> dict:
    """One block of a conversation: (turn, initial, n, blank, truncated, new) in order, n copies each; ``new``: the first of them has not been seen before."""
    spans, count, low, high, first, last = Spans(), dict.fromkeys(COUNTS, 0), None, None, None, None
    for turn, initial, n, blank, cut, new in entries:
        if not n:
            continue
        fresh = 0 if blank or not new else 1
        if fresh:
            spans.add(known_cell(initial, False, bool(cut)))
            count["truncated"] += bool(cut)
        if n - fresh:
            spans.add(repeated(known_cell("", True, False), n - fresh))
        count["blank" if blank else "duplicate"] += n - fresh
        count["illegal"] += n - 1 + (last is not None and not legal(last, initial))
        count["n_rows"] += n
        if turn is not None:
            count["turns"] += turn != high
            low, high = turn if low is None else low, turn
        first, last = initial if first is None else first, initial
    return {"cell": spans.cell(), "count": count, "low": low, "high": high, "first": first, "last": last}


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def joined(a: dict, b: dict) -> dict:
    """Two neighbouring blocks of a conversation as one."""
    if not a["count"]["n_rows"] or not b["count"]["n_rows"]:
        return b if not a["count"]["n_rows"] else a
    count = {c: a["count"][c] + b["count"][c] for c in COUNTS}
    count["illegal"] += not legal(a["last"], b["first"])
    count["turns"] -= a["high"] is not None and a["high"] == b["low"]
    low = b["low"] if a["low"] is None else a["low"]
    high = a["high"] if b["high"] is None else b["high"]
    return {"cell": combine(a["cell"], b["cell"]), "count": count, "low": low, "high": high, "first": a["first"], "last": b["last"]}


def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Consecutive rows of one conversation: its id and its rows, as they stream."""
    rows = itertools.chain.from_iterable(zip(*[b.column(c).to_pylist() for c in ("conv_id", *names)]) for b in batches)
    for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
        yield conv, (r[1:] for r in own)


def lots(rows: Iterable[tuple], schema: pa.Schema, size: int = 512, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded number and text length."""
    lot, length = [], 0
    for r in rows:
        lot.append(r)
        length += sum(len(x) for x in r if isinstance(x, str))
        if len(lot) >= size or length >= most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in lot], schema=schema)
            lot, length = [], 0
    if lot:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in lot], schema=schema)


def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, times): rows as a careless export leaves them, by crc32(``conv_id:turn``) % 20.

    0: dropped (times 0), 1: empty text, 2: no ``.!?``, 3: twice, 4: role user. In the key, the role and the text a null is one space; conv_id
    and turn stay null. Rows equal in conv_id and turn are damaged alike.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    kind, words = F.crc32(key.cast("binary")) % 20, F.coalesce(F.col(text), blank)
    return conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(words, ".!?", "")).otherwise(words).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def is_cut(text: Column) -> Column:
    """Whether the last character that is no white space is none of ``.!?``."""
    return ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, place, block): the cells and counts of each conversation in each range of rows; ``place`` orders the ranges.

    Texts go no further than their digests. Equal rows become one with a number, and the first of each (role, text) is found by
    partial minima, so no group has to meet in one task.
    """
    coded = rows.select("conv_id", "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "times", is_blank(F.col("text")).alias("blank"), is_cut(F.col("text")).alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    first = coded.filter("times > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("at"))
    first = first.select("conv_id", F.col("at.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("times"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.lit(True).alias("new"))
    entries = coded.withColumn("new", F.lit(False)).unionByName(first).groupBy("conv_id", *KEY).agg(F.sum("times").alias("n"), *[F.max(c).alias(c) for c in ("blank", "cut", "new")])
    entries = entries.withColumn("initial", F.substring("role", 1, 1))
    dealt = entries.repartitionByRange("conv_id", *KEY).sortWithinPartitions("conv_id", *KEY)
    kind = rows.schema["conv_id"].dataType
    out = T.StructType([T.StructField("conv_id", kind), T.StructField("place", T.LongType()), T.StructField("block", BLOCK)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()

        def found():
            for conv, entries in groups(batches, ["turn", "initial", "n", "blank", "cut", "new"]):
                s = summary(entries)
                cell = {"cost": [x and x[0] for x in s["cell"]], "audit": [x and x[1] for x in s["cell"]], "counts": [s["count"][c] for c in COUNTS]}
                yield conv, place, cell | {c: s[c] for c in ("low", "high", "first", "last")}

        yield from lots(found(), arrow)

    return dealt.mapInArrow(work, out)


def opened(block: dict) -> dict:
    """A block as :func:`blocks` wrote it."""
    cell = [None if c is None else (c, a) for c, a in zip(block["cost"], block["audit"])]
    return {"cell": cell, "count": dict(zip(COUNTS, block["counts"]))} | {c: block[c] for c in ("low", "high", "first", "last")}


def apply_audit(audit: str, rows: Iterable[tuple]) -> Iterator[tuple]:
    """(edit, turn, role, text) of the repaired rows from an audit and the rows (turn, role, text) in order."""
    rows, state = iter(rows), 0
    for edit in audit:
        turn, role, text = (None, "", "") if edit == INSERT else next(rows)
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = GIVEN[next(i for i in STEPS[state] if i in GIVEN)]
        state = STEPS[state][role[0]]
        yield edit, turn, role, text


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations from (conv_id, turn, role, text, times): conv_id, place, edit, turn, role, text, and a report.

    Place 0 is the report of a conversation (gaps, blank, duplicate, truncated, illegal, cost, audit), places from 1 are its repaired rows in
    order: kept (K), with another role (R) or inserted (I). ``times`` rows stand for each (0: none, but the conversation is reported). Rows are taken by turn, nulls first,
    rows of one turn by role and then by the MD5 of the text; equal rows stand side by side. A row's first fault counts: blank, duplicate (role and text stood before in the
    conversation), truncated (the last character that is no white space is none of ``.!?``). ``gaps`` counts the turns missing between the least and
    the greatest, ``illegal`` the neighbours whose initials are not su, ua or au. A null conv_id is a conversation of its own. Rows of a conversation leave one task in order; that task
    holds audits and one batch of texts. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    prepare(spark)
    kind = rows.schema["conv_id"].dataType
    texts = rows.filter("times > 0").select("conv_id", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("at"), "turn", "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text", "times", F.lit(None).cast(BLOCK).alias("block"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"), ("times", "long"))]
    heads = blocks(rows).select("conv_id", F.lit(0).alias("kind"), F.col("place").alias("at"), *none, "block")
    dealt = heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at", *KEY)
    long, string = T.LongType(), T.StringType()
    out = T.StructType([T.StructField("conv_id", kind), T.StructField("place", long), T.StructField("edit", string), T.StructField("turn", long), T.StructField("role", string), T.StructField("text", string), *[T.StructField(c, long) for c in REPORT], T.StructField("audit", string)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for conv, own in groups(batches, ["kind", "turn", "role", "text", "times", "block"]):
                s, first = None, None
                for first in own:
                    if first[0]:
                        break
                    s, first = opened(first[-1]) if s is None else joined(s, opened(first[-1])), None
                cost, audit = best(s["cell"])
                count, high, low = s["count"], s["high"], s["low"]
                gaps = 0 if high is None else high - low + 1 - count["turns"]
                yield conv, 0, None, None, None, None, gaps, count["blank"], count["duplicate"], count["truncated"], count["illegal"], cost, audit
                left = itertools.chain([first] if first else [], own)
                singly = ((r[1], r[2], r[3]) for r in left for _ in range(r[4]))
                for place, edited in enumerate(apply_audit(audit, singly), 1):
                    yield conv, place, *edited, *[None] * len(REPORT), None

        yield from lots(found(), arrow)

    return dealt.mapInArrow(work, out)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, of rows first damaged by :func:`damage`.

    ``repaired_sha256`` is that of the repaired ``role:text``, joined by newlines. Cases as in :func:`repair`; a conversation without rows after the damage
    has zeros, an empty audit and the digest of the empty string. Columns other than conv_id, turn, role and text are not read.
    """
    made = repair(damage(conversations))
    long, string = T.LongType(), T.StringType()
    out = T.StructType([made.schema["conv_id"], *[T.StructField(c, long) for c in REPORT], T.StructField("audit", string), T.StructField("repaired_sha256", string)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for conv, own in groups(batches, ["place", "role", "text", *REPORT, "audit"]):
                report, digest = next(own)[3:], hashlib.sha256()
                for place, role, text, *_ in own:
                    digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
                yield conv, *report, digest.hexdigest()

        yield from lots(found(), arrow)

    return made.mapInArrow(work, out)
