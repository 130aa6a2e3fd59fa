"""Token counts by a deterministic transducer compiled from a BPE vocabulary.

A text is a string of units: a run of spaces (written as ``▁``) and the
non-spaces behind it. No piece of the vocabulary has a ``▁`` behind another
character (checked when compiling), so no merge spans two units and a text's
count is the sum over its units.

Inside a unit, the transducer reads one character at a time. Its state is the
last token of each of the latest prefixes' tokenizations, and each transition is
annotated with the change of the token count: the tokenization of a prefix
ends with the one token that can stand behind the last token of the prefix
before it, and two tokens can stand side by side if the library encodes
their joined text to just these two. States and transitions are made when
first met and kept in a bounded table (dropped and refilled beyond the bound).

A chunk of text maps any entry state to an exit state and a count; as every unit
starts afresh, the map is (text before the first unit, count of whole units,
last open unit). The maps compose associatively. Texts beyond ``LONG`` characters are dealt out
in chunks, whose maps are made in parallel and put together by a prefix scan: a tree of
compositions, not a chain. A chunk without a unit start passes its text on as part of a unit, which the
machine reads once when the unit is whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.runtime import prepare, text_key

SPACE = "▁"
CHUNK = 1 << 16
LONG = 1 << 16
MAX_STATES = 400_000
MAX_UNITS = 3 << 18
NOWHERE = ("", 0)
_cache: dict = {}


class Transducer:
    """Deterministic transducer from characters to token-count changes, filled in on demand."""

    def __init__(self, path: str):
        import sentencepiece as sp

        self.library = sp.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        plain = [i for i in range(n) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))]
        self.pieces = {self.library.id_to_piece(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece spans two units: counts can't be taken unit by unit")
        self.inner = {p[:i] for p in self.pieces for i in range(1, len(p))}
        self.beginnings = self.inner | self.pieces
        self.beside: dict[tuple[str, str], bool] = {}
        self.units: dict[str, int] = {}
        self.reset()

    def reset(self) -> None:
        # a state: the longest end of the text that begins a longer piece, and for each prefix behind which a
        # longer piece can begin the last token and the count relative to the newest prefix
        self.states: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.state(("", (("", 0),)))

    def state(self, content: tuple) -> int:
        if content not in self.states:
            self.states[content] = len(self.content)
            self.content.append(content)
            self.moves.append({})
        return self.states[content]

    def can_follow(self, left: str, right: str) -> bool:
        """Whether the library tokenizes left + right as these two tokens."""
        key = left, right
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) > MAX_STATES:
                self.beside.clear()
            known = left not in self.pieces or right not in self.pieces
            if not known:
                # behind a line feed, which is in no piece, the text may start anywhere in a unit
                known = self.library.encode("\n" + (left + right).replace(SPACE, " "), out_type=str)[2:] == [left, right]
            self.beside[key] = known
        return known

    def weight(self, token: str) -> int:
        """Tokens that the library emits for it: a character outside the vocabulary falls back to its bytes."""
        return 1 if token in self.pieces else len(token.encode())

    def step(self, s: int, c: str) -> tuple[int, int]:
        """Next state and change of the count."""
        tail, prefixes = self.content[s]
        tail += c
        # what may still become a piece: only so far back can a later token begin
        while tail and tail not in self.beginnings:
            tail = tail[1:]
        for size in range(len(tail), 0, -1):
            token = tail[-size:]
            if token in self.pieces:
                before, count = prefixes[-size]
                if before == "" or self.can_follow(before, token):
                    break
        else:
            token, (before, count) = c, prefixes[-1]
        new = count + self.weight(token)
        while tail and tail not in self.inner:
            tail = tail[1:]
        n, m = len(tail), len(prefixes)
        behind = [(prefixes[m - n + i][0], prefixes[m - n + i][1] - new) if tail[i:] in self.inner else NOWHERE for i in range(n)]
        made = self.state((tail, (*behind, (token, 0))))
        self.moves[s][c] = made, new
        return made, new

    def run(self, unit: str) -> int:
        """Token count of one unit."""
        if len(self.content) > MAX_STATES:
            self.reset()
        s = total = 0
        moves = self.moves
        for c in unit:
            try:
                s, change = moves[s][c]
            except KeyError:
                s, change = self.step(s, c)
            total += change
        return total

    def unit(self, unit: str) -> int:
        n = self.units.get(unit)
        if n is None:
            if len(self.units) > MAX_UNITS:
                self.units.clear()
            n = self.run(unit)
            if len(unit) < 64:
                self.units[unit] = n
        return n

    def chunk(self, text: str) -> tuple[str, int, str | None]:
        """State map of a chunk (spaces already written as ``▁``): text before its first unit, count of whole units, last unit.

        The last unit is open; None: the chunk has no unit start, and all of it is the first part.
        """
        start = text.find(SPACE)
        if start < 0:
            return text, 0, None
        head, found = text[:start], _UNIT.findall(text, start)
        last = found.pop()
        counts = list(map(self.units.get, found))
        if None in counts:
            counts = [self.unit(u) if n is None else n for u, n in zip(found, counts)]
        total = sum(counts)
        return head, total, last

    def compose(self, a: tuple, b: tuple) -> tuple:
        """State map of two chunks, one behind the other. Associative."""
        if b[2] is None:
            return (a[0], a[1], a[2] + b[0]) if a[2] is not None else (a[0] + b[0], 0, None)
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        return a[0], a[1] + self.unit(a[2] + b[0]) + b[1], b[2]

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix scan of chunk maps: pairs are composed, their scan taken, and the maps between filled in."""
        if len(maps) < 2:
            return maps
        paired = self.scan([self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])])
        return [maps[0], *(paired[k // 2] if k % 2 else self.compose(paired[k // 2 - 1], maps[k]) for k in range(1, len(maps)))]

    def end(self, maps: list[tuple]) -> int:
        """Tokens of the text whose chunks have these maps, in order."""
        head, total, last = self.scan(maps)[-1]
        return (self.unit(head) if head else 0) + total + (self.unit(last) if last else 0)

    def count(self, text: str) -> int:
        """Tokens of a whole text: its chunks' maps composed, entered at the dummy space of a text's start."""
        return self.end([self.chunk(p) for p in chunks(marked(text))]) if text else 0


_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


def marked(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


def chunks(marked: str, size: int = CHUNK) -> list[str]:
    """Pieces of about ``size`` characters, never cut behind a ``▁``, so that a run of spaces stays with what follows."""
    out, at = [], 0
    while len(marked) - at > size:
        end = at + size
        while end < len(marked) and (marked[end - 1] == SPACE):
            end += 1
        out.append(marked[at:end])
        at = end
    return [*out, marked[at:]]


def load(path: str) -> Transducer:
    if path not in _cache:
        _cache[path] = Transducer(path)
    return _cache[path]


def token_count(text: Column, path: str) -> Column:
    """Tokens of each text (long), without begin, end or added special tokens. Null and empty texts count 0."""

    @F.pandas_udf("long")
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = load(path)
        for s in texts:
            yield pd.Series([machine.count(t or "") for t in s], dtype="int64")

    return counts(text)


def long_counts(docs: DataFrame, path: str) -> DataFrame:
    """_ka, _kb, n_tokens of the distinct texts of ``docs`` (_ka, _kb, text), chunk by chunk on all executors."""
    key = ["_ka", "_kb"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a, c, t in zip(b["_ka"], b["_kb"], b["text"]):
                parts = chunks(marked(t))
                yield pd.DataFrame({"_ka": a, "_kb": c, "no": range(len(parts)), "chunk": parts})

    @F.pandas_udf("struct<head:string,total:long,last:string>")
    def mapped(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = load(path)
        for s in parts:
            yield pd.DataFrame([machine.chunk(p) for p in s], columns=["head", "total", "last"]).astype({"last": object})

    @F.pandas_udf("long")
    def composed(maps: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = load(path)
        for s in maps:
            yield pd.Series([machine.end([(m["head"], m["total"], m["last"]) for m in own]) for own in s], dtype="int64")

    dealt = docs.dropDuplicates(key).mapInPandas(cut, "_ka long, _kb long, no int, chunk string").repartition(*key, "no")
    maps = dealt.select(*key, "no", mapped("chunk").alias("m")).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("no", "m"))).alias("maps"))
    return maps.select(*key, composed(F.transform("maps", lambda x: x["m"])).alias("n_tokens"))


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Rows are independent: repeated rows give repeated results; null texts count as
    empty; texts beyond LONG characters are counted in chunks, each distinct one once; other columns of ``docs``
    are not read. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    is_long = F.char_length("text") > LONG
    counted = rows.filter(~is_long).select("doc_id", size, token_count(F.col("text"), path).alias("n_tokens"))
    long_rows = rows.filter(is_long).select("doc_id", size, "text", *text_key(F.col("text")))
    found = long_counts(long_rows.select("_ka", "_kb", "text"), path)
    counted = counted.unionByName(long_rows.select("doc_id", "n_bytes", "_ka", "_kb").join(found, ["_ka", "_kb"]).drop("_ka", "_kb"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
