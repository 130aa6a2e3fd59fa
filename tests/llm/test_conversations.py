"""Conversation repair against a shortest path over edits, a full CYK chart, and row-by-row faults."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

from tessera.llm import conversations as C
from tests.conftest import SF

WHITE = " \t\n\x0b\x0c\r"


def cheapest(tokens):
    """Least (cost, audit) by a search over (place, state); tokens are (initial, doomed, truncated)."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(tokens) and state in (0, 3):
            return cost, audit
        nxt = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[state]
        for x, to in nxt.items():
            if x != "s":
                heapq.heappush(heap, (cost + 5, audit + "I", i, to))
        if i < len(tokens):
            initial, doomed, cut = tokens[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            for x, to in nxt.items() if not doomed else ():
                if x == initial:
                    heapq.heappush(heap, (cost + 5 * cut, audit + "K", i + 1, to))
                if x != "s":
                    heapq.heappush(heap, (cost + 1 + 5 * cut, audit + "R", i + 1, to))


def chart(tokens):
    """All spans, all splits."""
    n = len(tokens)
    cells = {(i, i + 1): C.row_cell(*t) for i, t in enumerate(tokens)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            found = [C.combine(cells[i, k], cells[k, i + length]) for k in range(i + 1, i + length)]
            assert all(f == found[0] for f in found)
            cells[i, i + length] = found[0]
    return cells[0, n] if n else C.NO_ROWS


def brute(rows):
    """Report and digest of one conversation from its undamaged (conv_id, turn, role, text)."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    seen, tokens, faults = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in out:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        tokens.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(tokens)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(tokens, tokens[1:]))
    turns = [t for t, *_ in out if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    repaired, left, last = [], iter(out), None
    for e in audit:
        _, role, text = (None, None, "") if e == "I" else next(left)
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if last == "u" else "user"
        last = role[0]
        repaired.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in repaired))
    return gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()


def test_cells_equal_search_and_full_chart():
    random.seed(3)
    for _ in range(400):
        tokens = [(random.choice("suuaax"), random.random() < 0.2, random.random() < 0.3) for _ in range(random.randint(0, 11))]
        spans = C.Spans()
        for t in tokens:
            spans.add(C.row_cell(*t))
        want = cheapest(tokens)
        assert C.best(spans.cell()) == want and spans.cell() == chart(tokens)
    doomed = C.row_cell("", True, False)
    for n in (0, 1, 2, 3, 7, 12):
        spans = C.Spans()
        for _ in range(n):
            spans.add(doomed)
        assert C.repeated(doomed, n) == spans.cell()


def odd_rows():
    random.seed(8)
    say = ["Hello.", "What?", "cut off", "", "  \t", None, "x" * 3000 + ".", "é🙂!", "Yes.  \n", "a. b"]
    rows = [(c, t, random.choice(["system", "user", "assistant", "assistant", "user", None, "tool", ""]), random.choice(say)) for c in range(40) for t in range(random.randint(1, 14)) if random.random() < 0.9]
    rows += [(None, None, "user", "No id."), (None, 3, "assistant", "Sure."), (2, None, "system", "No turn."), *[(5, 4, "user", "Again.")] * 4, (6, 4, "user", "Tie."), (6, 4, "assistant", "Tie."), (6, 4, "user", "Other tie.")]
    rows += [(900 + c, 0, "user", "Alone.") for c in range(40)]  # some lose all their rows
    rows += [(7777, t, ["user", "assistant"][t % 2], f"Turn {t}." if t % 9 else "Same.") for t in range(1500)]
    return rows


def test_query_equals_brute_force_with_any_partitioning(spark):
    rows = odd_rows()
    want = sorted(str((c, *brute(list(own)))) for c, own in itertools.groupby(sorted(rows, key=str), key=lambda r: r[0]))
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, digest string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            assert sorted(str(tuple(r)) for r in C.repair_digests(table.repartition(parts)).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert C.repair_digests(table.limit(0)).count() == 0


def test_blocks_of_one_conversation_join():
    random.seed(5)
    for _ in range(100):
        turns = sorted(random.randint(0, 9) for _ in range(10))
        entries = [(t if random.random() < 0.8 or i else None, random.choice("sua"), random.randint(0, 3), random.random() < 0.2, random.random() < 0.3, random.random() < 0.7) for i, t in enumerate(turns)]
        whole, cut = C.summary(entries), random.randint(0, 10)
        assert C.joined(C.summary(entries[:cut]), C.summary(entries[cut:])) == whole


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi.", 1), (1, 1, "user", "Hi again.", 1), (1, 2, "assistant", "Well.", 2)]
    got = C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, times long")).collect()
    assert [(r.place, r.edit, r.turn, r.role, r.text) for r in got] == [(0, None, None, None, None), (1, "K", 1, "user", "Hi again."), (2, "K", 2, "assistant", "Well.")]
    assert (got[0].cost, got[0].audit, got[0].duplicate, got[0].illegal) == (4, "DKKD", 1, 2)


def test_given_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = sorted(map(tuple, table.select("conv_id", "turn", "role", "text").collect()))
    want = sorted(str((c, *brute(list(own)))) for c, own in itertools.groupby(rows, key=lambda r: r[0]))
    assert sorted(str(tuple(r)) for r in C.repair_digests(table).collect()) == want
