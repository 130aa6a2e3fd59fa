"""Operators that compare documents, against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import components, fingerprints, passages, repeats, simhash
from tests.conftest import SF

SCHEMA = "doc_id long, text string, fp long, ranges string"


def frame(spark, rows):
    """Rows with two extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)


def real_rows(spark, n=60):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n).collect()]


def groups(n, linked):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in linked:
        a, b = find(i), find(j)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    random.seed(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(random.randint(200, 300), random.randint(200, 300)) for _ in range(80)] + [(7, 7), (None, 3)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    lab = groups(400, [(a, b) for a, b in edges if a is not None])
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {n: lab[n] for n in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_classes(spark):
    random.seed(3)
    rows = real_rows(spark)
    base = rows[5][1].split()
    for k in range(150):
        w = list(base)
        for _ in range(random.randint(0, 6)):
            w[random.randrange(len(w))] = f"zz{random.randint(0, 9)}"
        rows.append((5000 + k, " ".join(w)))
    rows += [(9000, None), (None, "  "), (9002, ""), (9003, "One"), (9003, "one"), (9004, "A b c\x0bd E f"), (9005, "long " * 20000), (9006, rows[0][1])]
    got = sorted(map(str, map(tuple, simhash.fingerprint_classes(frame(spark, rows)).collect())))

    def bits(t):
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
        h = Counter(b for x in s for v in [xxhash.xxh64_intdigest(x.encode(), seed=42)] for b in range(64) if v >> b & 1)
        return sum(1 << b for b, c in h.items() if 2 * c > len(s))

    f = np.array([bits(t) for _, t in rows], np.uint64)
    lab = groups(len(f), [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f) <= 4)])
    least = {}
    for (d, _), g in zip(rows, lab):
        least[g] = min((x for x in (d, least.get(g)) if x is not None), default=None)
    assert got == sorted(str((d, f"{int(x):016x}", least[g])) for (d, _), x, g in zip(rows, f, lab))
    assert simhash.fingerprint_classes(frame(spark, rows).limit(0)).count() == 0


def test_ball_collisions_split_alike(monkeypatch):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    words = np.concatenate([base, base ^ np.uint64(0b1011), base ^ np.uint64(1 << 40 | 3)])
    left, owner = np.full(len(words), 2), np.arange(len(words))

    def classes():
        pairs = [p for a, b in simhash.collisions(words, left, owner, 64) for p in zip(a.tolist(), b.tolist())]
        return groups(len(words), pairs)

    whole = classes()
    monkeypatch.setattr(simhash, "SLAB", 3000)
    assert classes() == whole == groups(len(words), [(i, j) for i in range(len(words)) for j in range(i) if bin(int(words[i] ^ words[j])).count("1") <= 4])


def test_a_bucket_over_many_batches_is_whole(monkeypatch):
    monkeypatch.setattr(simhash, "SLAB", 40)
    rng = np.random.default_rng(2)
    low = rng.integers(0, 1 << 40, 60)
    fps = np.unique(np.concatenate([low, low ^ 0b101, low ^ (1 << 39 | 8)])).astype(np.int64)
    bucket = np.zeros(len(fps), np.int64)
    batches = [pa.RecordBatch.from_pydict({"bucket": bucket[i : i + 7], "left": bucket[i : i + 7] + 2, "fp": fps[i : i + 7]}) for i in range(0, len(fps), 7)]
    edges = [p for b in simhash.forest(16, 4)(iter(batches)) for p in zip(b.column("a").to_pylist(), b.column("b").to_pylist())]
    at = {int(f): i for i, f in enumerate(fps)}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if bin(int(fps[i] ^ fps[j])).count("1") <= 4]
    assert near and groups(len(fps), [(at[a], at[b]) for a, b in edges]) == groups(len(fps), near)


def brute_repeats(rows, n):
    docs = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + n] for _, b in docs for i in range(len(b) - n + 1))
    out = []
    for d, b in docs:
        hit = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                hit[i : i + n] = b"\1" * n
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out.append((d, len(b), sum(hit), sum(1 for i, h in enumerate(hit) if h and not (i and hit[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def repeat_rows(spark):
    random.seed(3)
    text = lambda n: "".join(random.choice("abcdefgh é") for _ in range(n))
    p, q = text(500), text(385)
    rows = real_rows(spark, 30)
    for k in range(20):
        rows.append((1000 + k, text(random.randint(0, 300)) + p[random.randint(0, 90) : random.randint(410, 500)] + text(random.randint(0, 300))))
        rows.append((2000 + k, text(200) + p[k : k + 400 + k % 3] + text(200)))
        rows.append((2500 + k, "x" * random.randint(300, 900) + q + text(5) * random.randint(0, 100)))
    return rows + [(1, None), (None, "a" * 400), (3, ""), (3, ""), (4, rows[0][1]), (5, "ab" * 3000)]


def test_repeats_against_brute_force(spark, monkeypatch):
    rows = repeat_rows(spark)
    want = brute_repeats(rows, 400)
    got = repeats.removal_digests(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == want
    assert sorted(str((r.doc_id, r.n_bytes, r.n_repeated)) for r in got) == sorted(str(eval(w)[:3]) for w in brute_repeats(rows, 240))
    assert repeats.removal_digests(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("length", [64, 150, 241])
def test_repeats_of_other_lengths(spark, length):
    rows = [(i, t) for i, (_, t) in enumerate(repeat_rows(spark))]
    want = {eval(w)[0]: eval(w)[2:4] for w in brute_repeats(rows, length)}
    got = {r.doc_id: (sum(s.end - s.start for s in r.spans), len(r.spans)) for r in repeats.with_spans(frame(spark, rows), length).collect()}
    assert got == want
    with pytest.raises(ValueError):
        repeats.with_spans(frame(spark, rows), repeats.LEAST - 1)


def test_repeats_block_by_block(spark):
    # blocks don't change what is found: anchors of a text cut in small blocks equal those of the whole
    random.seed(6)
    data = "".join(random.choice("abcd") for _ in range(6000)).encode()
    whole = repeats.anchors(np.frombuffer(data, np.uint8), 400)
    covered = {i for lo, hi in zip(whole[2], whole[3]) for i in range(lo, hi + 1)}
    assert covered == set(range(len(data) - 399))
    old, repeats.BLOCK = repeats.BLOCK, 700
    try:
        parts = {at + i for at, codes in repeats.blocks(data, 400) for lo, hi in zip(*repeats.anchors(codes, 400)[2:]) for i in range(lo, hi + 1)}
    finally:
        repeats.BLOCK = old
    assert parts == covered


def test_cut_keeps_whole_characters():
    assert repeats.cut("aéb", [(2, 3)]) == "aéb"
    assert repeats.cut("aéb", [(1, 3)]) == "ab"
    assert repeats.cut("abc", [(0, 3)]) == ""


def test_edited_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 20)
    rows = real_rows(spark) + [(None, "nul"), (None, None), (5, "five 🙂 again"), (5, ""), (10**6, None), (10**6, None)]
    df = frame(spark, rows)
    h = {r[0]: r[1] for r in df.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), h[r[1]]))
    want = []
    for i, (d, t) in enumerate(order):
        half, nxt = len(t) // 2, order[(i + 1) % len(order)][1]
        edited = t[: len(t) - half] + nxt[:half]
        kept = [fingerprints.winnow(fingerprints.points(x)) for x in (t, edited, nxt)]
        mine, other, after = (set(h.tolist()) for h, _ in kept)
        near = [round(len(mine & x) / len(mine | x), 9) if mine | x else 1.0 for x in (other, after)]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.digest(*kept[0]), fingerprints.digest(*kept[1]), *near))
    got = fingerprints.edited_fingerprints(df).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))) for r in got) == sorted(map(str, want))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    assert fingerprints.edited_fingerprints(df.limit(0)).count() == 0


def test_winnowing(spark):
    random.seed(8)
    for _ in range(300):
        s = "".join(random.choice("ab") for _ in range(random.randint(0, 80)))
        codes = fingerprints.points(s)
        kept, at = fingerprints.winnow(codes, 4, 5)
        grams = [int(fingerprints.winnow(codes[i : i + 4], 4, 1)[0][0]) for i in range(len(s) - 3)]
        if grams:
            w = min(5, len(grams))
            want = sorted({max(j for j in range(i, i + w) if grams[j] == min(grams[i : i + w])) for i in range(len(grams) - w + 1)})
            assert at.tolist() == want
    shared = "the same passage of at least thirty-one characters"
    a, b = (set(fingerprints.winnow(fingerprints.points(x))[0].tolist()) for x in ("12345 " + shared + " abcdefg", "zzz" + shared + "yyyy"))
    assert a & b
    rows = spark.createDataFrame([(None,), ("",), ("ab",)], "text string").select(fingerprints.fingerprint(F.col("text")).alias("f")).collect()
    assert [len(r.f) for r in rows] == [0, 0, 1]


@pytest.mark.parametrize("high", [5, 1000])
def test_compact_windows(high):
    rng = np.random.default_rng(high)
    for _ in range(150):
        v, least = rng.integers(0, high, int(rng.integers(0, 60))).astype(np.uint64), int(rng.integers(1, 10))
        want = []
        for k in range(len(v)):
            a = b = k
            while a > 0 and v[a - 1] >= v[k]:
                a -= 1
            while b < len(v) - 1 and v[b + 1] > v[k]:
                b += 1
            if b - a + 1 >= least:
                want.append((a, k, b))
        assert list(zip(*(x.tolist() for x in passages.compact_windows(v, least)))) == want


def test_near_duplicate_passages(spark):
    random.seed(1)
    vocab = [f"w{i}" for i in range(3000)]
    some = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    rows, line = [], "this line is very common in many documents"
    for i in range(15):
        p = some(60)
        rows += [(i * 100 + k, f"{some(random.randint(0, 200))} {p} {some(random.randint(0, 200))}") for k in range(5)]
    rows += [(10000 + i, f"{some(30)} {line} {some(30)}") for i in range(200)]
    rows += [(20000, None), (20001, ""), (None, "no id"), (20002, "a b"), (20002, "a b")]
    got = {r.doc_id: r.class_id for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert all(got[d] == d // 100 * 100 for d, _ in rows if d is not None and d < 10000)
    assert all(got[d] == d for d, _ in rows if d is not None and d >= 10000) and got[None] is None
    assert passages.near_duplicate_passages(frame(spark, rows).limit(0)).count() == 0


def test_passages_behind_long_unshared_text(spark):
    random.seed(2)
    some = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    rows = []
    for i in range(20):
        p = some(2000)
        rows += [(i * 10 + k, f"{some(3000)} {p} {some(50)}") for k in range(2)]
    got = {r.doc_id: r.class_id for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert got == {d: d // 10 * 10 for d, _ in rows}


def test_hot_keys_dealt_in_ranges_meet_the_same_windows(spark, monkeypatch):
    random.seed(23)
    line = " ".join(f"line{i}" for i in range(60))
    texts = [f"{' '.join(f'w{random.randint(0, 999)}' for _ in range(random.randint(0, 80)))} {line} {line if i % 3 else ''}" for i in range(150)]
    rows = frame(spark, [(i, t) for i, t in enumerate(texts + texts[:20])]).select(F.xxhash64("text").alias("dk"), "text")
    monkeypatch.setattr(passages, "HOT_SHARE", 1)
    hot = passages.hot_keys(rows, 5, 50, 4)
    assert hot
    met = lambda keys: passages.neighbours(rows.mapInPandas(passages.windows(5, 50, 4, keys), passages.WINDOWS)).distinct()
    whole, parted = ({tuple(r) for r in met(keys).collect()} for keys in ([], hot))
    assert whole == parted and len(whole) > 150
    sizes = rows.mapInPandas(passages.windows(5, 50, 4, hot), passages.WINDOWS).groupBy("key", "part").count()
    assert {r.key for r in sizes.filter("part > 0").collect()} == set(hot)


def test_common_starts():
    rng = np.random.default_rng(4)
    for _ in range(100):
        n = int(rng.integers(1, 12))
        pair = np.sort(rng.integers(0, 3, n))
        a = rng.integers(0, 30, n)
        b = a + rng.integers(0, 10, n)
        shift = rng.integers(-40, 40, n)
        got = set()
        for p, base, start, end, most, peak in zip(*passages.common_starts(pair, a, b, shift, 2)):
            own = [(x, y) for q, x, y, s in zip(pair, a, b, shift) if q == p and base <= s < base + passages.SHIFT]
            counts = [sum(x <= i <= y for x, y in own) for i in range(start, end)]
            assert min(counts) >= 2 and max(counts) == most == counts[peak - start]
            got |= {(p, i) for i in range(start, end)}
        want = set()
        for i in range(n):
            for j in range(i):
                if pair[i] == pair[j] and abs(shift[i] - shift[j]) <= passages.SHIFT // 2:
                    want |= {(pair[i], k) for k in range(max(a[i], a[j]), min(b[i], b[j]) + 1)}
        assert want <= got


def test_every_candidate_start_is_searched(spark, monkeypatch):
    # the starts tried first hold nothing: the pair is found by its other candidates
    random.seed(3)
    some = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    p = some(60)
    rows = spark.createDataFrame([(1, f"{some(600)} {p} {some(300)}"), (2, f"{some(600)} {p} {some(300)}")], "dk long, text string")
    runs = spark.createDataFrame([(1, 0, 901, 2, 0, 901)], "first long, first_at int, first_n int, dk long, at int, n int")
    assert passages.verified(rows, runs.selectExpr("first", "0 as first_at", "137 as first_n", "dk", "32 as at", "137 as n"), 5, 46, 0.8).count() == 0
    assert passages.verified(rows, passages.pieces(runs, 46), 5, 46, 0.8).collect() == [(1, 2)]


def test_recall_of_edited_passages(spark):
    # 80 words with one word changed in the middle: brute force finds a passage of 50 words at similarity 0.8 in each pair
    random.seed(12)
    vocab = [f"w{i}" for i in range(50000)]
    some = lambda n: [random.choice(vocab) for _ in range(n)]
    rows = []
    for i in range(600):
        p = some(80)
        q = list(p)
        q[40] = "changed"
        rows += [(2 * i + k, " ".join(some(random.randint(0, 150)) + x + some(random.randint(0, 150)))) for k, x in enumerate((p, q))]

    def sets(t):
        w = t.split()
        s = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        return [set(s[i : i + 46]) for i in range(len(s) - 45)]

    for i in random.sample(range(600), 20):
        assert any(len(a & b) / len(a | b) >= 0.8 for a in sets(rows[2 * i][1]) for b in sets(rows[2 * i + 1][1]))
    got = {r.doc_id: r.class_id for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert all(got[d] in (d, d // 2 * 2) for d in got)
    assert sum(got[2 * i + 1] == 2 * i for i in range(600)) >= 0.95 * 600


@pytest.mark.parametrize("variants", [8, 20])
def test_families_of_variants_keep_their_links(spark, variants):
    """Families of one passage, each member with its own changes: classes and links against brute force over all pairs."""
    random.seed(variants)
    vocab = [f"w{i}" for i in range(50000)]
    some = lambda n: [random.choice(vocab) for _ in range(n)]
    rows, family = [], {}
    for changed in (2, 3, 4):
        for f in range(240 // variants // 2):
            base = some(75)
            for _ in range(variants):
                words = list(base)
                for i in random.sample(range(75), changed):
                    words[i] = random.choice(vocab)
                family[len(rows)] = (changed, f)
                rows.append((len(rows), " ".join(some(random.randint(0, 60)) + words + some(random.randint(0, 60)))))

    def sets(t):
        w = t.split()
        s = [hash(tuple(w[i : i + 5])) for i in range(len(w) - 4)]
        return [set(s[i : i + 46]) for i in range(len(s) - 45)]

    windows = {i: sets(t) for i, t in rows}
    linked = {2: [], 3: [], 4: []}
    for i, j in itertools.combinations(range(len(rows)), 2):
        # two sets of 46 shingles are as similar if they share 41
        if family[i] == family[j] and len(set().union(*windows[i]) & set().union(*windows[j])) >= 41 and any(len(a & b) >= 41 for a in windows[i] for b in windows[j]):
            linked[family[i][0]].append((i, j))
    got = {r.doc_id: r for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert all(family[got[i].class_id] == family[i] for i in got)
    degree = {i: 0 for i in got}
    for changed, pairs in linked.items():
        same = sum(got[i].class_id == got[j].class_id for i, j in pairs)
        assert len(pairs) >= 5 and same >= 0.95 * len(pairs), (changed, same, len(pairs))
        print(variants, changed, same, len(pairs))
        for i, j in pairs:
            degree[i] += 1
            degree[j] += 1
    assert all(got[i].n_links <= degree[i] for i in got)
    print(variants, sum(got[i].n_links for i in got), sum(degree.values()))
    # links are counted to the texts of the NEIGHBOURS windows before: all of them in small families
    assert sum(got[i].n_links for i in got) >= (0.95 if variants <= passages.NEIGHBOURS else 0.75) * sum(degree.values())


def test_links_and_copies_are_counted(spark):
    random.seed(5)
    some = lambda n: " ".join(f"w{random.randrange(10**6)}" for _ in range(n))
    p, alone = some(70), some(90)
    rows = [(1, p + " " + some(30)), (2, some(30) + " " + p), (3, alone), (4, alone), (5, alone), (6, some(80)), (7, "short text"), (8, "short text"), (9, None)]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert got == {1: (1, 1, 0), 2: (1, 1, 0), 3: (3, 2, 2), 4: (3, 2, 2), 5: (3, 2, 2), 6: (6, 0, 0), 7: (7, 0, 0), 8: (8, 0, 0), 9: (9, 0, 0)}


def test_links_beyond_the_neighbours_are_found(spark):
    # under both keys that texts 1 and 60 share, more texts stand between them than are met one by one; theirs is the only link to either
    spread = 60
    window = lambda c: (c << 32) | (c << 16) | 60
    found = spark.createDataFrame([(8 * k + j, d, window(c), 0) for d in range(1, spread + 1) for j, c in ((0, 10), (1, 12 if d in (1, 60) else 500)) for k in (1,)], passages.WINDOWS)
    met = passages.neighbours(found)
    assert met.filter("first = 1 and dk = 60 and key % 8 = 1").count() == 1  # the first text is always met
    assert met.filter("first = 30 and dk = 60").count() == 0
    shared = met.filter("first = dk").groupBy("dk").agg(F.collect_list("key").alias("keys"), F.collect_list(F.when(F.col("many"), F.bitwise_not("at")).otherwise(F.col("at"))).alias("places"))
    labels = spark.createDataFrame([], "node long, label long")
    pairs = {(r.first, r.dk) for r in passages.across(shared, labels, 46, 2).select("first", "dk").distinct().collect()}
    alike = lambda d: d in (1, 60)
    assert (1, 60) in pairs and all(alike(a) == alike(b) for a, b in pairs)
    joined = passages.across(shared, spark.createDataFrame([(d, 1) for d in (1, 60)], "node long, label long"), 46, 2)
    assert joined.filter("first = 1 and dk = 60").count() == 0


def test_classes_are_whole_in_large_groups(spark, monkeypatch):
    """One boilerplate passage in many texts, and pairs of texts that share more of it with each other than with any other: classes against all candidate pairs."""
    random.seed(31)
    monkeypatch.setattr(passages, "NEIGHBOURS", 1)
    vocab = [f"w{i}" for i in range(50000)]
    some = lambda n: [random.choice(vocab) for _ in range(n)]
    base, rows = some(56), []
    for i in range(40):
        words = list(base)
        for at in random.sample(range(56), 4):
            words[at] = random.choice(vocab)
        rows += [(2 * i + k, " ".join(some(random.randint(0, 40)) + words + some(random.randint(0, 40)))) for k in range(2)]
    random.shuffle(rows)
    keyed = frame(spark, rows).select("doc_id", F.xxhash64("text").alias("dk"), "text")
    monkeypatch.setattr(passages, "NEIGHBOURS", 200)
    every, _ = passages.links(keyed, 5, 50, 0.8, 4, 2)
    ids = {r.dk: r.doc_id for r in keyed.collect()}
    label = {i: i for i in ids.values()}
    for r in every.collect() * len(label):
        label[ids[r.dk]] = label[ids[r.first]] = min(label[ids[r.dk]], label[ids[r.first]])
    monkeypatch.setattr(passages, "NEIGHBOURS", 1)
    few, _ = passages.links(keyed, 5, 50, 0.8, 4, 2)
    assert few.count() < every.count()
    # the links to few neighbours alone leave classes apart
    partial = {i: i for i in ids.values()}
    for r in few.collect() * len(partial):
        partial[ids[r.dk]] = partial[ids[r.first]] = min(partial[ids[r.dk]], partial[ids[r.first]])
    assert len(set(partial.values())) > len(set(label.values()))
    got = {r.doc_id: r.class_id for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    assert got == label


def test_pairs_that_share_too_little_are_told_before_their_windows_are_added_up(spark, monkeypatch):
    least, rng = 46, np.random.default_rng(5)
    first, other = [], []
    for shared in (0, 20, 40, 41, 44, 46, 60):
        a = rng.integers(-(2**31), 2**31, 100).astype(np.int32)
        for b in (np.concatenate((a[:shared], rng.integers(0, 2**31, 30).astype(np.int32))), rng.permutation(np.concatenate((a[:shared], rng.integers(0, 2**31, 60).astype(np.int32)))), np.repeat(a[:shared], 2)):
            first.append(a)
            other.append(b)
    need = 2 * least * 0.8 / 1.8 - 1e-9
    hits = [[x in a for x in b] for a, b in zip(first, other)]
    want = [any(sum(h[i : i + least]) >= need for i in range(len(h) - least + 1)) for h in hits]
    added, plain = [], np.cumsum
    monkeypatch.setattr(passages.np, "cumsum", lambda x: added.append(1) or plain(x))
    got = passages.similar(least, 0.8).func(pd.Series(first), pd.Series(other))
    assert got.tolist() == want and 0 < sum(want) < len(want)
    assert len(added) == sum(len(h) >= least and sum(h) >= need for h in hits) < len(want)


def test_boilerplate_shorter_than_a_passage_leaves_few_pairs(spark, monkeypatch):
    """Texts that share a line too short for a link are not met pair by pair, and no link that a search of all pairs finds is lost."""
    random.seed(31)
    monkeypatch.setattr(passages, "NEIGHBOURS", 1)
    vocab = [f"w{i}" for i in range(50000)]
    some = lambda n: [random.choice(vocab) for _ in range(n)]
    line, rows = some(56), []
    for i in range(40):
        # two texts with the same changes in the line: near each other, and to no other text
        words = list(line)
        for at in random.sample(range(56), 4):
            words[at] = random.choice(vocab)
        rows += [(2 * i + k, " ".join(some(random.randint(0, 40)) + words + some(random.randint(0, 40)))) for k in range(2)]
    random.shuffle(rows)
    keyed = frame(spark, rows).select("doc_id", F.xxhash64("text").alias("dk"), "text")
    found, shared = passages.links(keyed, 5, 50, 0.8, 4, 2)
    labels = passages.keep(components.components(found, "first", "dk"))
    links, met = [], []
    for told in (None, lambda each: passages.alike(keyed, each, 5, 46, 0.8, 2)):
        pairs = passages.keep(passages.across(shared, labels, 46, 2, told))
        met.append(pairs.select("first", "dk").distinct().count())
        links.append({tuple(r) for r in passages.checked(keyed, passages.searched(pairs, 46, 4, 2), 5, 46, 0.8).collect()})
    assert links[0] and links[0] <= links[1]
    assert met[0] > 10 * met[1] and met[1] < len(rows)
    sent, search = [], passages.searched
    monkeypatch.setattr(passages, "searched", lambda met, *a: sent.append(met.filter("first != dk").select("first", "dk").distinct().count()) or search(met, *a))
    got = {r.doc_id: r.class_id for r in passages.near_duplicate_passages(frame(spark, rows)).collect()}
    joined = {(ids[a], ids[b]) for ids in [{r.dk: r.doc_id for r in keyed.collect()}] for a, b in links[0]}
    assert all(got[a] == got[b] for a, b in joined) and sent[1] == met[1]
