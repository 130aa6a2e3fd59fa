"""Operators whose result for a document depends on that document alone."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from tessera.llm import bpe, decontaminate, entry, langid, licenses, sharding, token_counts
from tests.conftest import SF

PIECE, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", " ", "a", "A b", "x" * 5000, "é🙂 " * 300, "line\n" * 50, "\t\n  two  spaces \x0b", "</s> <unk> <0x0A>"]


def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use inside."""
    rows = [(i, t, None, "s", None, 1, 2) for i, t in enumerate(ODD)] + [(1, "", None, "s", None, 1, 2), (None, "no id", "en", None, 3, 1, 2), (77, "again", None, "s", 4, 1, 2), (77, "again", None, "s", 4, 1, 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _ka int, fp int")


def real_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_token_counts(spark):
    import sentencepiece as sp

    lib = sp.SentencePieceProcessor(model_file=PIECE)
    for docs in (odd_docs(spark), real_docs(spark)):
        text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        got = token_counts.count_tokens(docs, PIECE).collect()
        assert len(got) == docs.count()
        for r in got:
            t = text[r.doc_id] or ""
            assert (r.n_tokens, r.n_bytes, r.over_limit) == (len(lib.encode(t)), len(t.encode()), len(lib.encode(t)) > 4096)


def test_long_texts_are_counted_in_chunks(spark, monkeypatch):
    import sentencepiece as sp

    monkeypatch.setattr(token_counts, "LONG", 400)
    lib = sp.SentencePieceProcessor(model_file=PIECE)
    big = "word and more  " * 30000
    rows = [*((i, t) for i, t in enumerate([*ODD, "x" * 1000, " " * 900, big, big, "é" * 70000])), (None, big)]
    got = sorted(str((r.doc_id, r.n_tokens)) for r in token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PIECE).collect())
    assert got == sorted(str((i, len(lib.encode(t or "")))) for i, t in rows)
    assert token_counts.count_tokens(real_docs(spark).limit(0), PIECE).count() == 0


def test_scan_is_all_prefixes():
    m = token_counts.load(PIECE)
    maps = [m.chunk(c) for c in token_counts.chunks(token_counts.marked("some words to be counted in very small chunks, onebyone"), 4)]
    left = maps[0]
    for k, x in enumerate(m.scan(maps)):
        left = m.compose(left, maps[k]) if k else left
        assert x == left


def test_transducer_equals_library_on_random_texts_and_chunks():
    m = token_counts.load(PIECE)
    random.seed(2)
    for _ in range(2000):
        t = "".join(random.choice("  ▁\n\tabcdeeiost.,日é🙂#01\x00") for _ in range(random.randint(0, 40)))
        assert m.count(t) == len(m.library.encode(t)), repr(t)
        if t:
            marked = "▁" + t.replace(" ", "▁")
            maps = [m.chunk(c) for c in token_counts.chunks(marked, 5)]
            left = maps[0]
            for x in maps[1:]:
                left = m.compose(left, x)
            right = maps[-1]
            for x in maps[-2::-1]:
                right = m.compose(x, right)
            assert left == right


def test_byte_bpe_round_trip(spark):
    enc = bpe.load(RANKS, P.PATTERN)
    for docs in (odd_docs(spark), real_docs(spark)):
        text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        for r in bpe.encoded_digests(docs, RANKS, P.PATTERN).collect():
            t = text[r.doc_id] or ""
            ids = enc.encode_ordinary(t)
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    ids = bpe.encode(odd_docs(spark), RANKS, P.PATTERN)
    back = bpe.decode(ids, RANKS, P.PATTERN).select("text", "bytes").collect()
    assert all(bytes(r.bytes).decode() == (r.text or "") for r in back)


def test_safe_parts_change_no_id():
    enc = bpe.load(RANKS, P.PATTERN)
    random.seed(1)
    for _ in range(500):
        t = "".join(random.choice("ab1 .'\n\t\x1c é") for _ in range(random.randint(0, 200)))
        assert "".join(bpe.safe_parts(t, 10)) == t
        assert bpe.encode_text(enc, t, 10) == enc.encode_ordinary(t)


def test_sharding_law(spark):
    for docs in (odd_docs(spark), real_docs(spark)):
        got = sharding.shard(docs).toPandas()
        n = got.groupby("shard").slot.agg(["count", "min", "max"])
        assert len(got) == docs.count() and n["count"].max() - n["count"].min() <= 1
        assert (n["min"] == 0).all() and (n["max"] == n["count"] - 1).all()
    text = {r.doc_id: r.text for r in real_docs(spark).collect()}
    for r in got.itertuples():
        assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    again = sharding.shard(real_docs(spark).repartition(7)).toPandas()
    assert got.sort_values("doc_id")[["doc_id", "shard", "slot"]].values.tolist() == again.sort_values("doc_id")[["doc_id", "shard", "slot"]].values.tolist()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1000, 4099])
def test_feistel_is_a_permutation(spark, n):
    place = sharding.permute(F.col("id"), F.lit(n), 5)
    rows = spark.range(n).select(place.alias("p"), sharding.inverse(place, F.lit(n), 5).alias("i"), "id").collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.i == r.id for r in rows)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_sharding_places_every_row_by_its_number(spark, kind):
    # a third of the rows under one id, nulls, repeated rows; places are computed again from sorted rows
    random.seed(7)
    ids = [None] * 20 + [7] * 500 + [random.randint(-50, 900) for _ in range(980)]
    rows = [(i, random.choice([None, "", "a", f"t{random.randint(0, 10**6)}"])) for i in ids]
    rows = [(i if kind == "long" or i is None else f"k{i}", t) for i, t in rows]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(5)
    got = sharding.shard(docs, 16, key=3).collect()
    keyed = lambda i, c, s: (i is not None, i if i is not None else 0, c is not None, c or 0, s)
    order = sorted(((i, None if t is None else zlib.crc32(t.encode()), len((t or "").encode()) + 1) for i, t in rows), key=lambda r: keyed(*r))
    n = len(rows)
    places = [r.p for r in spark.range(n).select("id", sharding.permute(F.col("id"), F.lit(n), 3).alias("p")).orderBy("id").collect()]
    want = sorted(str((*r, p % 16, p // 16)) for r, p in zip(order, places))
    assert sorted(str((r.doc_id, r.text_crc32, r.size, r.shard, r.slot)) for r in got) == want
    assert sharding.shard(docs.limit(0)).count() == 0


def test_language_id_against_brute_force(spark):
    from collections import Counter

    docs = real_docs(spark).limit(60)
    profiles = langid.fit(real_docs(spark), ranks=50)

    def grams(t):
        words = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        out = []
        for w in words:
            padded = f" {w} "
            out += [*w, *zip(padded, padded[1:]), *zip(padded, padded[1:], padded[2:])]
        return Counter(map(tuple, out))

    def code(g):
        n = [ord(c) if c != " " else 0 for c in g]
        return {1: lambda: n[0] | int(langid._ONE), 2: lambda: n[0] << 21 | n[1] | int(langid._TWO), 3: lambda: n[0] << 42 | n[1] << 21 | n[2]}[len(n)]()

    rank = {name: {c & (1 << 64) - 1: k for k, c in enumerate(codes)} for name, codes in profiles}
    for r in docs.select("text", langid.predict(F.col("text"), profiles, 50).alias("p")).collect():
        mine = [g for g, _ in sorted(((code(g), -n) for g, n in grams(r.text or "").items()), key=lambda x: (x[1], x[0]))[:50]]
        if not mine:
            assert r.p.lang == "und"
            continue
        away = {name: sum(min(abs(k - known[g]), 50) if g in known else 50 for k, g in enumerate(mine)) for name, known in rank.items()}
        assert away[r.p.lang] == min(away.values()) and abs(r.p.score - (1 - away[r.p.lang] / (50 * len(mine)))) < 1e-9


def test_language_id(spark):
    docs = real_docs(spark)
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    profiles = langid.fit(docs)
    odd = odd_docs(spark).select("text", langid.predict(F.col("text"), profiles).alias("p")).collect()
    assert all((r.p.lang == "und") == (not any(c.isalpha() for c in r.text or "")) for r in odd)
    assert langid.fit(odd_docs(spark).limit(0)) == []


def test_out_of_place_distance(spark):
    # profile a, b (ranks 0, 1); a document with b more often than a is one place out for each, as are its other n-grams
    codes = [int(c) for c in langid.top("b b b a a", 10).view(np.int64)]
    docs = spark.createDataFrame([("b b b a a",)], "text string")
    p = docs.select(langid.predict(F.col("text"), [("x", codes), ("y", codes[::-1])], 10).alias("p")).first().p
    assert p.lang == "x" and p.score == 1.0


def test_decontamination_against_brute_force(spark):
    bench = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog."), (2, "three little words"), (3, None), (4, ""), (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z 0 1 2 3 4")], "item_id long, text string")
    texts = {
        10: "so THE QUICK brown fox -- jumps over the lazy dog ran", 11: "the quick brown fox jumps", 12: "three little words", 13: "words little three", 14: None, 15: "",
        16: "pad " * 3000 + "a b c d e f g h i j k l m n o p q r s t u v w x y z 0 1 2 3 4 " + "pad " * 3000,
        17: "a b c d e f g h i j k l m n o p q r s XX t u v w x y z 0 1 2 3 4",
    }
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()] + [(10, texts[10])], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.leaking_pairs(docs, bench).collect())
    want = []
    for d, t in [*texts.items(), (10, texts[10])]:
        w = decontaminate.words(t or "")
        for r in bench.collect():
            iw = decontaminate.words(r.text or "")
            k = min(5, len(iw))
            own = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
            there = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
            if own and len(own & there) >= 0.8 * len(own):
                want.append((d, r.item_id))
    assert got == sorted(want) and (16, 5) in got
    assert decontaminate.leaking_pairs(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaking_pairs(docs.limit(0), bench).count() == 0


def test_decontamination_sketches_beside_small_items(spark, monkeypatch):
    # items of all sizes, with ids that are strings; documents are sketched although small items are sought
    random.seed(9)
    vocab = [f"v{i}" for i in range(400)]
    some = lambda n: " ".join(random.choice(vocab) for _ in range(n))
    items = [(f"i{k}", some(random.choice([1, 3, 5, 8, 14, 17, 40, 90]))) for k in range(60)] + [(None, some(30)), ("i0", some(20))]
    texts = [(f"d{k}", f"{some(random.randint(0, 900))} {items[k % 62][1]} {some(random.randint(0, 900))}") for k in range(80)] + [(None, None), ("e", "")]

    def brute():
        out = []
        for d, t in texts:
            w = decontaminate.words(t or "")
            for i, x in items:
                iw = decontaminate.words(x)
                k = min(5, len(iw))
                own, there = ({tuple(v[j : j + k]) for j in range(len(v) - k + 1)} for v in (iw, w))
                if len(own & there) >= 0.8 * len(own):
                    out.append(str((d, i, len(own & there), len(own))))
        return sorted(out)

    docs, bench = spark.createDataFrame(texts, "doc_id string, text string"), spark.createDataFrame(items, "item_id string, text string")
    want = brute()
    for most in (decontaminate.BLOCK_ITEMS, 10):
        monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", most)
        assert sorted(str(tuple(r)[:4]) for r in decontaminate.leaking_pairs(docs, bench).collect()) == want
    block = decontaminate.Items(items, 5, 0.8)
    h = decontaminate.shingle_hashes(decontaminate.word_hashes(texts[0][1]), 5)
    cls = decontaminate.size_class(len(h))
    assert 0 < len(decontaminate.minima(h, decontaminate.bits(cls))) < len(h)
    own = {k for k, x in enumerate(block.hashes) if len(x) > decontaminate.SMALL and block.sizes[k] == 5}
    assert own and set(block.table(5, cls)[2].tolist()) <= own


def test_least_class_is_where_minima_begin():
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2))
    least = decontaminate.least_class(h)
    for cls in range(20):
        assert h[least <= cls].tolist() == decontaminate.minima(h, decontaminate.bits(cls)).tolist()


def test_decontamination_in_blocks(spark, monkeypatch):
    docs, bench = real_docs(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {tuple(r) for r in decontaminate.leaking_pairs(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 15)
    assert {tuple(r) for r in decontaminate.leaking_pairs(docs, bench).collect()} == want and want
    # many items in one document: verified in several lots, repeated documents and their items answered alike
    monkeypatch.setattr(decontaminate, "VERIFIED_ITEMS", 4)
    assert {tuple(r) for r in decontaminate.leaking_pairs(docs, bench).collect()} == want
    every = spark.createDataFrame([(1, " ".join(r.text for r in bench.collect()))] * 2, "doc_id long, text string")
    found = sorted(r.item_id for r in decontaminate.leaking_pairs(every, bench).collect())
    assert found == sorted([r.item_id for r in bench.collect()] * 2)


def test_license_scan(spark):
    docs = real_docs(spark)
    got = {}
    for r in licenses.scan_licenses(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    notices = [t for _, kind, t in licenses.TEMPLATES if kind == "notice"]
    want = {r.doc_id: sum(r.text.count(n) for n in notices) for r in docs.collect() if any(n in r.text for n in notices)}
    assert got == want and want
    assert licenses.scan_licenses(odd_docs(spark)).count() == 0
    text = licenses.TEMPLATES[8][2].split()
    broken = " ".join(w for i, w in enumerate(text) if i % 12)
    rows = licenses.scan_licenses(spark.createDataFrame([(1, "foo the " * 500 + broken + " bar of" * 500)], "doc_id long, text string")).collect()
    assert [(r.license, r.kind) for r in rows] == [("MIT", "text")] and 0.85 < rows[0].coverage < 0.95


def test_license_copies_close_together(spark):
    mit, apache = licenses.TEMPLATES[8][2], licenses.TEMPLATES[0][2]
    broken = " ".join(w for i, w in enumerate(mit.split()) if i % 12)
    texts = [f"the MIT License Copyright A {mit} Copyright B {mit} more words", f"the {apache}\n{apache}", f"{mit} " * 5, f"the {broken} {mit} and {broken}", f"of {apache} x {apache} y {apache} the", f"the {'word ' * 60}{mit}"]
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    for text, want in zip(texts, ([1, 1], [1, 1], [1] * 5, [0.9, 1, 0.9], [1, 1, 1], [1])):
        kind = ("MIT", "text") if mit in text else ("Apache-2.0", "notice")
        got = sorted((x[3], x[4], x[2]) for x in scanner.scan(text) if x[:2] == kind)
        assert len(got) == len(want) and all(abs(x[2] - w) < 0.05 for x, w in zip(got, want))
        assert all(x[1] < y[0] for x, y in zip(got, got[1:]))


def test_alignment_is_increasing_and_equal():
    random.seed(4)
    for _ in range(200):
        a, b = ([random.choice("abcdefgh") for _ in range(random.randint(0, 30))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert licenses.align(list("abc"), list("abc")) == [(0, 0), (1, 1), (2, 2)]


def plain_alignment(a, b):
    """Number of template words aligned, from the definition: recursion between anchors, dynamic programming where there are none."""
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + plain_alignment(a[1:], b[1:])
    if a[-1] == b[-1]:
        return 1 + plain_alignment(a[:-1], b[:-1])
    both = [(a.index(w), b.index(w)) for w in a if a.count(w) == 1 and b.count(w) == 1]
    if not both:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]
    chains = {}
    for i, j in both:
        # as the anchors' places in b are distinct, a longest chain of each length is told by its end alone
        before = [c for (k, m), c in chains.items() if k < i and m < j]
        chains[i, j] = max(before, key=len, default=[]) + [(i, j)]
    chain = max(chains.values(), key=len)
    edges = [(-1, -1), *chain, (len(a), len(b))]
    return len(chain) + sum(plain_alignment(a[i + 1 : k], b[j + 1 : m]) for (i, j), (k, m) in zip(edges, edges[1:]))


def test_gaps_without_unique_words_are_aligned():
    a, b = "x the of the of y".split(), "x of the of the the y".split()
    assert len(licenses.align(a, b)) == plain_alignment(a, b) == 5


def test_license_coverage_against_brute_force(spark):
    """Every window of a document against every template: what holds a template is found, what doesn't is left alone, the coverage agrees."""
    rng = random.Random(8)
    common = "the of to and or in a this".split()
    templates = [(f"L{i}", "text", " ".join(rng.choice(common) if rng.random() < 0.4 else f"w{i}{rng.randrange(12)}" for _ in range(16 + 4 * i))) for i in range(3)]
    rows = []
    for d in range(60):
        out = [rng.choice(common) for _ in range(rng.randrange(20))]
        for _ in range(rng.randrange(3)):
            lost, added = rng.choice([(0, 0), (0.1, 0.05), (0.2, 0.1), (0.4, 0.1)])
            for w in rng.choice(templates)[2].split():
                out += [rng.choice(common)] * (rng.random() < added) + [w] * (rng.random() >= lost)
            out += [f"z{rng.randrange(50)}" for _ in range(rng.randrange(30))]
        rows.append((d, " ".join(out)))
    got = {}
    for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect():
        got[r.doc_id, r.license] = max(got.get((r.doc_id, r.license), 0), r.coverage)
    held = missed = 0
    for d, text in rows:
        w = text.split()
        for name, _, t in templates:
            t = t.split()
            need, span = -(-len(t) * 4 // 5), int(licenses.SPREAD * len(t))
            counts = [plain_alignment(t, w[i : i + span]) for i in range(len(w))]
            ends = [plain_alignment(t, w[max(0, j - n) : j]) for j in range(need, len(w) + 1) for n in (need, len(t), span)]
            best = max([*counts, *ends], default=0) / len(t)
            if best >= 0.8:
                held += 1
                missed += (d, name) not in got
                assert (d, name) not in got or abs(got[d, name] - best) <= 0.1
            elif best < 0.75:
                assert (d, name) not in got
    assert held > 20 and missed == 0


def test_registered_queries_name_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in entry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_queries_stand_empty_tables(spark, tmp_path, name):
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert entry.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_only_patterns_that_part_at_white_space_are_cut():
    assert bpe.cuts_safely(P.PATTERN)
    assert not bpe.cuts_safely(r"\w+\s*|[^\w]+") and not bpe.cuts_safely(r"(?s).+")


def test_long_texts_are_encoded_in_parts_through_spark(spark):
    big = "many words and more of them, 123 times over.\n" * 9000
    assert len(big) > bpe.PART_CHARS
    rows = [(1, big), (2, big + "x" * 300000)]
    enc = bpe.load(RANKS, P.PATTERN)
    for r in bpe.encoded_digests(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, P.PATTERN).collect():
        t = dict(rows)[r.doc_id]
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        if r.doc_id == 1:
            assert r.n_tokens == len(enc.encode_ordinary(t))


def test_templates_come_from_a_table_of_checked_size(spark):
    table = spark.createDataFrame([*licenses.TEMPLATES, ("none", "text", None)], "license string, kind string, text string")
    assert licenses.templates_from(table) == sorted(licenses.TEMPLATES)
    with pytest.raises(ValueError):
        licenses.templates_from(table, most=3)
