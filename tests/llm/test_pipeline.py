"""The corpus pipeline stage by stage, and its end result, on small documents."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline as cp
import public_tokenizers as P
from tessera.llm import bpe, decontaminate, repeats
from tests.conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_keep_columns_and_take_effect(spark, docs, tmp_path):
    now, texts = docs, {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in now.collect()}
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in now.collect()}
        assert set(after) <= set(before)
        if k < len(cp.STAGES) - 1:
            assert now.columns == COLUMNS
        if name == "language_id":
            assert all(any(c.isalpha() for c in r.text) for r in after.values()) and len(after) > 0.95 * len(before)
        if name == "simhash_near_dedup":
            kept = {r.text for r in after.values()}
            assert len(kept) == len(after) and len(after) < len(before)
        if name == "suffix_array_dedup":
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for d, r in after.items() if r.text != texts[d])
            n = repeats.PASSAGE
            grams = lambda t: [b[i : i + n] for b in [t.encode()] for i in range(len(b) - n + 1)]
            starts = Counter(g for r in before.values() for g in grams(r.text))
            there = {g for g, k in starts.items() if k > 1}
            assert there and not any(g in there for r in after.values() for g in grams(r.text))
            assert all(r.text == texts[d] for d, r in after.items() if there.isdisjoint(grams(texts[d])))
        if name == "benchmark_decontamination":
            items = [decontaminate.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            for d, r in before.items():
                w = decontaminate.words(r.text or "")
                there = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
                leak = any(len(own & there) >= 0.8 * len(own) for x in items for own in [{tuple(x[i : i + 5]) for i in range(len(x) - 4)}])
                assert leak == (d not in after)
        if name == "byte_level_bpe":
            enc = bpe.load(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
            for d, r in after.items():
                assert r.n_tokens == len(enc.encode_ordinary(before[d].text)) and r.decoded_sha256 == hashlib.sha256(before[d].text.encode()).hexdigest()
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, now.collect()))


def test_stages_stand_nulls_repeats_and_odd_columns(spark, docs, tmp_path):
    extra = spark.createDataFrame([(1, None, None, None, None), (None, "Ein Text ohne Nummer, aber mit Worten.", "de", None, 5), (1007, "", "en", "s", 0), (1008, "1234 5678", "en", "s", 9)] + [(1009, "Once more the same words here", "en", "s", 30)] * 3, docs.schema)
    now = docs.limit(50).unionByName(extra).selectExpr("*", "1 as fp", "2 as ranges", "'x' as score")
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == [*COLUMNS, "fp", "ranges", "score"]
    rows = now.collect()
    assert not [r for r in rows if r.text is None or r.doc_id in (1007, 1008)]
    assert len([r for r in rows if r.doc_id == 1009]) == 1 and len([r for r in rows if r.doc_id is None]) == 1
    assert cp.encoding(spark, now, SF).count() == len(rows)


def test_stages_stand_an_empty_table(spark, docs):
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
