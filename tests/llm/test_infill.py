"""Fill-in-the-middle: the scatter of whole batches against slicing text by text."""

import hashlib
import random
import re

import numpy as np

from tessera.llm import infill
from tests.conftest import SF

ODD = [None, "", " ", "a", "ab1cd", "has <P> in it", "<S>", "<M", "<", "P>", "tail <", "é🙂é", "日本語 text\nline", "\x00\t", "x" * 4000, "word " * 3000, "é🙂z" * 2500, "<P", "S><M"]


def plainly(doc_id, text, seed=1, plain_from=90, spm_below=20):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted(x % (len(tokens) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(tokens[a:b]) for a, b in ((0, i), (i, j), (j, len(tokens))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plain_from:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < spm_below:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_batches_equal_slices_whatever_the_block(monkeypatch):
    random.seed(4)
    texts = [t or "" for t in ODD] + ["".join(random.choice("aZ <>PSM.é日🙂\n9") for _ in range(random.randint(0, 60))) for _ in range(300)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    digests = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i in range(len(texts))]
    h = np.array([[int(d[8 * k : 8 * k + 8], 16) for k in range(4)] for d in digests])
    want = [plainly(i, t) for i, t in enumerate(texts)]
    for block in (1, 5, 64, 1 << 21):
        monkeypatch.setattr(infill, "BLOCK", block)
        if block < 64:  # every block costs numpy calls
            part = slice(19, 119)
            own, b = data[bounds[19] : bounds[119]], bounds[19:120] - bounds[19]
        else:
            part, own, b = slice(0, None), data, bounds
        n, form, prefix, middle, out, out_bounds = infill.rearrange(own, b, h[part], 90, 20)
        outputs = [out[x:y].tobytes().decode() for x, y in zip(out_bounds, out_bounds[1:])]
        got = [(int(a), str(infill.FORMS[f]), int(p) if f else None, int(m) if f else None, o) for a, f, p, m, o in zip(n, form, prefix, middle, outputs)]
        assert got == want[part]
        back, back_bounds = infill.put_back(out, out_bounds, form)
        assert back.tobytes() == own.tobytes() and (back_bounds == b).all()


def test_query_on_odd_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "no id at all", 2), (3, "a", 3), (3, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted(str((i, *plainly(i, t)[:4], sha(plainly(i, t)[4]), sha(t or ""))) for i, t, _ in rows)
    assert sorted(str(tuple(r)) for r in infill.infill_digests(docs).collect()) == want
    made = infill.fill_in_middle(docs, seed=7, plain_from=50, spm_below=60).collect()
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output.decode())) for r in made) == sorted(str((i, *plainly(i, t, 7, 50, 60))) for i, t, _ in rows)
    assert infill.infill_digests(docs.limit(0)).count() == 0
    ids = spark.createDataFrame([("x", "some text")], "doc_id string, text string")
    assert infill.fill_in_middle(ids).first().doc_id == "x"


def test_matches_sql(spark):
    import duckdb

    from tessera.llm import entry

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(entry.ORACLES["op12_fill_in_middle"]).fetchall()
    assert sorted(map(str, map(tuple, entry.op12_fill_in_middle(spark, SF).collect()))) == sorted(map(str, want))
