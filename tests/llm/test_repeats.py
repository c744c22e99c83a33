import hashlib
import random

import pytest

from aerofeat.llm.repeats import remove_repeats

SF001 = "/root/testdata/sf0.001"


def brute(docs, length):
    """docs: (doc_id, text) in order → {doc_id: (n_bytes, n_removed, n_spans, kept)}."""
    seen, out = set(), {}
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in df.collect()}


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(5)
    words = ["ab", "cde", "f", "été", "xyz", "漢字", "lorem", "ipsum"]
    base = [" ".join(rnd.choice(words) for _ in range(120)) for _ in range(6)]
    docs = []
    for i in range(60):
        t = rnd.choice(base)
        if i % 3 == 0:
            cut = rnd.randrange(len(t))
            t = t[:cut] + rnd.choice(words) + t[cut:]
        if i % 4 == 0:
            t = t + rnd.choice(base)[:rnd.randrange(200)]
        docs.append((i, t))
    docs += [(60, None), (61, ""), (62, "short"), (63, "ha " * 500), (64, "ha " * 700), (65, "a" * 99), (66, "a" * 300)]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize("length,q,hot", [(100, 28, 100_000), (100, 28, 2), (20, 7, 100_000), (10, 9, 3)])
def test_equals_brute_force(spark, messy, length, q, hot):
    df = spark.createDataFrame(messy, "doc_id long, text string").repartition(5)
    assert rows(remove_repeats(df, length, q, hot)) == brute(sorted(messy), length)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    assert rows(remove_repeats(df)) == brute(docs, 100)


def test_ids_that_repeat_or_miss(spark):
    t = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    df = spark.createDataFrame([(1, t, 1), (1, t, 2), (1, t + "!", 3), (None, t, 4), (None, None, 5)],
                               "doc_id long, text string, _key long")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(df).collect()), key=str)
    n = len(t)
    assert len(got) == 4                       # the repeated row is one document
    assert (None, n, n) in got and (None, 0, 0) in got
    assert sorted(g[1:] for g in got if g[0] == 1) in ([(n, 0), (n + 1, n)], [(n, n), (n + 1, 0)])


def test_text_output_and_empty_table(spark):
    t = "é" * 80
    df = spark.createDataFrame([(1, "x" + t), (2, t), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in remove_repeats(df, output="text").collect()}
    assert got == {1: "xé", 2: "", 3: None}
    assert remove_repeats(df.limit(0)).count() == 0
