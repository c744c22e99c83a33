import random
import re

import pytest

from aerofeat.llm.licenses import PHRASES, TEMPLATES, scan_licenses

SF001 = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, share=0.9, templates=TEMPLATES):
    w = words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for p, label in PHRASES.items():
        p = p.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
                score = 1.0
    for block in re.split(r"\n|(?<=[.!?;])(?=[ \t-\r])", text or ""):
        b = set(words(block))
        for label, texts in templates.items():
            for t in texts:
                t = set(words(t))
                if t and len(b & t) >= share * len(t) - 1e-9:
                    labels.add(label)
                    score = max(score, len(b & t) / len(t))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), round(score, 9))


def row(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(2)
    lines = [t for ts in TEMPLATES.values() for t in ts] + ["Cc-by", "the software is", "é à 漢字", "GENERAL, public;license", ""]
    docs = []
    for i in range(150):
        t = []
        for _ in range(rnd.randrange(6)):
            w = rnd.choice(lines).split(" ")
            for _ in range(rnd.randrange(3)):
                w[rnd.randrange(len(w))] = rnd.choice(["x", "all", "license", ""])
            rnd.random() < 0.2 and rnd.shuffle(w)
            t.append(" ".join(w) + rnd.choice(["", ".", ". ", "\n", "; "]))
        docs.append((i, rnd.choice(["\n", " ", ". "]).join(t)))
    return docs + [(900, None), (901, ""), (902, "all rights reserved " * 4000), (903, "x" * 50000)]


def test_equals_brute_force(spark, messy):
    df = spark.createDataFrame(messy, "doc_id long, text string").repartition(3)
    got = {r.doc_id: row(r) for r in scan_licenses(df).collect()}
    assert got == {d: brute(t) for d, t in messy}
    loose = {r.doc_id: row(r) for r in scan_licenses(df, share=(60, 100)).collect()}
    assert loose == {d: brute(t, 0.6) for d, t in messy} != got
    assert any("mit" in x[5] for x in got.values())


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: brute(r.text) for r in df.collect()}
    assert {r.doc_id: row(r) for r in scan_licenses(df).collect()} == want


def test_other_templates_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d", "z"), (1, "a b c d", "z"), (None, "a b", "z")], "doc_id long, text string, labels string")
    t = {"t": ["a b c d e"], "none": ["!!"]}
    got = sorted((str(r.doc_id), r.labels, r.score) for r in scan_licenses(df, t, share=(80, 100)).collect())
    assert got == [("1", "t", 0.8), ("1", "t", 0.8), ("None", "", 0.0)]
    assert scan_licenses(df, {}).count() == 3 and scan_licenses(df.limit(0)).count() == 0
