import random
import re
from collections import Counter

import pytest

from aerofeat.llm.phrases import collocations, phrase_counts
from aerofeat.llm.registry import op12_phrase_collocations

SF001 = "/root/testdata/sf0.001"


def brute_counts(docs, longest=3):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    return f, n


def brute(docs, longest=3, least=10, inside=(50, 100), top=2000):
    f, n = brute_counts(docs, longest)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    around = Counter()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i:i + m]] = max(around[lang, w[i:i + m]], a)
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in around and inside[1] * around[lang, w] >= inside[0] * a:
            continue
        score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def rows(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(8)
    vocab = ["The", "of", "new", "York", "été", "a\x00b", "漢", "x"]
    docs = []
    for i in range(200):
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(80))]
        text = "".join(w + rnd.choice([" ", " ", "  ", "\t", " \t", ". ", ",", "\n", "\r\n", "!?", " - "]) for w in words)
        docs.append((rnd.choice(["en", "de", None, "und"]), text))
    return docs + [("en", None), ("en", ""), ("zz", " \t "), (None, None), ("en", "of of of " * 4000), ("en", docs[0][1]), ("en", docs[0][1])]


@pytest.mark.parametrize("how", [{}, {"width": 6}, {"slice_bytes": 200, "together": 50}, {"longest": 4}, {"top": 5, "least": 3}])
def test_equals_brute_force(spark, messy, how):
    """Also with fingerprints so short that nearly all of them collide."""
    df = spark.createDataFrame([(lang, t, 1, "p") for lang, t in messy], "lang string, text string, n int, phrase string").repartition(3)
    want = brute(messy, **{k: v for k, v in how.items() if k in ("longest", "top", "least")})
    assert rows(collocations(df, **how)) == want and want


def test_counts_of_all_frequent_phrases(spark, messy):
    df = spark.createDataFrame(messy, "lang string, text string")
    f, n = brute_counts(messy)
    got = {(r.lang, r.phrase): r.f for r in phrase_counts(df, width=9).collect() if r["size"]}
    assert got == {(lang, " ".join(w)): a for (lang, w), a in f.items() if a >= 10}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert rows(collocations(df)) == []
    assert rows(collocations(spark.createDataFrame([("en", None)], "lang string, text string"))) == []


def test_query_on_given_tables(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("lang", "text")
    assert rows(op12_phrase_collocations(spark, SF001)) == brute([tuple(r) for r in d.collect()])
