import random
import re
import zlib
from collections import Counter

import pytest

from aerofeat.llm.registry import op11_spelling_variants
from aerofeat.llm.spelling import near_pairs, spelling_variants

SF001 = "/root/testdata/sf0.001"


def brute_words(docs, least=7, least_count=2, one_in=31):
    seen = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % one_in == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            if len(run) >= least:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[p:] == b[p + 1:] or a[p + 1:] == b[p + 1:]


def brute(docs, times=10, **kw):
    n = brute_words(docs, **kw)
    gaps = {}
    for w in n:
        for i in range(len(w)):
            gaps.setdefault(w[:i] + w[i + 1:], set()).add(w)
        gaps.setdefault(w, set()).add(w)
    near = {w: {v for i in range(len(w) + 1) for v in gaps.get(w[:i] + w[i + 1:], ()) if one_edit(w, v)}
            | {v for v in gaps.get(w, ()) if one_edit(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def rows(df):
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(5)
    docs = []
    for i in range(150):
        words = []
        for _ in range(rnd.randrange(60)):
            w = rnd.choice(["abcdefgh", "Zürichsee", "aaaaaaaa", "aaaaaaa", "ÀÉîõüÿß", "international"])
            for _ in range(rnd.choice([0, 0, 0, 1, 2])):
                k = rnd.randrange(len(w) + 1)
                w = rnd.choice([w[:k] + rnd.choice("abÿZ") + w[k:], w[:k] + w[k + 1:], w[:k] + "é" + w[k + 1:]])
            words.append(w)
        docs.append((i, rnd.choice([" ", "-", "1"]).join(words)))
    return docs + [(None, "abcdefgh abcdefgh"), (7, None), (8, ""), (9, "!!"), (3, docs[3][1]), (3, docs[3][1])]


@pytest.mark.parametrize("pairs", [1, 256])
def test_equals_brute_force(spark, messy, pairs):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in messy], "doc_id long, text string, word string, n int").repartition(3)
    want = brute(messy)
    assert rows(spelling_variants(df, pairs=pairs)) == want
    assert any(r[1] != w for w, r in want.items()) and any(r[3] > 3 for r in want.values())


def test_chains_of_forms_end_at_one_root(spark):
    text = " ".join(["abcdefgh"] * 300 + ["abcdefg"] * 25 + ["bcdefgh"] * 2 + ["abcdef"] + ["abxdefg"] * 2)
    df = spark.createDataFrame([("t", text)], "doc_id string, text string")
    got = rows(spelling_variants(df, one_in=1 << 40))
    assert got["abxdefg"] == ("abcdefg", "abcdefgh", 2, 1, 25)
    assert got["bcdefgh"][:2] == ("abcdefgh", "abcdefgh") and got["abcdefgh"][:2] == (None, "abcdefgh")


def test_words_that_share_a_chunk_are_not_all_paired(spark):
    """2,000 words with one first half: cut again until the groups are small."""
    rnd = random.Random(3)
    words = {"abcdefgh" + "".join(rnd.choice("ijklmnop") for _ in range(8)): 2 for _ in range(2000)}
    words |= {w[:3] + w[4:]: 5 for w in list(words)[:300]} | {"é" * 3000: 9, "é" * 2999: 9, "é" * 1500 + "x" + "é" * 1499: 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {(r.word, r.near) for r in near_pairs(df, pairs=8).collect()}
    each = list(words)
    want = {(a, b) for i, a in enumerate(each) for b in each[:i] if one_edit(a, b)}
    assert got == want | {(b, a) for a, b in want} and len(got) > 600


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(df).collect() == []
    one = spark.createDataFrame([(1, "sevenlet short")], "doc_id long, text string")
    assert spelling_variants(one).collect() == [] and spelling_variants(one, least_count=1).count() == 1


def test_query_on_given_tables(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    assert rows(op11_spelling_variants(spark, SF001)) == brute([tuple(r) for r in d.collect()])
