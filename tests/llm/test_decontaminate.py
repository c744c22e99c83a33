import random
import re

import pytest

from aerofeat.llm.decontaminate import contamination

SF001 = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in wins}
    out = {}
    for d, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out[d] = (len(w), len(hit), sorted(str(i) for i in found if i is not None), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect()}


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(11)
    vocab = ["a", "b", "c", "été", "42", "x9", "漢字"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 6, 7, 9, 12, 13, 14, 40])))) for i in range(30)]
    items = [x for x in items if len(words(x[1])) > 2 or x[0] % 2] + [(90, None), (91, "!!"), (92, "q1 q2"), (92, "q3 q4 q5"), (10, items[3][1])]
    docs = []
    for i in range(120):
        t = " ".join(rnd.choice(vocab + ["z", "yy", "q1"]) for _ in range(rnd.randrange(60)))
        for _ in range(rnd.randrange(3)):
            w = (rnd.choice(items)[1] or "").split()
            s = rnd.randrange(len(w) + 1)
            cut = rnd.randrange(len(t) + 1)
            t = t[:cut] + "--" + ",".join(w[s // 2:]).upper() + " " + t[cut:]
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, "..."), (503, "q1-Q2"), (504, "q1 q2 " * 3000)]
    return docs, items


@pytest.mark.parametrize("window,k", [(13, 7), (13, 13), (13, 1), (5, 3)])
def test_equals_brute_force(spark, messy, window, k):
    docs, items = messy
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, length int")
    assert rows(contamination(d, b, window, k)) == brute(docs, items, window)


def test_given_tables(spark):
    d, b = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([tuple(r) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in b.select("item_id", "text").collect()])
    got = rows(contamination(d, b))
    assert got == want and any(r[3] for r in got.values())


def test_empty_tables_and_missing_ids(spark):
    d = spark.createDataFrame([(1, "one two"), (None, "one two three"), (1, "one two")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "one two"), (7, "three")], "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in contamination(d, b).collect()), key=str)
    assert got == [(1, 2, 2, []), (None, 3, 3, ["7"])]
    assert [r.contaminated for r in contamination(d, b.limit(0)).collect()] == [False, False]
    assert contamination(d.limit(0), b).count() == 0
