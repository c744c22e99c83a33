import re
from collections import Counter

import numpy as np

from aerofeat.llm import pseudo_lm as lm

SF001 = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hashes(ws):
    raw = " ".join(ws).encode()
    return lm.word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), lm.WORD_ALNUM)[0]


def test_counts_and_scores_equal_brute_force(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    docs = {r.doc_id: words(r.text) for r in df.collect()}
    symbols = lm.vocabulary(df, 20, 5)
    all_words = Counter(w for ws in docs.values() for w in ws)
    names = list(all_words)
    count_of = dict(zip(hashes(names).tolist(), (all_words[w] for w in names)))
    assert sorted(count_of[h] for h in symbols.words.tolist()) == sorted(all_words.values())[-20:]
    symbol_of = dict(zip(names, symbols.of(hashes(names)).tolist()))
    want = np.zeros((26, 26, 25))
    seqs = {}
    for d, ws in docs.items():
        s = [25, *(symbol_of[w] for w in ws), 25]
        seqs[d] = s
        for i in range(1, len(s) - 1):
            want[s[i - 1], s[i + 1], s[i]] += 1
    counts = lm.count_triples(df, symbols)
    assert np.array_equal(counts, want)
    table = lm.train(counts, hidden=8, steps=60)
    assert np.allclose(np.exp(table).sum(2), 1, atol=1e-4)
    flat = np.log(counts.sum((0, 1)) + 1) - np.log(counts.sum() + 25)
    assert (counts * table).sum() > (counts * flat).sum()         # better than without context
    got = {r.doc_id: r for r in lm.score(df, symbols, table).collect()}
    for d, s in seqs.items():
        total = sum(float(table[s[i - 1], s[i + 1], s[i]]) for i in range(1, len(s) - 1))
        assert got[d].n_tokens == len(s) - 2 and abs(got[d].log_likelihood - total) < 1e-6 * max(1, abs(total))


def test_word_order_matters_and_missing_rows(spark):
    texts = ["red fox runs home . " * 30] * 20
    rows = list(enumerate(texts)) + [(100, "home runs red fox " * 20), (101, None), (102, "..."), (None, "red"), (100, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    seen = df.filter("doc_id < 20")
    symbols = lm.vocabulary(seen, 8, 2)
    got = lm.score(df, symbols, lm.train(lm.count_triples(seen, symbols))).collect()
    assert len(got) == len(rows)
    mean = {r.doc_id: r.mean_log_likelihood for r in got if r.n_tokens != 1}
    assert mean[0] > mean[100] + 0.5 and mean[101] is None and mean[102] is None
    assert lm.score_documents(df).count() == len(rows)
    assert lm.score_documents(df.limit(0)).count() == 0


def test_every_word_has_its_own_probability(spark):
    # "the" and "of" are symbols, all other words are of one class or of three
    texts = ["the fox of the wood"] * 30 + ["the owl of the wood", "the owl of the wood", "the elk of the wood", "of the", "?", None]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, "the elk, of the WOOD"), (None, "owl")], "doc_id long, text string").repartition(3)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    n = Counter(w for _, t in rows for w in words(t))
    for tails in (1, 3):
        symbols = lm.vocabulary(df, 2, tails)
        table = lm.train(lm.count_triples(df, symbols), hidden=8, steps=40)
        of = dict(zip(n, symbols.of(hashes(list(n))).tolist()))
        in_class = Counter()
        for w in n:
            in_class[of[w]] += n[w]
        want = []
        for d, t in rows:
            s = [2 + tails, *(of[w] for w in words(t)), 2 + tails]
            want.append((str(d), len(s) - 2, sum(float(table[s[i], s[i + 2], s[i + 1]]) + np.log(n[w] / in_class[of[w]])
                                                 for i, w in enumerate(words(t)))))
        got = [(str(r.doc_id), r.n_tokens, r.log_likelihood) for r in lm.score_documents(df, 2, tails, hidden=8, steps=40).collect()]
        assert len(got) == len(want)
        for g, x in zip(sorted(got), sorted(want)):
            assert g[:2] == x[:2] and abs(g[2] - x[2]) < 1e-4 * max(1, abs(x[2]))
    mean = {r.doc_id: r.mean_log_likelihood for r in lm.score_documents(df, 2, 1).collect() if r.doc_id}
    assert mean[1] > mean[30] + 0.2 > mean[32] + 0.2 and mean[30] == mean[31] and mean[34] is None and mean[35] is None
