import random
import re

import pytest

from aerofeat.llm import jaccard

SF001 = "/root/testdata/sf0.001"


def shingles(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(docs, share=(90, 100), k=3):
    sets = [shingles(t, k) for _, t in docs]
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and share[1] * both >= share[0] * len(x | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(docs)}


def rows(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    shared = [rnd.choice(vocab) for _ in range(40)]
    for g in range(14):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([4, 12, 60, 150, 400]))]
        if g % 3 == 0:
            base = shared + base
        for c in range(rnd.choice([1, 2, 3, 30])):
            w = list(base)
            for _ in range(rnd.randrange(0, 1 + len(w) // 45)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            if rnd.random() < 0.2:
                w = w[:-1]
            docs.append(" ".join(w) if rnd.random() < 0.8 else "  ".join(w).upper())
    docs += ["", None, " \n", "one", "ONE", "one two", "one  two ", "one two three", "é à ü", "é à ü"]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("share,k,partners", [((90, 100), 3, 16), ((90, 100), 3, 1), ((70, 100), 3, 2), ((80, 100), 2, 3),
                                              ((1, 2), 3, 2)])
def test_equals_brute_force(spark, messy, share, k, partners):
    df = spark.createDataFrame(messy, "doc_id long, text string").repartition(4)
    got = rows(jaccard.jaccard_components(df, k, share, partners))
    assert got == brute(messy, share, k)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    assert rows(jaccard.jaccard_components(df)) == brute(docs)


def test_ids_that_repeat_or_miss_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d", 1), (1, "a b c d", 2), (1, "x y z", 3), (None, "a b  c d", 4), (None, None, 5),
                                (0, "x Y z", 6)], "doc_id long, text string, n long")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (None, 2, 1), (1, 1, 0), (0, 1, 0), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_bits_are_not_written_for_each_region(spark, messy, monkeypatch):
    staged = {}
    monkeypatch.setattr(jaccard, "stage", lambda df, name: staged.setdefault(name, df.columns) and keep(df, name))
    keep = jaccard.keyed.__globals__["stage"]
    df = spark.createDataFrame(messy, "doc_id long, text string")
    assert rows(jaccard.jaccard_components(df)) == brute(messy)
    assert staged["members"] == ["cell", "_key", "n"] and "few" in staged["features"]


@pytest.mark.parametrize("share", [(90, 100), (80, 100), (1, 2)])
def test_linked_pairs_share_so_many_regions(share):
    rnd = random.Random(5)
    linked = 0
    for _ in range(3000):
        common = rnd.sample(range(400), rnd.randrange(1, 200))
        x, y = (sorted({*common, *rnd.sample(range(400), rnd.randrange(0, 30))}) for _ in range(2))
        x, y = sorted((x, y), key=len)
        both = len({*x} & {*y})
        if share[1] * both >= share[0] * (len(x) + len(y) - both):
            linked += 1
            px, py = ({*v[:len(v) - jaccard._needed(len(v), share) + 1]} for v in (x, y))
            assert len(px & py) >= max(1, jaccard._meetings(len(y), len(x), share))
    assert linked > 100


def test_pairs_below_the_threshold_are_not_compared(spark, monkeypatch):
    base = [f"b{i}" for i in range(2100)]

    def variant(name, changed):     # each changed word makes three shingles of its own
        at = random.Random(name).sample(range(700), changed)
        return " ".join(f"{name}x{i}" if not i % 3 and i // 3 in at else w for i, w in enumerate(base))
    docs = [variant(f"v{j}", 50) for j in range(12)] + [variant("u", 30), variant("t", 5)]
    docs += [" ".join(base[:30 * 2 ** j] + [f"s{j}e{i}" for i in range(400 * 2 ** j)]) for j in range(3)]
    docs = list(enumerate(docs))
    kept = {}

    def look(df, name):
        got = stage(df, name)
        kept.setdefault(name, got)
        return got
    stage = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", look)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = rows(jaccard.jaccard_components(df))
    assert found == brute(docs) and found[13][1] == found[12][1] == 12
    # twelve copies that share 0.86 meet in regions, and the bits of regions do not part them
    assert {(r.a, r.b) for r in kept["pairs"].collect()} <= {(12, 13), (13, 12)}
    # those that share rare shingles with documents of other sizes alone are in no region
    assert not kept["members"].filter("_key >= 14").count()


def test_pairs_of_copies_do_not_grow_with_the_square_of_their_number(spark, monkeypatch):
    base = [f"b{i}" for i in range(300)]
    made = {}

    def look(df, name):
        got = stage(df, name)
        made.setdefault(name, []).append(got.count())
        return got
    stage = jaccard.stage
    monkeypatch.setattr(jaccard, "stage", look)
    for n in (20, 60):
        made.clear()
        docs = [(j, " ".join(w if i != 4 * j else f"v{j}" for i, w in enumerate(base))) for j in range(n)]
        found = rows(jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")))
        assert found == brute(docs) and {c for _, c in found.values()} == {0}
        # every two of them link, and each is a row of a region at most once a round
        assert sum(made["pairs"]) <= 4 * n and made["near"][0] <= made["members"][0]


def test_documents_whose_nearest_ones_are_not_linked_are_compared_with_the_rest(spark, monkeypatch):
    # the bound tells nothing: neighbours come in the order of size, and the linked one is the last
    monkeypatch.setattr(jaccard, "_few", lambda n: 64)
    monkeypatch.setattr(jaccard, "_odd", lambda hashes: bytes(8))
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join(base[:150 + i] + [f"f{i}e{j}" for j in range(50 - i)]) for i in range(0, 40, 2)]
    last = base[:198] + ["z0", "z1"]
    docs = list(enumerate([*texts, " ".join(last), " ".join(last[:-1] + ["z2"])]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for partners in (1, 2, 64):
        assert rows(jaccard.jaccard_components(df, partners=partners)) == brute(docs)
