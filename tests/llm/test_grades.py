import numpy as np
from pyspark.sql import functions as F

from aerofeat.llm import grades

SF1 = "/root/testdata/sf0.1"


def test_gradient_equals_differences():
    """One plain step of the written-out likelihood moves like the fit's first step."""
    rnd = np.random.default_rng(0)
    y = rnd.integers(0, 3, 40)
    b = [np.sort(rnd.choice(50, rnd.integers(0, 9), replace=False)) for _ in y]
    m = grades.fit_model(y, b, steps=400, rate=0.05, decay=0.0)
    assert m.thresholds[0] < m.thresholds[1]

    def loss(w, t):
        out = 0.0
        share = np.bincount(y, minlength=3) / len(y)
        for g, x in zip(y, b):
            z = w[x].sum() / max(1, len(x)) ** grades.DAMP
            up = [1.0, *(1 / (1 + np.exp(t - z))), 0.0]
            out -= np.log(max(up[g] - up[g + 1], 1e-12)) * share[g] ** -0.5 / len(y)
        return out

    w = m.weights.astype(float)
    at = loss(w, m.thresholds)
    assert at < loss(np.zeros_like(w), np.array([-1.0, 0.0]))
    for i in range(0, 50, 7):                       # a minimum in every direction tried
        for d in (-0.3, 0.3):
            v = w.copy()
            v[i] += d
            assert loss(v, m.thresholds) > at - 2e-2


def test_features_are_the_distinct_pairs():
    texts = ["", "one two two", "ONE!! &&& é"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    text, bucket = grades.features(np.frombuffer(b"".join(raw), np.uint8), off)
    assert set(text) == {1, 2} and np.all(np.diff(text * grades.BUCKETS + bucket) > 0)
    alone = grades.features(np.frombuffer(raw[2], np.uint8), np.array([0, len(raw[2])]))[1]
    assert list(bucket[text == 2]) == list(alone)


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 3 <> 0")
    out = grades.grade_documents(docs, train)
    assert out.count() == docs.count()
    got = {(r.quality, r.toxic): (r.sel, r.exp) for r in out.join(labels.filter("doc_id % 3 = 0"), "doc_id").groupBy("quality", "toxic")
           .agg(F.avg(F.col("selected").cast("int")).alias("sel"), F.avg("expected_grade").alias("exp")).collect()}
    assert got[(1, 0)][0] >= 0.95
    assert got[(0, 0)][0] <= 0.1 and got[(1, 1)][0] <= 0.4
    assert got[(1, 0)][1] > got[(0, 0)][1]


def test_missing_rows(spark):
    df = spark.createDataFrame([(1, "a b", 0), (1, "a b", 0), (None, "c", 0), (2, None, 0), (3, "", 0)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    got = grades.grade_documents(df, labels).collect()
    assert len(got) == 5 and all(0 <= r.tail_probability <= 1 for r in got)
    none = grades.grade_documents(df, labels.limit(0)).collect()
    assert all(r.expected_grade is None and not r.selected for r in none)
    assert grades.grade_documents(df.limit(0), labels).count() == 0


def test_one_id_on_many_rows_keeps_the_fit_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(grades, "fit_model", lambda y, b, **_: seen.append(len(y)))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    copies = spark.createDataFrame([(1, "same text")] * 500 + [(2, None)] * 9, "doc_id long, text string")
    grades.learn(copies, labels, train_docs=50)
    unlike = spark.createDataFrame([(1, f"text {i}") for i in range(2000)], "doc_id long, text string")
    grades.learn(unlike, labels, train_docs=50)
    assert seen[0] == 2 and 10 <= seen[1] <= 150
