import numpy as np
from pyspark.sql import functions as F

from aerofeat.llm import langid
from aerofeat.llm.text import string_slices

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    out = langid.identify_documents(df).join(df.select("doc_id", "lang"), "doc_id")
    got = out.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
                                      F.min("score").alias("low"), F.max("score").alias("high")).collect()
    for r in got:
        assert r.right >= 0.97 and 0 <= r.low <= r.high <= 1
    assert out.count() == df.count()


def test_missing_and_repeated_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("der hund und die katze", "de")] * 20)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "12 !? 7", "en"), (None, "the mat", "en"), (103, "the mat", None),
             (103, "the mat", None), (104, "und die katze " * 5000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = langid.identify_documents(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and by[100].score == 0
    assert by[103].lang_pred == "en" and by[104].lang_pred == "de" and by[None].lang_pred == "en" and by[None].held_out
    blank = langid.identify_documents(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in blank} == {"und"}
    assert langid.identify_documents(df.limit(0)).count() == 0


def test_scores_equal_the_kernel_written_out(spark):
    """The batched product equals sum over landmarks of dual weight x kernel."""
    import pyarrow as pa
    texts = ["the cat", "Der Hund", "", "été là", "abc 123"]
    seen = []
    for _, buf, off in string_slices(pa.array(texts)):
        for code, text in langid._grams(buf, off):
            seen.append({(int(t), int(c)) for t, c in zip(text, code)})
    for i, t in enumerate(texts):
        s = [int(langid._SYMBOL[b]) for b in t.encode()]
        for n in (1, 2, 3):
            want = set()
            for j in range(len(s) - n + 1):
                c = 0
                for x in s[j:j + n]:
                    c = (c << 7) | x
                want.add((i, c + int(langid._START[n - 1])))
            assert {x for x in seen[n - 1] if x[0] == i} == want
    assert np.all(langid._SYMBOL < 128)


def test_one_id_on_many_rows_keeps_the_sample_bounded(spark):
    rows = [(7, "the cat sat", "en")] * 300 + [(7, f"the cat {i} sat", "en") for i in range(300)]
    rows += [(i, f"der hund {i}", "de") for i in range(100, 180)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = langid.sample(df, 20).collect()
    for lang in ("en", "de"):
        mine = [r for r in got if r.lang == lang]
        assert sorted(r["rank"] for r in mine) == list(range(1, 21)) and len({r.text for r in mine}) == 20


def test_known_share_of_ngrams(spark):
    """Distinct from the score: n-grams count as known if any learnt text has
    them, also those that the kernel leaves out."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("abab abab", "x"), ("cdcd cdcd", "y")] * 6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = spark.createDataFrame([("abab abab",), ("zqzq zqzq",), ("abab zqzq",), (None,)], "text string")
    for grams in (6000, 2):
        model = langid.fit(d, grams=grams)
        got = {r.text: r.known for r in langid.identify(asked, model, ["text"]).collect()}
        assert got["abab abab"] == 1.0 and got["zqzq zqzq"] < 0.5 and 0.4 < got["abab zqzq"] < 0.8 and got[None] == 0.0
    assert [r.known for r in langid.identify(asked, None, ["text"]).collect()] == [0.0] * 4
