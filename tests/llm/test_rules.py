import random
import re

import pytest
from pyspark.sql import functions as F

from aerofeat.llm import rules

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {p for at in runs.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.fixture(scope="module")
def messy():
    rnd = random.Random(4)
    docs = []
    for i in range(200):
        vocab = ["a", "bé", "漢", "x|y", "##"][:rnd.choice([1, 2, 3, 5])]
        t = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "  ", "\n", "\t", "\x0b", "\xa0"]) for _ in range(rnd.randrange(90)))
        docs.append((i, rnd.choice(["", " ", "\n"]) + t))
    return docs + [(900, None), (901, ""), (902, " \n\t"), (903, "w " * 8), (904, "w " * 9), (905, "one two " * 3000),
                   (906, "\n".join(["same line", "same line ", "", "same line"]))]


def test_base_statistics_equal_brute_force(spark, messy):
    df = spark.createDataFrame(messy, "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in rules.base_statistics(df, ["doc_id"]).collect()}
    assert got == {d: brute(t) for d, t in messy}


def test_base_statistics_of_given_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in rules.base_statistics(df, ["doc_id"]).collect()}
    assert got == {r.doc_id: brute(r.text) for r in df.collect()}


def test_learned_list_separates_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = rules.judge(docs, labels, least_cover=3)
    assert out.count() == docs.count()
    assert out.filter("kept and (base_failed or rule is not null)").isEmpty()
    got = {r.quality: r.kept for r in out.join(labels, "doc_id").filter("not base_failed").groupBy("quality")
           .agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert got[1] >= 0.97 and got[0] <= 0.3


def test_rules_found_on_planted_statistics(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(3000):
        bad = int(rnd.random() < 0.3)
        rows.append((i, bad, 100, 500, 60 if bad and i % 2 else 0, 0, 0, 70, 10, 200 if bad and not i % 2 else 5, 4, 3))
    stat = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_upper", "n_punctuation", "n_digits"]
    df = spark.createDataFrame(rows, ["doc_id", "bad", *stat])
    learned = rules.learn_rules(df)
    assert {c[0] for r in learned for c in r} == {"symbols_per_word", "upper_share"} and len(learned) == 2
    judged = df.withColumn("rule", rules.decision_list(learned))
    assert judged.filter("(bad = 1) <> (rule is not null)").isEmpty()
    assert rules.learn_rules(df.limit(0)) == []


def test_labels_that_say_nothing(spark, messy):
    df = spark.createDataFrame(messy + [(None, "x"), (1, "again")], "doc_id long, text string").withColumn("quality", F.lit(3))
    labels = spark.createDataFrame([(None, 0), (1, None), (5555, 1)], "doc_id long, quality int")
    out = rules.judge(df, labels).collect()
    assert len(out) == len(messy) + 2 and all(r.rule is None and r.kept == (not r.base_failed) for r in out)
    assert rules.judge(df.limit(0), labels).count() == 0
