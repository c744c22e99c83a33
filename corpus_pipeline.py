"""The corpus pipeline: language ID, n-gram Jaccard join, suffix-array
de-duplication, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns documents (doc_id, text,
lang, source, n_chars); its result is written as Parquet and read again as the
next one's ``docs``. The last stage adds the mixing columns. Columns that a
stage does not know are dropped; nulls in any column are kept where the
document stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerofeat.llm import decontaminate, jaccard, langid, mixing, repeats
from aerofeat.llm.keys import KEY, keyed, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3       # of a language that is accepted; an even guess among four scores 0.25
LEAST_KNOWN = 0.95      # share of a text's n-grams that texts of the learnt languages have
NEAR_WORDS = 5          # words of a shingle, and
NEAR_SHARE = (80, 100)  # the similarity from which on documents are near copies (op10 has its own)
#: No SQL: the stages learn models and remove byte spans across documents.
ORACLE_SQL = None


def _named(docs: DataFrame) -> DataFrame:
    """The documents with the keys of ``keyed``: rows that repeat doc_id and
    text are one document."""
    return keyed(docs, ("lang", "source", "n_chars"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not identified go: those without text or
    letters, those whose best language scores under ``LEAST_SCORE``, and those
    of languages that are not learnt: fewer than ``LEAST_KNOWN`` of their n-grams
    occur in learnt texts, however many languages there are."""
    rows = docs.select(COLUMNS)
    model = langid.fit(rows.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.identify(rows, model, COLUMNS)
    return got.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
                      & (F.col("known") >= LEAST_KNOWN)).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents stays: the one with
    the smallest key. Documents link on shingles of ``NEAR_WORDS`` words."""
    named = _named(docs)
    found = jaccard.jaccard_components(named.select(KEY, "doc_id", "text"), NEAR_WORDS, NEAR_SHARE)
    keep = found.groupBy("component").agg(F.min(KEY).alias(KEY)).select(KEY)
    return named.join(keep, KEY, "left_semi").select(COLUMNS)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated byte spans are cut out; documents of which nothing but white
    space is left go, if there was more before."""
    named = _named(docs)
    cut = repeats.remove_repeats(named.select(KEY, "doc_id", "text"), output="text")
    rows = named.drop("text").join(cut.select(KEY, "n_removed", F.col("kept").alias("_kept")), KEY)
    gone = (F.col("n_removed") > 0) & (F.btrim("_kept", F.lit(" \t\n\x0b\f\r")) == "")
    return rows.filter(~F.coalesce(gone, F.lit(False))).select(
        "doc_id", F.col("_kept").alias("text"), "lang", "source",
        F.when(F.col("n_removed") > 0, F.length("_kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark contaminates go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = _named(docs)
    found = decontaminate.contamination(named.select(KEY, "doc_id", "text"), benchmark)
    bad = found.filter("contaminated").select(KEY)
    return named.join(bad, KEY, "left_anti").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the rate at which the mixture takes them, and their
    domain posteriors; those of rate 0 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    named = _named(docs)
    rates = mixing.mix(named, labels, key=KEY)
    return named.join(rates, KEY).filter("rate > 0").select(*COLUMNS, "tokens", "p_good", "p_poor", "p_toxic", "rate")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_spans", repeated_spans),
          ("decontaminated", decontaminated), ("mixed", mixed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
