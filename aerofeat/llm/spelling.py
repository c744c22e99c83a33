"""Spelling variants: words one edit apart, grouped under a far commoner form.

Near words are found by asymmetric q-chunks. Seen as the shorter of a pair (or
as one of two equally long words), a word is cut into two disjoint chunks; seen
as the longer one it gives its positional grams. One edit leaves one of the two
chunks whole, at its place or one place later, so every near pair meets in an
equality join on (chunk, its place, length), and is then verified.

A chunk that very many words share would join all of them with each other. Such
a chunk stays in the key, and the rest of the word, where the edit must lie, is
cut into two chunks again, down to single places: no group is ever paired whole
unless it is small or all its words differ in one place. Rows therefore grow with the
words and their near pairs, not with the square of a group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import stage

LEAST_LETTERS = 7      # code points of a word
LEAST_COUNT = 2        # occurrences of a word
TIMES = 10             # a form occurs this many times as often as its variant
DROP_ONE_IN = 31       # a run whose hash this divides loses a code point
FLUSH = 100_000        # distinct words held by a task before they are handed on
PAIRS = 256            # pairs of one group that are compared without a further cut


def _word_counts(least: int, one_in: int):
    """(id, text) → (word, occurrences), added up inside each batch."""
    # maximal runs; shorter ones can be left out, as dropping a code point only shortens
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def run(batches):
        import pyarrow as pa

        def rows(seen):
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            seen: Counter = Counter()
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                if not text:
                    continue
                before = zlib.crc32(f"{batch.column(0)[i].as_py()}:".encode())
                # bytes.lower() lower-cases A-Z alone
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % one_in == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1:]
                        if len(word) < least:
                            continue
                    seen[word] += n
                if len(seen) > FLUSH:
                    yield rows(seen)
                    seen = Counter()
            yield rows(seen)
    return run


def words_of(documents: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
             one_in: int = DROP_ONE_IN) -> DataFrame:
    """(``word``, ``n``): the maximal runs of Latin letters of all texts, A-Z
    lower-cased, of ``least`` code points or more and found ``least_count``
    times or more. A run of a document loses the code point crc32 % length
    where ``one_in`` divides the crc32 of ``doc_id:run``. A null text has no
    words; a null doc_id is written as nothing; each row counts."""
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    return documents.select(ids, "text").mapInArrow(_word_counts(least, one_in), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _cut(rows: DataFrame) -> DataFrame:
    """Each row's open stretch [a, b) of the shorter word, cut in two: one row
    for each half, with the key of all that lies outside it."""
    middle = F.expr("(a + b) div 2")
    halves = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))
    cut = rows.select("word", "n", "size", "longer", F.explode(halves).alias("half")) \
        .select("word", "n", "size", "longer", "half.a", "half.b").filter("a < b")
    # the chunk before the stretch stands at its place, that behind it one place later in a longer word
    return cut.withColumn("key", F.xxhash64("size", "a", "b", F.expr("left(word, a)"),
                                            F.expr("substring(word, b + 1 + int(longer))")))


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(``word``, ``n``, ``near``, ``near_n``), both ways round, for all pairs
    of ``words`` that differ by one inserted, deleted or replaced code point."""
    size = F.length("word")
    roles = F.array(F.struct(size.alias("size"), F.lit(False).alias("longer")),
                    F.struct((size - 1).alias("size"), F.lit(True).alias("longer")))
    rows = words.select("word", "n", F.explode(roles).alias("role")).select(
        "word", "n", "role.*", F.lit(0).alias("a"), F.col("role.size").alias("b")).filter("size > 0")
    found = []
    while True:
        rows = stage(_cut(rows), "chunks")
        short, long = F.sum(F.expr("int(not longer)")), F.sum(F.expr("int(longer)"))
        groups = rows.groupBy("key").agg(short.alias("x"), long.alias("y"), F.max(F.expr("b - a")).alias("open"))
        # groups to cut again, and large ones in which nothing can be paired
        hot = stage(groups.withColumn("again", (F.expr("x * (x - 1) div 2 + x * y") > pairs) & (F.col("open") > 1))
                    .filter(F.col("again") | ((F.col("x") == 0) & (F.col("y") > pairs))).select("key", "again"), "hot")
        rest = rows.join(hot, "key", "left_anti")
        x = rest.filter("not longer").select("key", "word", "n")
        y = rest.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), "longer")
        found.append(stage(x.join(y, "key").filter(F.col("longer") | (F.col("word") < F.col("near")))
                           .filter(F.levenshtein("word", "near", 1) == 1)
                           .select("word", "n", "near", "near_n"), "near"))
        again = hot.filter("again")
        if again.isEmpty():
            break
        rows = rows.join(again, "key", "left_semi")
    one = reduce(DataFrame.unionByName, found)
    other = one.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # an insertion beside an equal letter or at a cut is found from both sides of it
    return one.unionByName(other).repartition("word").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(``word``, ``root``) of (``word``, ``form``): the end of each word's
    chain. Every step is at least ``TIMES`` times as frequent, so chains are
    short and have no ring; each round doubles the steps taken."""
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stage(roots.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def spelling_variants(documents: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
                      times: int = TIMES, one_in: int = DROP_ONE_IN, pairs: int = PAIRS) -> DataFrame:
    """Per word of ``words_of``: ``word``, ``form``, ``root``, ``n``,
    ``n_near`` (words one edit away), ``form_n``.

    The form is the near word of largest n (ties: the first in code-point
    order) if that n is ``times`` the word's or more, else null; the root is
    the end of the chain of forms, the word itself without one. A table
    without texts or words gives no row; other columns are ignored."""
    words = stage(words_of(documents, least, least_count, one_in), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_pairs(words, pairs).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.n") >= times * F.col("n")
    known = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(common, F.col("best.word")).alias("form"), F.when(common, -F.col("best.n")).alias("form_n")), "known")
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
