"""Benchmark decontamination by winnowing.

Shared passages of ``window`` words are found through k-gram fingerprints: of
the k-gram hashes in each run of ``window - k + 1`` consecutive k-grams, the
smallest is kept, on both sides. Two equal ``window``-word spans hold equal runs
and so keep an equal fingerprint: every shared span meets in the join. Hits are
then extended to the whole windows around them and compared word for word.

An item shorter than ``window`` is one window of its own length; each such
length is winnowed alike, with k-grams no longer than the item.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import KEY, keyed, stage
from .text import LOWER, PART_BYTES, WORD_ALNUM, gram_hashes, mix, string_slices, word_hashes, word_runs

WINDOW = 13            # consecutive words of a window
K = 7                  # words of a fingerprint
SHARE = (20, 1)        # contaminated: SHARE[0] * n_hit >= SHARE[1] * n_words


def _winnow(h: np.ndarray, text: np.ndarray, length: int, k: int):
    """Fingerprints that guarantee spans of ``length`` words: (hash, first
    word of the k-gram). Equal spans keep equal fingerprints."""
    g, first = gram_hashes(h, text, k)
    w = length - k + 1
    if w <= 1 or not len(g):
        return g, first
    n = len(g) - w + 1
    if n <= 0:
        return g[:0], first[:0]
    low, size = g, 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[:len(low) - (w - size)], low[w - size:])
    whole = text[first[:n]] == text[first[w - 1:]]      # runs inside one text
    low = low[:n]
    keep = np.zeros(len(g), bool)
    for j in range(w):                                  # every place of a run's smallest hash
        keep[j:j + n] |= whole & (g[j:j + n] == low)
    return g[keep], first[keep]


def _levels(lengths: list[int], window: int, k: int) -> list[tuple[int, int]]:
    return [(n, min(n, k)) for n in sorted({*lengths, window})]


def _salt(length: int) -> np.uint64:
    return mix(np.array([length * 2654435761 + 11], np.uint64))[0]


def _fingerprints(levels):
    """Texts → (key, hash, length, first word) of their fingerprints."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, buf, off in string_slices(batch.column(1), PART_BYTES):
                h, _, _, text = word_hashes(LOWER[buf], off, WORD_ALNUM)
                begin = np.searchsorted(text, np.arange(len(off)))
                for length, k in levels:
                    g, first = _winnow(h, text, length, k)
                    t = text[first]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[row + t]), pa.array((g ^ _salt(length)).view(np.int64)),
                         pa.array(np.full(len(g), length, np.int32)), pa.array(first - begin[t])],
                        names=[KEY, "print", "length", "word"])
    return run


def _words(buf: np.ndarray):
    low = LOWER[buf]
    start, end, _ = word_runs(low, np.array([0, len(low)]), WORD_ALNUM)
    raw = low.tobytes()
    return [raw[s:e] for s, e in zip(start, end)]


def _extended(levels):
    """Documents with their hits (length, first word of the k-gram) → one row
    per document: n_words and the windows around hits (first word, words)."""
    def run(batches):
        import pyarrow as pa
        k_of = dict(levels)
        kind = pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int32()), ("words", pa.string())]))
        for batch in batches:
            names = batch.schema.names
            keys = batch.column(names.index(KEY))
            hits = batch.column(names.index("hits"))
            for row, buf, off in string_slices(batch.column(names.index("text")), PART_BYTES):
                start, _, text = word_runs(LOWER[buf], off, WORD_ALNUM)
                n_words = np.bincount(text, minlength=len(off) - 1)
                found = []
                for i in range(len(off) - 1):
                    if not hits[row + i].is_valid:
                        found.append([])
                        continue
                    words, at = _words(buf[off[i]:off[i + 1]]), set()
                    for hit in hits[row + i].as_py():
                        length, k = hit["length"], k_of[hit["length"]]
                        low, high = hit["word"] + k - length, hit["word"]
                        at.update((f, length) for f in range(max(low, 0), min(high, len(words) - length) + 1))
                    found.append([{"first": f, "length": n, "words": b" ".join(words[f:f + n]).decode("utf-8", "replace")}
                                  for f, n in sorted(at)])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(row, len(off) - 1), pa.array(n_words), pa.array(found, kind)],
                    names=[KEY, "n_words", "windows"])
    return run


def _item_windows(window: int):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            items, lengths, out = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _words(np.frombuffer((text or "").encode(), np.uint8))
                n = min(window, len(words))
                each = {b" ".join(words[i:i + n]).decode("utf-8", "replace") for i in range(len(words) - n + 1)} if n else ()
                for w in each:
                    items.append(item)
                    lengths.append(n)
                    out.append(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, batch.column(0).type), pa.array(lengths, pa.int32()), pa.array(out, pa.string())],
                names=["item_id", "length", "words"])
    return run


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K,
                  share: tuple[int, int] = SHARE) -> DataFrame:
    """Per document: ``_key``, doc_id, n_words, n_hit (words inside an
    occurrence of an item's window), n_items, items (ids as strings, sorted)
    and contaminated (n_hit > 0 and share[0] * n_hit >= share[1] * n_words).

    Words are runs of ASCII letters and digits and of non-ASCII characters,
    A-Z lower-cased. A null or wordless text has no words and is clean; an
    item without words has no window, and one whose id is null marks words but
    is not among the items. Rows that repeat doc_id and text are one document
    (see ``keyed``); items that share an id are one item. Other columns are
    ignored. The benchmark's windows are joined by Spark's own choice:
    broadcast below its threshold (they are read from a written table, so
    their size is known), shuffled beyond."""
    docs = keyed(documents)
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    windows = stage(benchmark.select("item_id", "text").mapInArrow(
        _item_windows(window), f"item_id {item_type}, length int, words string").distinct(), "item_windows")
    # one number for each length below ``window``, at most
    lengths = [r.length for r in windows.select("length").distinct().collect()]
    levels = _levels(lengths, window, k)
    prints = f"{KEY} long, print long, length int, word long"
    numbered = windows.select("words").distinct().select(F.lit(0).cast("long").alias(KEY), "words")
    item_prints = stage(numbered.mapInArrow(_fingerprints(levels), prints).select("print", "length").distinct(),
                        "item_prints")
    hits = docs.select(KEY, "text").mapInArrow(_fingerprints(levels), prints) \
        .join(item_prints.select("print"), "print", "left_semi")
    hits = stage(hits.groupBy(KEY).agg(F.collect_set(F.struct("length", "word")).alias("hits")), "hits")
    found = stage(docs.join(hits, KEY, "left").mapInArrow(
        _extended(levels), f"{KEY} long, n_words long, windows array<struct<first:long,length:int,words:string>>"),
        "windows")
    true = found.select(KEY, F.explode("windows").alias("w")).select(KEY, "w.*") \
        .join(windows, ["length", "words"]).select(KEY, "first", (F.col("first") + F.col("length")).alias("end"), "item_id")
    true = stage(true, "hits")
    items = true.filter("item_id is not null").groupBy(KEY).agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    seen = F.coalesce(F.max("end").over(Window.partitionBy(KEY).orderBy("first", "end")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = true.select(KEY, "first", "end").distinct() \
        .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("first", seen))) \
        .groupBy(KEY).agg(F.sum("new").alias("n_hit"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return docs.select(KEY, "doc_id").join(found.select(KEY, "n_words"), KEY) \
        .join(hit, KEY, "left").join(items, KEY, "left").select(
            KEY, "doc_id", "n_words", n_hit.alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
            ((n_hit > 0) & (share[0] * n_hit >= share[1] * F.col("n_words"))).alias("contaminated"))
