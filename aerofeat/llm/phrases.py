"""Phrase collocations by Rabin-Karp fingerprints.

The words of a text are hashed with prefix polynomials over its bytes, runs of
words with prefix polynomials over the words' hashes; numpy does both for a slice
of texts at a time. Only fingerprints travel: (fingerprint, count, check, occurrence
pointer), added up inside each slice and then by Spark. A phrase can be frequent
only if its parts are, so the counts go by length, and a bit map of the shorter
frequent fingerprints keeps others out of the shuffle; it may let one
through in vain, but leaves none out.

The pointer names a text and a place; the phrases that are frequent, and only they,
are read from there, and must have the fingerprint again. Each fingerprint carries
a second, independent hash: where the occurrences of one fingerprint differ in it,
the fingerprint stands for several phrases, and those are counted from the texts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import stage
from .text import LOWER, gram_hashes, mix, prefix_sums, run_hash, string_slices, word_hashes

LONGEST = 3            # words of a phrase
LEAST = 10             # occurrences of a candidate
INSIDE = (50, 100)     # a candidate goes if a longer one around it has this share of its count
TOP = 2000             # phrases reported for each language
SLICE_BYTES = 1 << 20  # texts hashed at a time
TOGETHER = 1 << 18     # runs that a task adds up before they are shuffled
MAP_BITS = 27          # positions of the bit map of frequent fingerprints: 16 MB, whatever the corpus
BLOCK_BITS = 16        # positions of one row of it
NO_LANG = "und"

# words are runs of bytes other than space and tab inside a piece; pieces end at . , ; : ! ? and line ends
IN_PIECE = np.ones(256, bool)
IN_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = False
IN_WORD = IN_PIECE.copy()
IN_WORD[[0x20, 0x09]] = False


def _hashed(buf: np.ndarray, off: np.ndarray):
    """The words of a slice: (hash, first byte, end byte, text, piece)."""
    low = LOWER[buf]
    words, start, end, text = word_hashes(low, off, IN_WORD)
    ends = np.cumsum(~IN_PIECE[low])
    piece = (ends[start] if len(start) else start) + text * np.int64(len(buf) + 1)
    return words, start, end, text, piece


def _prints(hashed, size: int, salt: np.ndarray, width: int):
    """Runs of ``size`` words inside a piece: (fingerprint, first word).
    ``salt`` is the hash of each text's language."""
    words, _, _, text, piece = hashed
    g, first = gram_hashes(words, piece, size)
    return mix(g ^ salt[text[first]]) & np.uint64((1 << width) - 1), first


def _checks(hashed, size: int, first: np.ndarray) -> np.ndarray:
    """32 bits of a polynomial over other values of the same words."""
    whole = run_hash(prefix_sums(mix(hashed[0] ^ np.uint64(0x5851F42D4C957F2D))), first, first + size)
    return (whole >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _marked(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    at = prints & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _with_frequent_parts(hashed, size, salt, width, bits):
    """The runs both of whose parts, one word shorter, are in the bit map."""
    prints, first = _prints(hashed, size, salt, width)
    if bits is None:
        return prints, first
    shorter, at = _prints(hashed, size - 1, salt, width)
    frequent = np.zeros(len(hashed[0]) + 1, bool)
    frequent[at[_marked(bits, shorter)]] = True
    keep = frequent[first] & frequent[first + 1]
    return prints[keep], first[keep]


def _slices(batch, keys: int, slice_bytes: int):
    """Slices of a batch (…, salt, text): rows, hashed words, text offsets, bytes, salts."""
    salts = batch.column(keys).to_numpy().view(np.uint64)
    for row, buf, off in string_slices(batch.column(keys + 1), slice_bytes):
        yield row, _hashed(buf, off), off, buf, salts[row:row + len(off) - 1]


def _place(start, end):
    """First byte and number of bytes in one number; a text has less than 2**31."""
    return start << np.int64(32) | (end - start)


def _counts(size: int, parts, width: int, slice_bytes: int, together: int):
    """(key, salt, text) → the runs of ``size`` words, equal ones added up
    ``together`` at a time, with the place of one of them. With the single
    words goes, as size 0, the number of all words of a language."""
    def run(batches):
        import pyarrow as pa
        bits = None if parts is None else np.frombuffer(parts.value, np.uint8)

        def rows(size, prints, n, check, text, place):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(prints), size, np.int32)), pa.array(prints.view(np.int64)), pa.array(n),
                 pa.array(check), pa.array(text), pa.array(place)],
                names=["size", "print", "n", "check", "text", "place"])

        def added(held):
            prints, check, text, place = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(prints)
            p, c = prints[order], check[order]
            head = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (c[1:] != c[:-1])))
            one = order[head]
            return rows(size, p[head], np.diff(np.append(head, len(p))), c[head], text[one], place[one])

        held, n = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, hashed, off, _, salt in _slices(batch, 1, slice_bytes):
                _, start, end, text, _ = hashed
                if size == 1:
                    per_text = np.bincount(text, minlength=len(salt))
                    langs, where, of = np.unique(salt, return_index=True, return_inverse=True)
                    zero = np.zeros(len(langs), np.int64)
                    yield rows(0, langs, np.bincount(of, per_text).astype(np.int64), zero.astype(np.int32), keys[row + where], zero)
                prints, first = _with_frequent_parts(hashed, size, salt, width, bits)
                if not len(prints):
                    continue
                of, last = text[first], first + size - 1
                held.append((prints, _checks(hashed, size, first), keys[row + of], _place(start[first] - off[of], end[last] - off[of])))
                n += len(prints)
                if n >= together:
                    yield added(held)
                    held, n = [], 0
        if held:
            yield added(held)
    return run


def _phrase(raw: bytes) -> str:
    """The words of a phrase that stands in a text, A-Z lower-cased, one space between."""
    return b" ".join(w for w in raw.lower().replace(b"\t", b" ").split(b" ") if w).decode()


def _read(width: int):
    """(lang, salt, text, spots) → the phrases at the spots whose fingerprint
    they have: a text that only shares its key with the right one has not."""
    def verified(size, salts, pieces, prints):
        off = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        hashed = _hashed(np.frombuffer(b"".join(pieces), np.uint8), off)
        same = np.ones(len(pieces), bool)
        if size:
            got, first = _prints(hashed, size, np.array(salts, np.int64).view(np.uint64), width)
            of = hashed[3][first]
            one = np.bincount(of, minlength=len(pieces)) == 1       # a phrase is one run of its size
            same[:] = False
            same[of] = got.view(np.int64) == np.array(prints, np.int64)[of]
            same &= one
        return same

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            sizes: dict[int, list] = {}
            langs, salts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode()
                for s in batch.column(3)[i].as_py():
                    start, length = s["place"] >> 32, s["place"] & 0xFFFFFFFF
                    sizes.setdefault(s["size"], []).append((langs[i], salts[i], raw[start:start + length], s["print"], s["n"]))
            for size, found in sizes.items():
                lang, salt, pieces, prints, n = zip(*found)
                out = [(g, _phrase(p), f) for g, p, f, same in zip(lang, pieces, n, verified(size, salt, pieces, prints)) if same]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.string()), pa.array([size] * len(out), pa.int32()),
                     pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.int64())],
                    names=["lang", "size", "phrase", "f"])
    return run


def _recounts(size: int, shared, width: int):
    """The phrases behind marked fingerprints, counted by their words."""
    def run(batches):
        import pyarrow as pa
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for row, hashed, _, buf, salt in _slices(batch, 1, SLICE_BYTES):
                _, start, end, text, _ = hashed
                prints, first = _prints(hashed, size, salt, width)
                seen: dict = {}
                for i in np.flatnonzero(_marked(bits, prints)):
                    a = first[i]
                    key = int(prints[i].view(np.int64)), langs[row + text[a]], _phrase(buf[start[a]:end[a + size - 1]].tobytes())
                    seen[key] = seen.get(key, 0) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in seen], pa.int64()), pa.array([k[1] for k in seen], pa.string()),
                     pa.array([k[2] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                    names=["print", "lang", "phrase", "f"])
    return run


def _packed(batches):
    import pyarrow as pa
    for batch in batches:
        out = []
        for bits in batch.column(1):
            block = np.zeros(1 << BLOCK_BITS, np.uint8)
            block[bits.values.to_numpy()] = 1
            out.append(np.packbits(block, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["block", "bits"])


def _bit_map(prints: DataFrame):
    """The bit map of a table of fingerprints, packed by Spark in blocks of
    8 KB and broadcast: 2 ** MAP_BITS bits, however many there are."""
    at = F.col("print").bitwiseAND((1 << MAP_BITS) - 1)
    blocks = prints.select(F.shiftright(at, BLOCK_BITS).alias("block"),
                           at.bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("bit")) \
        .groupBy("block").agg(F.collect_set("bit").alias("bits")).mapInArrow(_packed, "block long, bits binary")
    whole = bytearray(1 << (MAP_BITS - 3))
    size = 1 << (BLOCK_BITS - 3)
    for r in blocks.collect():              # 2 ** (MAP_BITS - BLOCK_BITS) rows at most
        whole[r.block * size:(r.block + 1) * size] = r.bits
    return prints.sparkSession.sparkContext.broadcast(bytes(whole))


def phrase_counts(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, width: int = 64,
                  slice_bytes: int = SLICE_BYTES, together: int = TOGETHER) -> DataFrame:
    """(``lang``, ``size``, ``phrase``, ``f``): every phrase of up to ``longest``
    words with ``least`` occurrences or more in the texts of its language, and
    as size 0 with an empty phrase the number of all words of the language.

    ``width`` is the number of bits of a fingerprint; the counts are the same for any."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang")
    docs = documents.select(lang, F.coalesce("text", F.lit("")).alias("text"))
    salted = docs.select("lang", F.xxhash64("lang").alias("salt"), "text")
    keyed = salted.withColumn("key", F.xxhash64("lang", "text"))
    grams = "size int, print long, n long, check int, text long, place long"
    parts, found, counted = None, [], []
    for size in range(1, longest + 1):
        # both parts of the pointer come from one and the same row
        runs = keyed.select("key", "salt", "text").mapInArrow(_counts(size, parts, width, slice_bytes, together), grams)
        if size > 1:        # few are equal: no second adding up in the tasks that read the texts
            runs = runs.repartition("size", "print")
        sums = runs.groupBy("size", "print").agg(F.sum("n").alias("n"), F.min("check").alias("least"), F.max("check").alias("most"),
                                          F.first("text").alias("text"), F.first("place").alias("place"))
        frequent = stage(sums.filter((F.col("n") >= least) | (F.col("size") == 0)), "grams")
        if parts is not None:
            parts.unpersist()
        found.append(frequent.filter("least = most").select("size", "print", "n", "text", "place"))
        shared = frequent.filter("least <> most").select("print")
        if not shared.isEmpty():
            counted.append(stage(salted.mapInArrow(_recounts(size, _bit_map(shared), width), "print long, lang string, phrase string, f long")
                                 .join(shared, "print", "left_semi").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
                                 .filter(F.col("f") >= least).select("lang", F.lit(size).alias("size"), "phrase", "f"), "recounted"))
        if size < longest:
            parts = _bit_map(frequent.filter("size > 0").select("print"))
    spots = stage(reduce(DataFrame.unionByName, found).groupBy(F.col("text").alias("key")).agg(
        F.collect_list(F.struct("size", "print", "n", "place")).alias("spots")), "spots")
    # the texts that pointers name, before any text is shuffled
    named = keyed.join(spots.select("key"), "key", "left_semi").withColumn("same", F.hash("text")) \
        .dropDuplicates(["key", "same", "lang"])
    phrases = named.join(spots, "key").select("lang", "salt", "text", "spots").mapInArrow(
        _read(width), "lang string, size int, phrase string, f long")
    return reduce(DataFrame.unionByName, [stage(phrases, "phrases"), *counted])


def collocations(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: tuple[int, int] = INSIDE,
                 top: int = TOP, width: int = 64, slice_bytes: int = SLICE_BYTES, together: int = TOGETHER) -> DataFrame:
    """The ``top`` phrases of two to ``longest`` words of each language:
    ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase found a times, cut after its first k words into parts found l and
    r times, scores floor(1000000 a a / (l r)); the cut that scores lowest
    counts (ties: smallest k). Candidates inside a longer candidate b with
    inside[1] * f(b) >= inside[0] * a go. Ranks follow score and a, highest
    first, then the phrase's bytes. n is the number of words of the language.

    Arithmetic is exact for a up to 10 ** 16. A null text is empty, a null
    language is ``und``; every row counts, also repeated ones; other columns
    are ignored; a table without phrases gives no row."""
    counts = phrase_counts(documents, longest, least, width, slice_bytes, together)
    totals = counts.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    known = counts.filter("size > 0").select("lang", "phrase", "f")
    long = counts.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def words(start, count):
        return F.array_join(F.slice("w", start, count), " ")

    cuts = long.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", words(F.lit(1), F.col("k")).alias("left"),
                words(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]) \
        .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])

    def wide(column):
        return F.col(column).cast("decimal(20,0)")

    over = (wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")).alias("over")
    scored = cuts.select("lang", "phrase", "a", "k", "l", "r", over, (wide("l") * wide("r")).alias("under")) \
        .withColumn("score", F.expr("over div under")) \
        .groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = long.filter("size > 2").select("lang", "a", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m")) \
        .select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("s")) \
        .groupBy("lang", words(F.col("s"), F.col("m")).alias("phrase")).agg(F.max("a").alias("around"))
    kept = scored.join(parts, ["lang", "phrase"], "left") \
        .filter(F.col("around").isNull() | (inside[1] * F.col("around") < inside[0] * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(totals, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
