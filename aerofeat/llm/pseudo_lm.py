"""LM scoring by masked pseudo-likelihood.

A window network predicts each token from the token on its left and the one on
its right: hidden = tanh(L[left] + R[right] + b), probabilities = softmax(hidden
U + c), trained in numpy. A document's score is the sum of the conditional
log-probabilities of all its tokens.

Tokens are words. The network's symbols are the ``top`` most frequent words of the
whole corpus, and ``tails`` hashed classes for all others; the end of a text is a
symbol of its own on either side. The vocabulary is every word of the corpus: a word of
a class has the probability of its class there, times its own share in the class, which is
its exact count over all documents by that of the class. With so few symbols the corpus enters the training through one
table of counts, (left, token, right), gathered over every document; its size
is the number of symbols cubed, whatever the corpus. The trained network is
likewise one table of conditional log-probabilities, which tasks look up. The words'
counts are as many as the corpus has words; they stay distributed and are joined with the
words of the texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import stage
from .text import LOWER, WORD_ALNUM, string_slices, word_hashes

TOP = 96               # most frequent words that are symbols
TAILS = 32             # hashed classes of the other words
HIDDEN = 32
STEPS = 200
RATE = 0.03
HELD = 1 << 20         # distinct words a task holds before it passes counts on


def _merged(words: np.ndarray, counts: np.ndarray):
    o = np.argsort(words, kind="stable")
    words, counts = words[o], counts[o]
    at = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    return words[at], np.add.reduceat(counts, at) if len(at) else counts


def _word_counts(batches):
    import pyarrow as pa

    def rows(w, n):
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], names=["word", "n"])

    held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for _, buf, off in string_slices(batch.column(0)):
            w, c = np.unique(word_hashes(LOWER[buf], off, WORD_ALNUM)[0], return_counts=True)
            held, n = _merged(np.concatenate([held, w]), np.concatenate([n, c]))
            if len(held) > HELD:
                yield rows(held, n)
                held, n = held[:0], n[:0]
    yield rows(held, n)


class Symbols:
    """Word hashes → symbols 0..size-1; ``size`` itself stands for an end."""

    def __init__(self, words: np.ndarray, tails: int):
        self.words, self.tails = np.sort(words), tails
        self.size = len(words) + tails

    def of(self, hashes: np.ndarray) -> np.ndarray:
        tail = len(self.words) + (hashes % np.uint64(self.tails)).astype(np.int64)
        if not len(self.words):
            return tail
        i = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[i] == hashes, i, tail)

    def triples(self, buf: np.ndarray, off: np.ndarray):
        """(left, token, right, text index) of every token of the texts."""
        h, _, _, text = word_hashes(LOWER[buf], off, WORD_ALNUM)
        s = self.of(h)
        left, right = np.full(len(s), self.size), np.full(len(s), self.size)
        same = text[1:] == text[:-1]
        left[1:][same] = s[:-1][same]
        right[:-1][same] = s[1:][same]
        return left, s, right, text


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n): every word of all documents, by hash, and how often it occurs."""
    return documents.select("text").mapInArrow(_word_counts, "word long, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def symbols_of(words: DataFrame, top: int = TOP, tails: int = TAILS) -> Symbols:
    """Symbols from word counts (ties by hash)."""
    most = words.orderBy(F.desc("n"), "word").limit(top).collect()
    return Symbols(np.array([r["word"] for r in most], np.int64).view(np.uint64), tails)


def vocabulary(documents: DataFrame, top: int = TOP, tails: int = TAILS) -> Symbols:
    """Symbols from the word counts of all documents."""
    return symbols_of(word_counts(documents), top, tails)


def _triple_counts(symbols: Symbols):
    def run(batches):
        import pyarrow as pa
        ends = symbols.size + 1
        total = np.zeros(ends * ends * symbols.size, np.int32)
        for batch in batches:
            for _, buf, off in string_slices(batch.column(0)):
                left, token, right, _ = symbols.triples(buf, off)
                code, n = np.unique((left * ends + right) * symbols.size + token, return_counts=True)
                total[code] += n.astype(np.int32)
                if total.max(initial=0) > 1 << 30:
                    some = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))],
                                                     names=["code", "n"])
                    total[:] = 0
        some = np.flatnonzero(total)
        for i in range(0, len(some), 1 << 17):
            part = some[i:i + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))],
                                             names=["code", "n"])
    return run


def _packed(batches):
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.column(0).to_numpy().tobytes()], pa.binary()),
             pa.array([batch.column(1).to_numpy().tobytes()], pa.binary())], names=["codes", "counts"])


def count_triples(documents: DataFrame, symbols: Symbols) -> np.ndarray:
    """counts[left, right, token] over all documents."""
    ends = symbols.size + 1
    got = documents.select("text").mapInArrow(_triple_counts(symbols), "code int, n long") \
        .groupBy("code").agg(F.sum("n").alias("n")).mapInArrow(_packed, "codes binary, counts binary")
    counts = np.zeros(ends * ends * symbols.size, np.float32)
    for r in got.toLocalIterator():       # as many numbers as the table has, in blocks
        counts[np.frombuffer(r["codes"], np.int32)] = np.frombuffer(r["counts"], np.int64)
    return counts.reshape(ends, ends, symbols.size)


def train(counts: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, rate: float = RATE, seed: int = 1) -> np.ndarray:
    """Train the network on all counts (full-batch Adam on the mean
    pseudo-log-likelihood) and return its table log P(token | left, right),
    indexed [left, right, token]."""
    ends, _, size = counts.shape
    rnd = np.random.default_rng(seed)
    left, right = np.divmod(np.arange(ends * ends), ends)
    n = counts.reshape(-1, size)
    seen = np.flatnonzero(n.sum(1))
    total = n.sum(dtype=np.float64)
    start = np.log((n.sum(0, dtype=np.float64) + 1) / (total + size))
    p = [rnd.normal(0, 0.3, (ends, hidden)), rnd.normal(0, 0.3, (ends, hidden)), np.zeros(hidden),
         rnd.normal(0, 0.1, (hidden, size)), start]
    m, v = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    weight = (n[seen] / max(1.0, total)).astype(np.float32)
    mass = weight.sum(1, keepdims=True)

    def forward(rows):
        h = np.tanh(p[0][left[rows]] + p[1][right[rows]] + p[2]).astype(np.float32)
        z = h @ p[3].astype(np.float32) + p[4].astype(np.float32)
        z -= z.max(1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(1, keepdims=True))

    for step in range(1, steps + 1) if len(seen) else ():
        h, log_p = forward(seen)
        gz = np.exp(log_p) * mass - weight
        gh = (gz @ p[3].T.astype(np.float32)) * (1 - h * h)
        g = [np.zeros_like(p[0]), np.zeros_like(p[1]), gh.sum(0), h.T @ gz, gz.sum(0)]
        np.add.at(g[0], left[seen], gh)
        np.add.at(g[1], right[seen], gh)
        for k in range(len(p)):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] * g[k]
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-9)
    return forward(np.arange(ends * ends))[1].reshape(ends, ends, size)


def score(documents: DataFrame, symbols: Symbols, table: np.ndarray, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_tokens, log_likelihood (the sum of its tokens'
    conditional log-probabilities, as symbols) and mean_log_likelihood (null without
    tokens). Whole texts; a null text has no tokens. ``keep`` may name long columns to stay,
    and then ``n_tail`` is the number of tokens that are words of a class."""
    shared = documents.sparkSession.sparkContext.broadcast((symbols, table))   # symbols cubed

    def run(batches):
        import pyarrow as pa
        symbols, table = shared.value
        for batch in batches:
            for first, buf, off in string_slices(batch.column(1)):
                left, token, right, text = symbols.triples(buf, off)
                n = np.bincount(text, minlength=len(off) - 1)
                total = np.bincount(text, weights=table[left, right, token].astype(np.float64), minlength=len(n))
                cols = [batch.column(0).slice(first, len(n)), pa.array(n), pa.array(total),
                        pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0)]
                names = ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"]
                if keep:
                    cols.append(pa.array(np.bincount(text[token >= len(symbols.words)], minlength=len(n))))
                    cols += [batch.column(2 + i).slice(first, len(n)) for i in range(len(keep))]
                    names += ["n_tail", *keep]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    more = "".join(f", {c} long" for c in ("n_tail", *keep)) if keep else ""
    return documents.select("doc_id", "text", *keep).mapInArrow(
        run, f"doc_id {id_type}, n_tokens long, log_likelihood double, mean_log_likelihood double" + more)


def _tail_words(symbols: Symbols):
    """(text, hash of the text) → (``_text``, word, times) of the words that are in a class."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            key = batch.column(1).to_numpy()
            for first, buf, off in string_slices(batch.column(0)):
                h, _, _, text = word_hashes(LOWER[buf], off, WORD_ALNUM)
                tail = symbols.of(h) >= len(symbols.words)
                h, text = h[tail], text[tail]
                o = np.argsort(h)
                o = o[np.argsort(text[o], kind="stable")]
                h, text = h[o], text[o]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first + text[at]]), pa.array(h[at].view(np.int64)),
                     pa.array(np.diff(np.append(at, len(h))).astype(np.int32))], names=["_text", "word", "times"])
    return run


def score_words(documents: DataFrame, words: DataFrame, symbols: Symbols, counts: np.ndarray, table: np.ndarray) -> DataFrame:
    """``score`` with every word of its own: a word of a class adds the logarithm of its
    share in the class. ``words`` has the corpus's counts, ``counts`` those of the triples.

    A text is known by its hash, so equal texts add up to one sum; the share of a row in it
    is that of its tokens."""
    table = table.copy()
    # the class's count goes into the table, the word's own count comes by the join
    table[:, :, len(symbols.words):] -= np.log(np.maximum(1.0, counts.sum((0, 1), dtype=np.float64)))[len(symbols.words):]
    docs = documents.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    own = docs.select("text", "_text").mapInArrow(_tail_words(symbols), "_text long, word long, times int") \
        .join(words, "word").groupBy("_text").agg(F.sum(F.col("times") * F.log("n")).alias("_sum"), F.sum("times").alias("_times"))
    total = F.col("log_likelihood") + F.coalesce(F.col("_sum") / F.col("_times") * F.col("n_tail"), F.lit(0.0))
    return score(docs, symbols, table, keep=("_text",)).join(own, "_text", "left") \
        .select("doc_id", "n_tokens", total.alias("log_likelihood"),
                F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))


def score_documents(documents: DataFrame, top: int = TOP, tails: int = TAILS, **params) -> DataFrame:
    """Vocabulary, counts, training and scores of one corpus. One row for each
    input row, repeated ids included; other columns are ignored; an empty
    table gives an empty result."""
    words = stage(word_counts(documents), "words")
    symbols = symbols_of(words, top, tails)
    counts = count_triples(documents, symbols)
    return score_words(documents, words, symbols, counts, train(counts, **params))
