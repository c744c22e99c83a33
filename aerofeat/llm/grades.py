"""Quality classifier: ordinal regression on graded ratings.

A cumulative-link (proportional-odds) model: P(grade > k) =
sigmoid(w . x - theta_k), with one weight vector shared by all grades and
ordered thresholds theta_0 < theta_1 < ... It gives an expected grade and, for
selection, the probability of the top grade.

x marks the distinct hashed features of a whole text, over the fourth root of
their number: lower-cased words, the shapes of the last four characters of
white-space-separated tokens, and how varied the words are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import stage
from .text import (BYTE_CODE, LOWER, WORD_ALNUM, WORD_NONSPACE, mix, prefix_sums, run_hash, string_slices, word_hashes,
                   word_runs)

BUCKETS = 1 << 18
TRAIN_DOCS = 5000       # labelled documents that the model is fitted on, about
STEPS = 200
RATE = 0.05
DECAY = 1e-3
DAMP = 0.25             # a text's features count as their number to the power -DAMP
TAIL = 0.5              # selected: probability of the top grade from here on
GRADES = 3              # 0 toxic, 1 poor, 2 good

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE[128:] = 97


def features(buf: np.ndarray, off: np.ndarray):
    """Distinct (text index, bucket) pairs of texts end to end in ``buf``, by
    text and bucket."""
    n = len(off) - 1
    h, _, _, text = word_hashes(LOWER[buf], off, WORD_ALNUM)
    start, end, token = word_runs(buf, off, WORD_NONSPACE)
    sums = prefix_sums(BYTE_CODE[_SHAPE[buf]])
    shape = run_hash(sums, np.maximum(start, end - 4), end)
    b = np.uint64(BUCKETS)
    pair = np.unique(np.concatenate([text * BUCKETS + (h % b).astype(np.int64),
                                     token * BUCKETS + (mix(shape ^ np.uint64(1)) % b).astype(np.int64)]))
    # distinct words in tenths of all words
    words = np.bincount(text, minlength=n)
    own = np.unique(text * BUCKETS + (h % b).astype(np.int64)) // BUCKETS
    tenth = 10 * np.bincount(own, minlength=n) // np.maximum(words, 1)
    some = np.flatnonzero(words)
    varied = mix(tenth[some].astype(np.uint64) + np.uint64(1 << 40)) % b
    pair = np.unique(np.concatenate([pair, some * BUCKETS + varied.astype(np.int64)]))
    return pair // BUCKETS, pair % BUCKETS


def _training(batches):
    import pyarrow as pa
    for batch in batches:
        for first, buf, off in string_slices(batch.column(1)):
            text, bucket = features(buf, off)
            at = np.searchsorted(text, np.arange(len(off)))
            bucket = bucket.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(off) - 1),
                 pa.array([bucket[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())],
                names=["grade", "buckets"])


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, text: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        """P(grade > k) for each text and threshold."""
        size = np.bincount(text, minlength=n)
        z = np.bincount(text, weights=self.weights[bucket], minlength=n) * np.maximum(size, 1.0) ** -DAMP
        return _sigmoid(z[:, None] - self.thresholds[None])


def fit_model(grades: np.ndarray, buckets: list[np.ndarray], n_grades: int = GRADES, steps: int = STEPS,
              rate: float = RATE, decay: float = DECAY) -> Model:
    """Full-batch Adam on the mean negative log-likelihood. Thresholds are a
    first one and logarithms of gaps, so they stay ordered; a grade weighs as the
    root of its share."""
    size = np.array([len(b) for b in buckets])
    idx = np.concatenate(buckets) if len(buckets) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    scale = np.maximum(size, 1.0) ** -DAMP
    share = np.bincount(grades, minlength=n_grades) / max(1, len(grades))
    weight = np.maximum(share, 1e-9)[grades] ** -0.5 / max(1, len(grades))
    w = np.zeros(BUCKETS)
    t = np.concatenate([[-1.0], np.zeros(n_grades - 2)])
    m, v = [np.zeros_like(w), np.zeros_like(t)], [np.zeros_like(w), np.zeros_like(t)]
    for step in range(1, steps + 1):
        theta = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        z = np.bincount(row, weights=w[idx], minlength=len(size)) * scale
        up = np.hstack([np.ones((len(z), 1)), _sigmoid(z[:, None] - theta), np.zeros((len(z), 1))])
        slope = up * (1 - up)
        i = np.arange(len(z))
        p = np.maximum(up[i, grades] - up[i, grades + 1], 1e-12)
        high, low = slope[i, grades] / p, slope[i, grades + 1] / p       # d log p = high dz_k - low dz_(k+1)
        gz = -weight * (high - low)
        gw = np.bincount(idx, weights=(gz * scale)[row], minlength=BUCKETS) + decay * w
        gtheta = np.zeros(n_grades - 1)
        np.add.at(gtheta, np.maximum(grades - 1, 0), np.where(grades > 0, weight * high, 0))
        np.add.at(gtheta, np.minimum(grades, n_grades - 2), np.where(grades < n_grades - 1, -weight * low, 0))
        after = np.cumsum(gtheta[::-1])[::-1]
        gt = np.concatenate([after[:1], after[1:] * np.exp(t[1:])])
        for k, (x, g) in enumerate(((w, gw), (t, gt))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            x -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(w.astype(np.float32), np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])))


def grade(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): toxic 0, poor 1, good 2. Ids labelled several times
    take the lowest; rows that say nothing are left out."""
    g = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.filter(F.col("doc_id").isNotNull()).select("doc_id", g.alias("grade")).filter("grade is not null") \
        .groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))


def learn(documents: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, **params) -> Model | None:
    """Fit on a sample of about ``train_docs`` labelled texts, thinned by a hash
    of id and text; rows that repeat both count once, and unlike texts of one
    id are documents of their own. None where no text is labelled."""
    graded = stage(grade(labels), "grades")
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    ids = stage(rows.select("doc_id", "th").distinct().join(graded, "doc_id"), "grades")
    share = min(1.0, train_docs / max(1, ids.count()))
    chosen = stage(ids.filter(F.abs(F.xxhash64("doc_id", "th", F.lit(13))) <= F.lit(share * float(1 << 63))), "grades")
    rows = rows.join(F.broadcast(chosen), ["doc_id", "th"]) \
        .groupBy("doc_id", "th", "grade").agg(F.min("text").alias("text")).select("grade", "text")
    got = rows.mapInArrow(_training, "grade int, buckets binary").toPandas()
    if not len(got):
        return None
    # the same model whatever the order the rows came in
    got = got.assign(buckets=got["buckets"].map(bytes)).sort_values(["grade", "buckets"], kind="stable")
    return fit_model(got["grade"].to_numpy(), [np.frombuffer(b, np.int32) for b in got["buckets"]], **params)


def score(documents: DataFrame, model: Model | None, tail: float = TAIL) -> DataFrame:
    """Per row: doc_id, expected_grade, tail_probability (of the top grade)
    and selected (tail_probability >= ``tail``). A text without words has no
    features and gets what the thresholds alone imply, a null text too; without
    a model all three columns are null, and nothing is selected. Other columns
    are ignored."""
    shared = documents.sparkSession.sparkContext.broadcast(model)     # BUCKETS weights

    def run(batches):
        import pyarrow as pa
        model = shared.value
        for batch in batches:
            for first, buf, off in string_slices(batch.column(1)):
                n = len(off) - 1
                if model is None:
                    expected = top = pa.nulls(n, pa.float64())
                    chosen = pa.array(np.zeros(n, bool))
                else:
                    up = model.tails(*features(buf, off), n)
                    expected, top, chosen = pa.array(up.sum(1)), pa.array(up[:, -1]), pa.array(up[:, -1] >= tail)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), expected, top, chosen],
                                                 names=["doc_id", "expected_grade", "tail_probability", "selected"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, expected_grade double, tail_probability double, selected boolean")


def grade_documents(documents: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """``learn`` and ``score``."""
    return score(documents, learn(documents, labels, **params))
