"""Language identification by string kernels.

The kernel of two texts is the blended spectrum of n-gram presence: for each
n = 1..3, the number of distinct n-grams both hold over the root of the product
of their numbers, summed over n. One-versus-rest kernel ridge regression is
fitted on a Nystroem approximation with landmark texts: a bounded sample of
labelled texts, ``per_class`` for each language, the first ``landmarks`` of which
are the landmarks.

N-grams are over 7-bit symbols of the text's UTF-8 bytes: a-z (A-Z lower-cased),
one symbol for all other ASCII, and 101 for non-ASCII bytes. The ``grams``
n-grams whose presence differs most between the sample's languages are the
kernel's coordinates. Scoring is then batched matrix products: the presence
matrix of a batch of whole texts times (landmark matrix x dual weights).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keys import stage
from .text import parts, string_slices

PER_CLASS = 250        # labelled texts a language is learnt from, at most
LANDMARKS = 40         # of them landmarks
GRAMS = 6000           # n-grams that the kernel counts
RIDGE = 1e-4
UNKNOWN = "und"

_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 101
_START = np.array([0, 1 << 7, (1 << 7) + (1 << 14)])     # where each n's codes begin
_CODES = (1 << 7) + (1 << 14) + (1 << 21)


def _grams(buf: np.ndarray, offsets: np.ndarray):
    """For n = 1, 2, 3: (code, text index) of every n-gram inside a text."""
    s = _SYMBOL[buf]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code = s
    yield code, text
    for n in (2, 3):
        if len(s) < n:
            return
        code = (code[:len(s) - n + 1] << 7) | s[n - 1:]
        inside = text[:len(s) - n + 1] == text[n - 1:]
        yield code[inside] + _START[n - 1], text[:len(s) - n + 1][inside]


def _distinct_grams(batches):
    import pyarrow as pa
    for batch in batches:
        names = batch.schema.names
        lang, rank = batch.column(names.index("lang")), batch.column(names.index("rank"))
        for first, buf, off in string_slices(batch.column(names.index("text")), max_rows=256):
            pairs = np.unique(np.concatenate([t * _CODES + c for c, t in _grams(buf, off)] or [np.zeros(0, np.int64)]))
            at = np.searchsorted(pairs // _CODES, np.arange(len(off)))
            codes, n = (pairs % _CODES).astype(np.int32), len(off) - 1
            yield pa.RecordBatch.from_arrays(
                [lang.slice(first, n), rank.slice(first, n),
                 pa.array([codes[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())],
                names=["lang", "rank", "grams"])


def has_letter(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


class Model:
    """``langs``, the column of each n-gram code, and per n the product of
    the landmark matrix and the dual weights."""

    def __init__(self, langs, column, block, weights, bias):
        self.langs, self.column, self.block, self.weights, self.bias = langs, column, block, weights, bias


def sample(labelled: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(lang, rank, text): ``per_class`` texts of each language by a hash of
    id and text; rows that repeat doc_id, lang and text count once. Only ids and
    hashes are shuffled, thinned to about twice as many by the counts before
    they are ranked; the chosen ones find one row each."""
    rows = labelled.select("doc_id", "lang", "text", F.xxhash64("text").alias("th"))
    ids = stage(rows.select("doc_id", "lang", "th").distinct()
                .withColumn("u", F.abs(F.xxhash64("doc_id", "th", F.lit(7)))), "ids")
    counts = ids.groupBy("lang").count()
    likely = ids.join(F.broadcast(counts), "lang").filter(F.col("u") <= F.lit(float(1 << 63)) * (2 * per_class + 50) / F.col("count"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("u", "doc_id", "th"))
    chosen = stage(likely.select("doc_id", "lang", "th", rank.alias("rank")).filter(F.col("rank") <= per_class), "sample")
    # copies of a chosen row are settled inside tasks before they meet
    return rows.join(F.broadcast(chosen), ["doc_id", "lang", "th"]) \
        .groupBy("lang", "rank").agg(F.min("text").alias("text"))


def fit(labelled: DataFrame, per_class: int = PER_CLASS, landmarks: int = LANDMARKS, grams: int = GRAMS,
        ridge: float = RIDGE) -> Model | None:
    """Fit on rows (doc_id, lang, text); rows without lang, id or a letter
    teach nothing. None where nothing is left."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & has_letter(F.col("text")))
    # at most per_class sets of distinct n-grams for each language
    got = sample(rows, per_class).mapInArrow(_distinct_grams, "lang string, rank int, grams binary").toPandas()
    if not len(got):
        return None
    got["grams"] = got["grams"].map(lambda b: np.frombuffer(bytes(b), np.int32))
    got = got.assign(size=got["grams"].map(len)).sort_values(["lang", "rank", "size"], kind="stable").reset_index(drop=True)
    langs = sorted(got["lang"].unique())
    y = np.array([langs.index(x) for x in got["lang"]])
    codes = np.unique(np.concatenate(got["grams"].to_list()))
    seen = np.zeros((len(got), len(codes)), bool)
    for i, g in enumerate(got["grams"]):
        seen[i, np.searchsorted(codes, g)] = True
    rates = np.stack([seen[y == c].mean(0) for c in range(len(langs))])
    spread = rates.max(0) - rates.min(0) + 1e-3 * rates.max(0)
    use = np.sort(np.argsort(-spread, kind="stable")[:grams])
    every = codes
    codes, x = codes[use], seen[:, use].astype(np.float64)
    column = np.full(_CODES, len(codes) + 1, np.int16)      # in no learnt text
    column[every] = len(codes)          # seen, but without a weight
    column[codes] = np.arange(len(codes))
    block = np.searchsorted(codes, np.append(_START, _CODES))
    parts = []
    for b, e in zip(block[:-1], block[1:]):
        parts.append(x[:, b:e] / np.sqrt(np.maximum(x[:, b:e].sum(1, keepdims=True), 1)))
    mark = (got["rank"] <= landmarks).to_numpy()
    k_nm = sum(p @ p[mark].T for p in parts)
    val, vec = np.linalg.eigh(k_nm[mark])
    ok = val > 1e-8 * val[-1]
    root = vec[:, ok] / np.sqrt(val[ok])                  # K_mm ** -1/2
    phi = np.hstack([k_nm @ root, np.ones((len(got), 1))])
    target = np.where(y[:, None] == np.arange(len(langs)), 1.0, -1.0)
    weight = 1.0 / np.bincount(y)[y][:, None]             # every language counts alike
    reg = ridge * np.eye(phi.shape[1])
    reg[-1, -1] = 1e-12
    w = np.linalg.solve(phi.T @ (phi * weight) + reg, phi.T @ (target * weight))
    dual = root @ w[:-1]
    weights = [(p[mark].T @ dual).astype(np.float32) for p in parts]
    return Model(langs, column, block, weights, w[-1].astype(np.float32))


def _scored(batch_text, letters, model: Model):
    """(index of the language, score, known share) of each text; -1 where it has no letter."""
    best = np.full(len(batch_text), -1)
    score, known = np.zeros(len(batch_text)), np.zeros(len(batch_text))
    if model is None:
        return best, score, known
    width = int(model.block[-1]) + 2
    for first, buf, off in string_slices(batch_text, max_rows=512):
        n = len(off) - 1
        seen = np.zeros(n * width, bool)
        total, strange = np.zeros(n), np.zeros(n)
        for at, part, part_off in parts(buf, off):
            for code, text in _grams(part, part_off):
                text = text + at
                column = model.column[code]
                seen[text * width + column] = True
                total += np.bincount(text, minlength=n)
                strange += np.bincount(text[column == width - 1], minlength=n)     # few
        known[first:first + n] = (total - strange) / np.maximum(total, 1)
        seen = seen.reshape(n, width)
        out = np.tile(model.bias, (n, 1))
        for b, e, w in zip(model.block[:-1], model.block[1:], model.weights):
            p = seen[:, b:e].astype(np.float32)
            out += (p @ w) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1))
        out = np.exp(np.clip(4 * (out - out.max(1, keepdims=True)), -60, 0))
        best[first:first + n] = out.argmax(1)
        score[first:first + n] = 1 / out.sum(1)
    best[~letters] = -1
    score[~letters] = 0
    return best, score, known


def identify(documents: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, lang_pred (``und`` where text is null
    or has no letter, or nothing could be learnt) and score (0 to 1). Only
    text is looked at."""
    sc = documents.sparkSession.sparkContext
    own = [c for c in keep if c != "text"]       # the text goes to the workers and back once
    with_text = "text" in keep
    shared = sc.broadcast(model)       # 2**21 short integers and 6000 weights for each language
    names = [f"c{i}" for i in range(len(own))]

    def run(batches):
        import pyarrow as pa
        model = shared.value
        langs = np.array([*(model.langs if model else []), UNKNOWN], dtype=object)
        for batch in batches:
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            best, score, known = _scored(batch.column(0), letters, model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], *([batch.column(0)] if with_text else []), pa.array(langs[best], pa.string()),
                 pa.array(score, pa.float64()), pa.array(known, pa.float64())],
                names=[*names, *(["t"] if with_text else []), "lang_pred", "score", "known"])

    rows = documents.select(F.col("text").alias("t"), has_letter(F.col("text")).alias("l"),
                            *[F.col(c).alias(n) for c, n in zip(own, names)])
    kinds = [f"{n} {documents.schema[c].dataType.simpleString()}" for c, n in zip(own, names)] + ["t string"] * with_text
    out = rows.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double", "known double"]))
    name = dict(zip(own, names)) | {"text": "t"}
    return out.select(*[F.col(name[c]).alias(c) for c in keep], "lang_pred", "score", "known")


def held_out(doc_id):
    """A third of the ids is never learnt from, nor are rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def identify_documents(documents: DataFrame, **params) -> DataFrame:
    """Learn from the rows that are not held out and predict every row:
    doc_id, held_out, lang_pred, score, known. One row for each input row, repeated
    ids included; an empty table gives an empty result; other columns are
    ignored."""
    d = documents.select("doc_id", "lang", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(d, fit(d.filter("not held_out"), **params), ["doc_id", "held_out"])
