"""Suffix-array de-duplication by bucket-pointer refinement.

Every byte covered by a ``length``-byte string that also starts earlier in the
corpus is removed. Bucket-pointer refinement sorts suffixes into buckets by
their first q bytes, then refines a bucket by sorting its members on the
identifiers of buckets at later offsets; a member whose bucket has become
single is done, and what was learnt for one member serves the others. Only
order to depth ``length`` matters here, so:

1. Initial buckets: q-byte strings. Of the suffixes that start in one
   ``length``-byte window, only the one whose q-byte bucket identifier (a hash)
   is smallest is kept. The choice depends on the window's bytes alone, so
   equal windows keep suffixes at equal offsets, and a bucket holds all
   that can decide a window: about 2 / (length - q + 2) of the suffixes.
2. Refinement: a bucket's members are sorted on the identifier of the whole
   context that their windows span. Members with equal identifiers have all
   windows equal; the first stays, the others are settled (their windows all
   start earlier elsewhere) and its result serves them. A bucket of one class
   is done.
3. Recursion: in buckets with several classes, the first member of each class
   is refined once more, on the identifiers of its single windows.
4. Runs: windows found are merged per document, and covered bytes removed.

Identifiers are 64-bit hashes: an equality rests on bucket and context (128
bits) in step 2, on 64 bits of both inside a slice, and on a window's 64 bits
within a bucket in step 3.

Skew: what repeats inside a slice of texts is settled there, before the
shuffle. Step 2 streams sorted rows (Spark's external sort) and holds one row,
whatever the size of a bucket. Step 3 holds the window identifiers of one
bucket; buckets with over ``hot_classes`` classes are dealt out by window
identifier and streamed as in step 2 instead.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import KEY, keyed, stage
from .text import BYTE_CODE, mix, parts, prefix_sums, run_hash, string_slices

LENGTH = 100          # bytes of a repeated string
Q = 28                # bytes of an initial bucket
HOT_CLASSES = 100_000  # classes of a bucket that one task may hold
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
SPAN_BITS = 16        # a span is (first window << 16) + number of windows


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[:len(values) - (width - size)],
                                                   values[width - size:])


def kept_suffixes(buf: np.ndarray, offsets: np.ndarray, length: int, q: int):
    """For texts end to end in ``buf``: (bucket, context, text index, first
    window in the text, number of windows) of each kept suffix."""
    n_windows = len(buf) - length + 1
    if n_windows <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    sums = prefix_sums(BYTE_CODE[buf])
    at = np.arange(len(buf) - q + 1)
    bucket = run_hash(sums, at, at + q)
    # the smallest bucket identifier, leftmost among equals
    best = _sliding_min((bucket & _HIGH) | at.astype(np.uint64), length - q + 1)
    best = (best[:n_windows] & _LOW).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(text[:n_windows] == text[length - 1:length - 1 + n_windows])
    if not len(window):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    best, text = best[window], text[window]
    new = np.ones(len(window), bool)
    new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1])
    s = np.flatnonzero(new)
    first, last = window[s], window[np.append(s[1:], len(window)) - 1]
    chosen, text = best[s], text[s]
    context = run_hash(sums, first, last + length)
    context = mix(context ^ mix((chosen - first).astype(np.uint64) + np.uint64(1)))
    return bucket[chosen], context, text, first - offsets[text], last - first + 1


def _signed(a: np.ndarray):
    return np.ascontiguousarray(a).view(np.int64)


def _settled_here(bucket, context, rank) -> np.ndarray:
    """Members of one slice whose context an earlier one of it has. ``rank``
    is the order of their documents; a document's members come in order."""
    o = np.argsort(rank, kind="stable")
    both = (bucket ^ mix(context))[o]
    p = np.argsort(both, kind="stable")
    settled = np.zeros(len(both), bool)
    settled[o[p[1:]]] = both[p[1:]] == both[p[:-1]]
    return settled


def _suffix_rows(length: int, q: int):
    """Texts → their kept suffixes. Members that are settled inside the slice
    (a text or line repeated there) have their span inverted and are dealt out
    at random, so that a bucket gets one row of a slice for each context."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, buf, off in string_slices(batch.column(1)):
                # suffixes by part, what repeats by slice
                found = [(t, kept_suffixes(b, o, length, q)) for t, b, o in parts(buf, off)]
                text = np.concatenate([t + x[2] for t, x in found])
                bucket, context, at, n = (np.concatenate([x[i] for _, x in found]) for i in (0, 1, 3, 4))
                del found
                if not len(bucket):
                    continue
                rank = np.argsort(np.argsort(keys[first:first + len(off) - 1], kind="stable")).astype(np.uint16)
                settled = _settled_here(bucket, context, rank[text])
                span = (at << SPAN_BITS) + n
                bucket[settled] = mix(bucket[settled] ^ mix((keys[first + text[settled]] ^ span[settled]).view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(bucket)), pa.array(_signed(context)),
                     pa.array(keys[first + text]), pa.array(np.where(settled, ~span, span))],
                    names=["bucket", "context", KEY, "span"])
    return run


def _settle(batches):
    """Rows sorted by (bucket, context, key, span): settled members (their
    context stood before, here or in their slice) as kind 0; first members of
    a class in a bucket of several classes as kind 1. Holds back one row."""
    import pyarrow as pa
    held = None       # the last row, while it may yet be the only class of its bucket
    last = (None, None)

    def rows(bucket, key, span, kind):
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(key), pa.array(span), pa.array(kind.astype(np.int8))],
            names=["bucket", KEY, "span", "kind"])

    for batch in batches:
        if not batch.num_rows:
            continue
        b, c, k, s = (batch.column(i).to_numpy() for i in range(4))
        done = s < 0
        if done.any():
            yield rows(b[done], k[done], ~s[done], np.zeros(int(done.sum())))
            b, c, k, s = b[~done], c[~done], k[~done], s[~done]
            if not len(b):
                continue
        same_b = np.empty(len(b), bool)
        same_c = np.empty(len(b), bool)
        same_b[1:] = b[1:] == b[:-1]
        same_c[1:] = same_b[1:] & (c[1:] == c[:-1])
        same_b[0] = last[0] is not None and b[0] == last[0]
        same_c[0] = same_b[0] and c[0] == last[1]
        last = (b[-1], c[-1])
        rep = ~same_c
        # first class of a bucket: kept back until a second class shows up
        opens = rep & ~same_b
        later = rep & same_b            # a second or later class
        group = np.cumsum(~same_b)      # 0: the bucket that was open before
        has_later = np.zeros(group[-1] + 1, bool)
        has_later[group[later]] = True
        need = later | (opens & has_later[group])
        if held is not None and has_later[0]:
            yield rows(*(np.array([x]) for x in held), np.ones(1))
            held = None
        if group[-1] > 0:               # the earlier open bucket has ended
            held = None
            i = int(np.flatnonzero(opens)[-1])
            if not has_later[group[-1]]:
                held = (b[i], k[i], s[i])
        out = np.flatnonzero(same_c | need)
        if len(out):
            yield rows(b[out], k[out], s[out], need[out])


def _contexts(length: int):
    """Documents with their unsettled spans → (bucket, key, first window, bytes)."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            names = batch.schema.names
            texts, keys = batch.column(names.index("text")), batch.column(names.index(KEY)).to_numpy()
            need = batch.column(names.index("need"))
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer().to_pybytes()
                spans = need[i].values
                at = spans.field("span").to_numpy(zero_copy_only=False)
                lo, n = at >> SPAN_BITS, at & ((1 << SPAN_BITS) - 1)
                yield pa.RecordBatch.from_arrays(
                    [spans.field("bucket"), pa.array(np.full(len(at), keys[i])), pa.array(lo),
                     pa.array([raw[a:a + m + length - 1] for a, m in zip(lo, n)], pa.binary())],
                    names=["bucket", KEY, "lo", "bytes"])
    return run


def _merged(source):
    """Small record batches gathered into larger ones."""
    def run(batches):
        import pyarrow as pa
        held, rows = [], 0
        for b in source(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 5000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return run


def _window_hashes(column, length: int):
    """Window identifiers of each row's bytes: (identifier, row, offset)."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    n = np.diff(off) - length + 1
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = off[row] + within
    return run_hash(prefix_sums(BYTE_CODE[data]), at, at + length), row, within


def _refine(length: int):
    """Rows sorted by (bucket, key, lo): windows that an earlier row of the
    bucket has, as spans."""
    def run(batches):
        import pyarrow as pa
        pending = None

        def spans(t):
            t = t.combine_chunks().to_batches()[0]
            h, row, within = _window_hashes(t.column(3), length)
            order = np.argsort(h, kind="stable")
            seen = np.zeros(len(h), bool)
            seen[order[1:]] = h[order[1:]] == h[order[:-1]]
            i = np.flatnonzero(seen)
            if not len(i):
                return None
            new = np.ones(len(i), bool)
            new[1:] = (row[i[1:]] != row[i[:-1]]) | (within[i[1:]] != within[i[:-1]] + 1)
            s = np.flatnonzero(new)
            n = np.diff(np.append(s, len(i)))
            r = row[i[s]]
            lo = t.column(2).to_numpy()[r] + within[i[s]]
            return pa.RecordBatch.from_arrays(
                [pa.array(t.column(1).to_numpy()[r]), pa.array((lo << SPAN_BITS) + n)], names=[KEY, "span"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            pending = t if pending is None else pa.concat_tables([pending, t])
            if pending.num_rows < 5000:
                continue
            b = pending.column(0).to_numpy()
            cut = int(np.searchsorted(b, b[-1]))   # the last bucket may go on
            if cut:
                out = spans(pending.slice(0, cut))
                pending = pending.slice(cut)
                if out is not None:
                    yield out
        if pending is not None and pending.num_rows:
            out = spans(pending)
            if out is not None:
                yield out
    return run


def _single_windows(length: int):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                h, row, within = _window_hashes(part.column(3), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(h)), pa.array(part.column(1).to_numpy()[row]),
                     pa.array(part.column(2).to_numpy()[row] + within)], names=["window", KEY, "lo"])
    return run


def _repeated_windows(batches):
    """Rows sorted by (window, key, lo): all but the first of each window."""
    import pyarrow as pa
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        w, k, lo = (batch.column(i).to_numpy() for i in range(3))
        same = np.empty(len(w), bool)
        same[1:] = w[1:] == w[:-1]
        same[0] = last is not None and w[0] == last
        last = w[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k[same]), pa.array((lo[same] << SPAN_BITS) + 1)], names=[KEY, "span"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, q: int = Q,
                   hot_classes: int = HOT_CLASSES) -> DataFrame:
    """(``_key``, ``span``): runs of windows of ``docs`` (from ``keyed``) that
    start earlier in the corpus too. Runs of a document may touch or repeat."""
    if not 0 < q < length < 1 << SPAN_BITS:
        raise ValueError("q must be below length, and length below 65536")
    text = docs.select(KEY, "text").filter(F.octet_length("text") >= length)
    marks = stage(
        text.mapInArrow(_suffix_rows(length, q), f"bucket long, context long, {KEY} long, span long")
        .repartition("bucket").sortWithinPartitions("bucket", "context", KEY, "span")
        .mapInArrow(_settle, f"bucket long, {KEY} long, span long, kind byte"), "marks")
    open_marks = marks.filter("kind = 1")

    def contexts(unsettled):
        need = unsettled.groupBy(KEY).agg(F.collect_list(F.struct("bucket", "span")).alias("need"))
        return docs.join(need, KEY).mapInArrow(
            _merged(_contexts(length)), f"bucket long, {KEY} long, lo long, bytes binary")

    hot = stage(open_marks.groupBy("bucket").count().filter(F.col("count") > hot_classes).select("bucket"), "hot")
    rows = [marks.filter("kind = 0").select(KEY, "span")]
    if hot.isEmpty():
        small = contexts(open_marks)
    else:
        small = contexts(open_marks.join(hot, "bucket", "left_anti"))
        rows.append(contexts(open_marks.join(hot, "bucket", "left_semi"))
                    .mapInArrow(_single_windows(length), f"window long, {KEY} long, lo long")
                    .repartition("window").sortWithinPartitions("window", KEY, "lo")
                    .mapInArrow(_repeated_windows, f"{KEY} long, span long"))
    rows.append(small.repartition("bucket").sortWithinPartitions("bucket", KEY, "lo")
                .mapInArrow(_refine(length), f"{KEY} long, span long"))
    return functools.reduce(DataFrame.unionByName, rows)


def _removed(spans: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which bytes of a text the spans' windows cover."""
    lo, n = spans >> SPAN_BITS, spans & ((1 << SPAN_BITS) - 1)
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, lo, 1)
    np.add.at(step, lo + n + length - 1, -1)
    return np.cumsum(step[:-1]) > 0


def _kept(length: int, with_text: bool):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            names = batch.schema.names
            texts, spans = batch.column(names.index("text")), batch.column(names.index("spans"))
            n_bytes, n_removed, n_spans, out = [], [], [], []
            for i in range(batch.num_rows):
                raw = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
                gone = runs = 0
                if spans[i].is_valid:
                    cut = _removed(spans[i].values.to_numpy(), len(raw), length)
                    gone = int(cut.sum())
                    runs = int(cut[0]) + int((cut[1:] & ~cut[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~cut].tobytes()
                else:
                    kept = raw
                n_bytes.append(len(raw))
                n_removed.append(gone)
                n_spans.append(runs)
                if with_text:  # a character that lost some of its bytes goes as a whole
                    out.append(kept.decode("utf-8", "ignore") if texts[i].is_valid else None)
                else:
                    out.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("doc_id")), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(out, pa.string()), batch.column(names.index(KEY))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", KEY])
    return run


def remove_repeats(documents: DataFrame, length: int = LENGTH, q: int = Q,
                   hot_classes: int = HOT_CLASSES, output: str = "digest") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs) and ``kept``: the SHA-256 of the remaining bytes (``output=
    "digest"``) or the remaining text (``"text"``; a character that lost some
    of its bytes goes as a whole).

    Matches never cross documents. The order of documents is that of ``keyed``:
    by doc_id, null ids last, equal ids by a hash of the text; rows that
    repeat both doc_id and text are one document. A null text has no bytes,
    and stays null in ``"text"`` output. Other columns are ignored."""
    docs = keyed(documents)
    spans = repeated_spans(docs, length, q, hot_classes).groupBy(KEY).agg(
        F.collect_list("span").alias("spans"))
    joined = docs.join(spans, KEY, "left")
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _kept(length, output == "text"),
        f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept string, {KEY} long")
