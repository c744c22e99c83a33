"""N-gram Jaccard join as a metric-space join: pivots create Voronoi regions,
triangle-inequality windows replicate boundary documents, regions are joined
exactly and recursively.

The Jaccard distance d(x, y) = 1 - |x & y| / |x | y| is a metric on shingle
sets. With whole documents as pivots almost every document lies at distance
about 1 from every pivot, so the window 2 * eps would copy it into every
region. The pivots here are the sets of one shingle: d(x, {s}) = 1 - 1/|x| for
each s in x, and 1 for all others. Ties are broken by one order of all
shingles, rare before common, so a document lies in the Voronoi region of its
first shingle.

Window. Let d(x, y) <= eps. Then |x - y| <= |x| - ceil((1 - eps) |x|), so the
first pivot that x shares with y is among its first
|x| - ceil((1 - eps) |x|) + 1 pivots, and the same holds for y. Copying each
document into the regions of so many pivots lets every linked pair meet in the
region of its first shared pivot. A document stays in a region only if another
one there is near enough in size.

A linked pair meets more than once: the shared pivots outside both windows come
after the one that ends first, so they are fewer than ceil((1 - eps) |x|) for the
larger x. The pair needs ceil((1 - eps) / (2 - eps) (|x| + |y|)) in all, and the
rest are regions that it shares; pairs that meet in fewer go uncompared.

Inside a region, distances are bounded from below with reference sets that
part the shingle universe (by hash): |x ^ y| is at least the number of reference
sets A with |x & A| odd and |y & A| even or the other way round, since each
shingle in one set alone changes one parity. A linked pair has
|x ^ y| <= (eps / (1 - eps)) min(|x|, |y|). Pairs that pass with few reference
sets (about |x| / 2 of them for large sets) meet the same bound with at least
2 |x|, and those that pass again are compared on their whole sets.

Recursion. Copies that lie near one another are pairs by the square of their
number, of which components need one link each. So a document is compared with
the nearest in a region first (``partners`` of them), and a region in which it has more
is open to it. Components of the links found split such a region, and the
document is compared, under the sharper bound, with ``WIDER`` times as many
outside its component, until none of its regions hold more: pairs inside a
component cannot change the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .keys import KEY, keyed, stage
from .text import LOWER, PART_BYTES, WORD_NONSPACE, gram_hashes, mix, parts, prefix_sums, run_hash, string_slices, word_hashes

K = 3                   # words of a shingle
SHARE = (90, 100)       # linked: share[1] * |x & y| >= share[0] * |x | y|
PARTNERS = 1            # near documents of a region compared before it is split, and
WIDER = 16              # times as many in each round after that
SLICE = 2 << 20         # bytes of texts in which common shingles are looked for
COMMON_IN_SLICE = 3     # documents of one slice that make a shingle a candidate for "common"
COMMON_SHINGLES = 1 << 16  # common shingles that are ordered by count; the others come first, by hash


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = K):
    """Distinct shingles of texts end to end in ``buf``, by text and then
    hash: (hash, text index). A text of fewer words has its whole sequence as
    its one shingle."""
    h, _, _, text = word_hashes(LOWER[buf], offsets, WORD_NONSPACE)
    g, first = gram_hashes(h, text, k)
    d = text[first]
    n_words = np.bincount(text, minlength=len(offsets) - 1)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        at = np.searchsorted(text, short)
        whole = run_hash(prefix_sums(h), at, at + n_words[short])
        g = np.concatenate([g, mix(whole ^ mix(n_words[short].astype(np.uint64)))])
        d = np.concatenate([d, short])
    o = np.argsort(g)
    g, d = g[o], d[o]
    o = np.argsort(d.astype(np.uint16) if len(offsets) <= 65536 else d, kind="stable")
    g, d = g[o], d[o]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
    return g[new], d[new]


def _slices(batches, k, size: int = PART_BYTES):
    for batch in batches:
        names = batch.schema.names
        keys = batch.column(names.index(KEY)).to_numpy()
        for first, buf, off in string_slices(batch.column(names.index("text")), size):
            sets = [(at, shingle_sets(b, o, k)) for at, b, o in parts(buf, off)]
            g = np.concatenate([g for _, (g, _) in sets])
            d = np.concatenate([at + d for at, (_, d) in sets])
            del sets
            yield keys[first:first + len(off) - 1], g, d, np.searchsorted(d, np.arange(len(off)))


def _common_in_slice(k: int, least: int):
    def run(batches):
        import pyarrow as pa
        for _, g, _, _ in _slices(batches, k, SLICE):
            g, n = np.unique(g, return_counts=True)
            many = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(g[many].view(np.int64)), pa.array(n[many])],
                                             names=["shingle", "n"])
    return run


def common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles (sorted hashes, rank by count). They only
    set the order of pivots: any order gives the same links, so slices leave
    out shingles that they hold in fewer than ``COMMON_IN_SLICE`` texts."""
    top = docs.select(KEY, "text").mapInArrow(_common_in_slice(k, COMMON_IN_SLICE), "shingle long, n long") \
        .groupBy("shingle").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "shingle").limit(COMMON_SHINGLES).toPandas()
    h = top["shingle"].to_numpy(np.int64).view(np.uint64)
    rank = len(h) - np.arange(len(h))      # the most frequent last
    o = np.argsort(h)
    return h[o], rank[o]


def _needed(n, share):
    """ceil(share * n)"""
    return -(-n * share[0] // share[1])


def _meetings(larger, smaller, share):
    """The regions that a linked pair of so many shingles shares at least."""
    both = -(-(larger + smaller) * share[0] // (share[0] + share[1]))
    return both - _needed(larger, share) + 1


def _odd(hashes: np.ndarray) -> bytes:
    """A bit for each of 2**j >= 2n reference sets: whether it holds an odd
    number of the n shingles. Folding the upper half onto the lower one by
    exclusive or gives the bits of half as many sets."""
    size = 64
    while size < 2 * len(hashes):
        size *= 2
    odd = np.bincount(((hashes >> np.uint64(8)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(odd: bytes, size: int) -> bytes:
    """The bits of ``size`` reference sets out of those of more."""
    a = np.frombuffer(odd, np.uint64)
    while 64 * len(a) > size:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a.tobytes()


def _few(n: int) -> int:
    """Reference sets used inside regions for a set of n: a power of two near
    n / 2, but for small sets 2n, or 512, where that is more."""
    near = 1 << max(6, int(np.rint(np.log2(max(1, n) / 2))))
    return max(near, min(512, 1 << int(np.ceil(np.log2(max(32, n)))) + 1))


def _differ(x: bytes, y: bytes) -> int:
    """Reference sets that are odd in one and even in the other."""
    size = 8 * min(len(x), len(y))
    a, b = (np.frombuffer(_folded(v, size), np.uint64) for v in (x, y))
    return int(np.bitwise_count(a ^ b).sum())


def _close(share):
    """Pairs with both sides' size and bits → those that pass the bound."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            least = np.minimum(col["na"].to_numpy(), col["nb"].to_numpy()) * (share[1] - share[0]) // share[0]
            ok = [_differ(x.as_py(), y.as_py()) <= m for x, y, m in zip(col["xa"], col["xb"], least)]
            ok = np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(col[c].to_numpy()[ok]) for c in ("a", "b")], names=["a", "b"])
    return run


def _features(k: int, share, common, common_rank):
    def run(batches):
        import pyarrow as pa
        for keys, g, d, at in _slices(batches, k):
            n = np.diff(at)
            sig = np.zeros((2, len(n)), np.uint64)
            some = np.flatnonzero(n)
            if len(g):
                sig[0, some] = np.add.reduceat(mix(g ^ np.uint64(0xA5A5A5A5)), at[some])
                sig[1, some] = np.bitwise_xor.reduceat(mix(g ^ np.uint64(0x5BD1E995)), at[some])
            odd = [_odd(g[b:e]) for b, e in zip(at[:-1], at[1:])]
            rank = np.zeros(len(g), np.int64)
            if len(common):
                i = np.minimum(np.searchsorted(common, g), len(common) - 1)
                rank = np.where(common[i] == g, common_rank[i], 0)
            o = np.argsort(d * (len(common) + 1) + rank, kind="stable")
            place = np.arange(len(g)) - at[d]
            take = place < (n - _needed(n, share) + 1)[d]
            cells = g[o][take]
            off = np.concatenate([[0], np.cumsum(np.bincount(d[take], minlength=len(n)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(n.astype(np.int64)), pa.array(sig[0].view(np.int64)),
                 pa.array(sig[1].view(np.int64)), pa.array([_folded(x, _few(m)) for x, m in zip(odd, n)], pa.binary()),
                 pa.array(odd, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(cells.view(np.int64)))],
                names=[KEY, "n", "sig1", "sig2", "few", "odd", "cells"])
    return run


FEATURES = f"{KEY} long, n long, sig1 long, sig2 long, few binary, odd binary, cells array<long>"


def _near(share, partners: int):
    """Rows sorted by (cell, n, key) → pairs that pass the lower bound, the
    larger document first, with the regions in which they did (``met``) and those
    in which a linked pair does (``least``): for each document that is ``open`` in
    a cell, the nearest ``partners`` of another component. Where it has more, the
    pairs are ``open`` and name the cell. Without these columns, all documents are
    open and components of their own."""
    def gaps(new: list[bytes], held: list[bytes]) -> np.ndarray:
        size = 8 * min(map(len, new + held))
        a, b = (np.frombuffer(b"".join(_folded(x, size) for x in v), np.uint64).reshape(len(v), -1) for v in (new, held))
        out = np.empty((len(a), len(b)), np.int32)
        step = max(1, (1 << 20) // max(1, a.size))
        for c in range(0, len(b), step):
            out[:, c:c + step] = np.bitwise_count(a[:, None] ^ b[None, c:c + step]).sum(2, dtype=np.int32)
        return out

    def run(batches):
        import pyarrow as pa
        cell, keys, ns, few, comps = None, None, None, [], None   # members that may still be near
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            bc, bk, bn = (col[c].to_numpy() for c in ("cell", KEY, "n"))
            bf = col["few"].to_pylist()
            bm = col["component"].to_numpy() if "component" in col else bk
            bo = col["open"].to_numpy(zero_copy_only=False) if "open" in col else np.ones(len(bc), bool)
            out_a, out_b, out_cell, out_open, out_least = [], [], [], [], []
            edges = np.flatnonzero(np.append(True, bc[1:] != bc[:-1]))
            for s, e in zip(edges, np.append(edges[1:], len(bc))):
                if cell != bc[s]:
                    cell = bc[s]
                    keys, ns, few, comps = bk[:0], bn[:0], [], bm[:0]
                for s2 in range(s, e, 128):
                    e2 = min(e, s2 + 128)
                    # members are ordered by size: those too small for this block are too small for the rest
                    fit = int(np.searchsorted(ns, _needed(bn[s2], share)))
                    keys, ns, comps = (np.concatenate([x[fit:], y[s2:e2]]) for x, y in ((keys, bk), (ns, bn), (comps, bm)))
                    few = few[fit:] + bf[s2:e2]
                    if len(keys) == 1 or not bo[s2:e2].any():
                        continue
                    new = np.arange(len(keys) - (e2 - s2), len(keys))
                    gap = gaps(bf[s2:e2], few)
                    ok = (gap <= ns[None] * (share[1] - share[0]) // share[0]) \
                        & (ns[None] >= _needed(ns[new], share)[:, None]) \
                        & (np.arange(len(keys))[None] < new[:, None]) \
                        & (comps[None] != comps[new][:, None]) & bo[s2:e2][:, None]
                    more = ok.sum(1) > partners
                    if more.any():
                        far = np.where(ok[more], gap[more], np.iinfo(gap.dtype).max)
                        best = far.argmin(1)[:, None] if partners == 1 else far.argsort(1, kind="stable")[:, :partners]
                        ok[more] = False
                        ok[np.flatnonzero(more)[:, None], best] = True
                    i, j = np.nonzero(ok)
                    out_a.append(keys[new[i]])
                    out_b.append(keys[j])
                    out_cell.append(np.where(more[i], cell, 0))
                    out_open.append(more[i])
                    out_least.append(_meetings(ns[new[i]], ns[j], share))
            if not out_a:
                continue
            # a pair may share several regions
            rows, met = np.unique(np.stack([np.concatenate(x) for x in (out_a, out_b, out_cell, out_open, out_least)]),
                                  axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0]), pa.array(rows[1]), pa.array(rows[2]), pa.array(rows[3].astype(bool)),
                 pa.array(met), pa.array(rows[4])],
                names=["a", "b", "cell", "open", "met", "least"])

    return run


PAIRS = "a long, b long, cell long, open boolean, met long, least long"


def _met(found: DataFrame) -> DataFrame:
    """The pairs (a, b) that met in as many regions as linked ones do. Where
    ``a`` has more than its partners in a region, not all meetings are
    counted, and its pairs stay."""
    crowded = found.filter("open").select("a", "open").distinct()
    return found.groupBy("a", "b").agg(F.sum("met").alias("met"), F.max("least").alias("least")) \
        .join(crowded, "a", "left").filter("open or met >= least").select("a", "b")


def _sets(k: int):
    def run(batches):
        import pyarrow as pa
        for keys, g, _, at in _slices(batches, k):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(g.view(np.int64)))],
                names=[KEY, "shingles"])
    return run


def _linked(docs: DataFrame, feats: DataFrame, pairs: DataFrame, k: int, share) -> DataFrame:
    """Of candidate pairs (a, b), those whose whole sets are linked."""
    side = lambda c: feats.select(F.col(KEY).alias(c), F.col("n").alias("n" + c), F.col("odd").alias("x" + c))
    pairs = stage(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_close(share), "a long, b long"), "close")
    ids = pairs.select(F.explode(F.array("a", "b")).alias(KEY)).distinct()
    sets = docs.join(ids, KEY, "left_semi").mapInArrow(_sets(k), f"{KEY} long, shingles array<long>")
    both = pairs.join(sets.select(F.col(KEY).alias("a"), F.col("shingles").alias("x")), "a") \
        .join(sets.select(F.col(KEY).alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.withColumn("shared", shared).filter(
        share[1] * F.col("shared") >= share[0] * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b")


def jaccard_components(documents: DataFrame, k: int = K, share: tuple[int, int] = SHARE,
                       partners: int = PARTNERS) -> DataFrame:
    """Per document: (``_key``, doc_id, n_shingles, class_key, component,
    component_id); ``component`` is the smallest key of the component.

    Two documents link when their sets of distinct lower-cased ``k``-word
    shingles have ``share[1] * |x & y| >= share[0] * |x | y|``; component_id is
    the smallest doc_id reachable. Documents of equal sets are one class, and
    ``class_key`` its smallest key; classes are compared, copies are not.

    Documents without words (or text) link with nothing. Rows that repeat
    doc_id and text are one document (see ``keyed``); equal ids with unlike
    texts are documents of their own; a component of null ids alone has a
    null component_id. Other columns are ignored."""
    docs = keyed(documents)
    common, rank = common_shingles(docs, k)
    feats = stage(docs.select(KEY, "text").mapInArrow(_features(k, share, common, rank), FEATURES), "features")
    classes = stage(feats.filter("n > 0").groupBy("n", "sig1", "sig2").agg(F.min(KEY).alias("class_key")), "classes")
    reps = feats.join(classes.select(F.col("class_key").alias(KEY)), KEY, "left_semi")
    region = Window.partitionBy("cell").orderBy("n", KEY)
    members = reps.select(F.explode("cells").alias("cell"), KEY, "n") \
        .withColumn("before", F.lag("n").over(region)).withColumn("after", F.lead("n").over(region)) \
        .filter((share[1] * F.col("before") >= share[0] * F.col("n")) | (share[1] * F.col("n") >= share[0] * F.col("after"))) \
        .select("cell", KEY, "n")
    members = stage(members, "members")       # without their bits, which are most of a row
    found = stage(members.join(feats.select(KEY, "few"), KEY).repartition("cell").sortWithinPartitions("cell", "n", KEY)
                  .select("cell", KEY, "n", "few").mapInArrow(_near(share, partners), PAIRS), "near")
    pairs = stage(_met(found), "pairs")
    links = stage(_linked(docs, feats, pairs, k, share), "links")
    labels = components(links)
    while True:
        opened = found.filter("open").select(F.col("a").alias(KEY), "cell", F.lit(True).alias("open")).distinct()
        if opened.isEmpty():
            break
        partners *= WIDER
        again = members.join(opened.select("cell").distinct(), "cell", "left_semi") \
            .join(labels.withColumnRenamed("node", KEY), KEY, "left") \
            .withColumn("component", F.coalesce("component", KEY))
        split = again.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high")) \
            .filter("low < high").select("cell")
        again = again.join(split, "cell", "left_semi").join(opened, [KEY, "cell"], "left") \
            .join(feats.select(KEY, F.col("odd").alias("few")), KEY) \
            .select("cell", KEY, "n", "few", "component", F.coalesce("open", F.lit(False)).alias("open"))
        found = stage(again.repartition("cell").sortWithinPartitions("cell", "n", KEY)
                      .mapInArrow(_near(share, partners), PAIRS), "near")
        # an unseen pair meets only in regions that were open, so its meetings are counted
        more = stage(_met(found).join(pairs, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            continue
        pairs = pairs.unionByName(more)
        new = stage(_linked(docs, feats, more, k, share), "links")
        if not new.isEmpty():
            links = links.unionByName(new)
            labels = components(links)
    ids = docs.select(KEY, "doc_id")
    of = feats.select(KEY, "n", "sig1", "sig2").join(classes, ["n", "sig1", "sig2"], "left") \
        .join(labels.withColumnRenamed("node", "class_key"), "class_key", "left") \
        .select(KEY, F.col("n").alias("n_shingles"), F.coalesce("class_key", KEY).alias("class_key"),
                F.coalesce("component", "class_key", KEY).alias("component")).join(ids, KEY)
    # keys are in the order of the ids
    least = ids.select(F.col(KEY).alias("component"), F.col("doc_id").alias("component_id"))
    return of.join(least, "component").select(
        KEY, "doc_id", "n_shingles", "class_key", "component", "component_id")
