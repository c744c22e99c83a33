"""Byte-pair encoding and decoding with a public tokenizer's vocabulary.

The merges of a word run on a segment tree over its adjacent pairs: a leaf holds
the pair's (rank, place), a node the smaller of its two children, so the root is the
leftmost pair of lowest rank. A merge takes the pair at the root, joins it with its
neighbours and updates three leaves and their paths, until the root holds no pair
that can be merged: n log n steps for n symbols. The trees of many words of one
size are rows of one numpy array and take their steps together.

Normalising and splitting follow the vocabulary file: the tokenizers library's own
steps do both (its Unicode tables are newer than Python's). A text of Latin
characters alone is lower-cased and split by the file's pattern with its classes
spelled out for them, which gives the same pieces sooner.
"""

from __future__ import annotations

import json
import re
import unicodedata
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_PIECES = 400_000     # encoded pieces that a task remembers
ROW_CELLS = 1 << 20        # cells of the trees that are merged together
TEXT_BYTES = 4 << 20       # texts handled at a time
NONE = np.iinfo(np.int64).max
LATIN_END = 0x180          # characters below are their own composed form; lower case, one by one, keeps their class in reach


class Vocabulary(NamedTuple):
    """What a task needs of a vocabulary file; its size is that of the file."""
    tokens: dict           # id → token
    first: np.ndarray      # id of each byte inside a piece
    last: np.ndarray       # id of each byte at a piece's end
    pairs: np.ndarray      # left id * n + right id of each merge, sorted
    ranks: np.ndarray      # its rank
    merged: np.ndarray     # id that the merge of a rank gives
    n: int                 # above all ids
    specials: dict         # text of an added token → id
    steps: str             # normalising and splitting, as the library reads them
    latin: str | None      # the splitting pattern for characters below LATIN_END


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself
    where it is a visible Latin-1 character, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def _latin_pattern(spec: dict) -> str | None:
    """The file's pattern with its Unicode classes spelled out below
    ``LATIN_END``, if its steps are composing, blanks, lower case, and one split."""
    kinds = [s.get("type") for s in (spec["normalizer"] or {}).get("normalizers", [])]
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    if kinds != ["NFC", "Replace", "Lowercase"] or split.get("behavior") != "Removed" or not split.get("invert"):
        return None
    pattern = split["pattern"].get("Regex", "")
    if re.search(r"\\(?![spP])|\\[pP](?!\{[LN]\})", pattern) or r"^\s" not in pattern:
        return None

    def signs(wanted):
        return "".join(f"\\u{c:04x}" for c in range(LATIN_END) if wanted(chr(c)))
    letters, numbers = (signs(lambda c, k=k: unicodedata.category(c)[0] == k) for k in "LN")
    # White_Space below LATIN_END
    spaces = signs(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")
    return pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace(r"\s", spaces)


def read_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a ``tokenizers`` file with a plain byte-level BPE model
    and no decoder of its own; its truncation and padding are not used."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], spec["added_tokens"]
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    byte_level = steps[-1].get("type") == "ByteLevel" and not steps[-1]["add_prefix_space"] and not steps[-1]["use_regex"]
    if not plain or not byte_level or spec["decoder"] or any(
            t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path}: only a plain byte-level BPE model, and added tokens found as they stand, are supported")
    vocab = model["vocab"]
    suffix = model.get("end_of_word_suffix") or ""
    n = max([*vocab.values(), *(t["id"] for t in added)]) + 1
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = np.array([vocab[a] * n + vocab[b] for a, b in merges], np.int64)
    order = np.argsort(pairs)
    # the library's steps, with nothing to look up
    spec = {**spec, "added_tokens": [], "post_processor": None, "truncation": None, "padding": None,
            "model": {**model, "vocab": {}, "merges": []}}
    signs = _byte_signs()
    return Vocabulary(
        {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in added},
        np.array([vocab[c] for c in signs], np.int64), np.array([vocab[c + suffix] for c in signs], np.int64),
        pairs[order], order, np.array([vocab[a + b] for a, b in merges], np.int64), n,
        {t["content"]: t["id"] for t in added}, json.dumps(spec), _latin_pattern(spec))


def _pair_keys(v: Vocabulary, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
    """rank * 2**32 + place of each pair; ``NONE`` without a merge or a neighbour (-1)."""
    pair = left * v.n + right
    at = np.minimum(np.searchsorted(v.pairs, pair), len(v.pairs) - 1)
    return np.where((v.pairs[at] == pair) & (left >= 0) & (right >= 0), (v.ranks[at] << 32) | place, NONE)


def merge_rows(v: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The merges of every row of symbol ids (-1 behind a row's end): the ids
    that are left stand at their first symbols' places, others are -1."""
    rows, width = symbols.shape
    if width < 2 or not len(v.pairs):
        return symbols
    leaves = 1 << (width - 1).bit_length()
    sym = np.full((rows, leaves + 1), -1, np.int64)      # the last column is no symbol's place
    sym[:, :width] = symbols
    after = np.broadcast_to(np.arange(1, leaves + 2), sym.shape).copy()
    after[:, leaves - 1:] = leaves
    before = np.broadcast_to(np.arange(-1, leaves), sym.shape).copy()
    before[:, 0] = leaves
    tree = np.full((rows, 2 * leaves), NONE, np.int64)
    tree[:, leaves:] = _pair_keys(v, sym[:, :leaves], np.take_along_axis(sym, after[:, :leaves], 1), np.arange(leaves))
    level = leaves
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2
    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        root = tree[live, 1]
        place = root & 0xFFFFFFFF
        gone = after[live, place]
        new = v.merged[root >> 32]
        behind = after[live, gone]
        sym[live, place], sym[live, gone] = new, -1
        after[live, place] = behind
        before[live, behind] = place
        ahead = before[live, place]
        at = np.stack([place, ahead, gone], 1)
        keys = np.stack([_pair_keys(v, new, sym[live, behind], place), _pair_keys(v, sym[live, ahead], new, ahead),
                         np.full(len(live), NONE)], 1)
        at[ahead == leaves, 1] = gone[ahead == leaves]     # no neighbour ahead: the leaf that goes, once more
        node, row = at + leaves, live[:, None]
        tree[row, node] = keys
        while node[0, 0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        live = live[tree[live, 1] < NONE]
    return sym[:, :width]


class _Encoder:
    """Texts → ids, in a task."""

    def __init__(self, v: Vocabulary):
        from tokenizers import Tokenizer
        steps = Tokenizer.from_str(v.steps)
        self.v, self.normal, self.split = v, steps.normalizer, steps.pre_tokenizer
        self.special = re.compile("|".join(map(re.escape, sorted(v.specials, key=len, reverse=True)))) if v.specials else None
        self.latin = re.compile(v.latin) if v.latin else None
        self.beyond = re.compile(f"[^\0-{chr(LATIN_END - 1)}]")
        self.known: dict = {}

    def _pieces(self, text: str) -> list:
        """The pieces of a text, and the ids of added tokens between them."""
        out, last = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += [*self._split(text[last:m.start()]), self.v.specials[m[0]]]
            last = m.end()
        return out + self._split(text[last:]) if out else self._split(text)

    def _split(self, part: str) -> list[str]:
        if self.latin and not self.beyond.search(part):
            return self.latin.findall(part.lower())
        part = self.normal.normalize_str(part) if self.normal else part
        return [part[a:b] for _, (a, b) in self.split.pre_tokenize_str(part)]

    def learn(self, pieces: set) -> None:
        """Encode new pieces; those of one size class share an array."""
        sizes: dict[int, list] = {}
        for p in pieces:
            if isinstance(p, int):
                self.known[p] = np.array([p], "<u4").tobytes()
                continue
            raw = p.encode()
            sizes.setdefault(1 << (len(raw) - 1).bit_length() if raw else 0, []).append((p, raw))
        for size, found in sizes.items():
            step = max(1, ROW_CELLS // max(size, 1))
            for i in range(0, len(found), step):
                part = found[i:i + step]
                length = np.array([len(raw) for _, raw in part])
                rows = np.full((len(part), size), -1, np.int64)
                if size:
                    raw = np.frombuffer(b"".join(raw for _, raw in part), np.uint8)
                    rows[np.arange(size) < length[:, None]] = self.v.first[raw]
                    rows[np.arange(len(part)), length - 1] = self.v.last[raw[np.cumsum(length) - 1]]
                    rows = merge_rows(self.v, rows)
                kept = rows >= 0
                flat = rows[kept].astype("<u4").tobytes()
                ends = (np.cumsum(kept.sum(1)) * 4).tolist()
                self.known.update((p, flat[start:end]) for (p, _), start, end in zip(part, [0, *ends], ends))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self._pieces(t) for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known = {}
        new = set().union(*split) - self.known.keys()
        if new:
            self.learn(new)
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]


def _groups(texts: list):
    """Runs of whole texts of about ``TEXT_BYTES``, as (first, last)."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= TEXT_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _encoding(shared, spec, with_text: bool):
    """(…, text) → (…, ids) or, with ``with_text``, (…, ids, decoded)."""
    def run(batches):
        import pyarrow as pa
        encoder = _Encoder(shared.value)
        tokens = shared.value.tokens
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for first, last in _groups(texts):
                ids = encoder.encode([t or "" for t in texts[first:last]])
                out = [*(c.slice(first, last - first) for c in batch.columns[:-1]), pa.array(ids, pa.binary())]
                if with_text:
                    out.append(pa.array([decoded(tokens, i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=spec)
    return run


def decoded(tokens: dict, ids: bytes) -> str:
    """The tokens of the ids, a space between; ids without a token are left out."""
    try:
        return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    except KeyError:
        return " ".join(tokens[i] for i in np.frombuffer(ids, "<u4").tolist() if i in tokens)


def _decoding(shared, spec):
    def run(batches):
        import pyarrow as pa
        tokens = shared.value.tokens
        for batch in batches:
            ids = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                text = None if not ids[i].is_valid else decoded(tokens, ids[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, 1) for c in batch.columns[:-1]), pa.array([text], pa.string())], names=spec)
    return run


def _schema(df: DataFrame, columns: list[str], added: str) -> str:
    return ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns), added])


def encode_documents(documents: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """(``doc_id``, ``n_tokens``, ``ids``) per row of ``documents``; with
    ``decode`` also ``decoded``, the text that the ids give back.

    ``ids`` is binary: little-endian unsigned 32-bit integers, as the tokenizers
    library gives them without special tokens of its own (those that stand in a
    text are found). A null or empty text has no ids. Each row is encoded for
    itself, whatever its id; other columns are ignored. The vocabulary is read
    from ``path`` on the driver and broadcast: its size is that of the file."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    names = ["doc_id", "ids", "decoded"] if decode else ["doc_id", "ids"]
    got = documents.select("doc_id", "text").mapInArrow(
        _encoding(shared, names, decode), _schema(documents, ["doc_id"], "ids binary" + (", decoded string" if decode else "")))
    count = F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens")
    return got.select("doc_id", count, *names[1:])


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(``doc_id``, ``decoded``) of (``doc_id``, ``ids``): null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoding(shared, ["doc_id", "decoded"]), _schema(encoded, ["doc_id"], "decoded string"))
