"""License scan as an exact set-similarity join of text blocks with templates.

A block (a line, or a sentence of one) matches a template when it holds at
least ``share`` of the template's distinct words. Template words are ordered by
their frequency over all documents, rare first. Then, for a template of n
words that needs m = ceil(share * n) of them:

* prefix: a match holds one of the template's n - m + 1 rarest words, so only
  blocks with such a word are candidates;
* length: a block of fewer than m words cannot match;
* position: after the first shared prefix word, block and template must both
  have enough words left in the order.

Candidates that pass are compared on whole word sets, so every matching block
of every whole text is found. The templates are a stated, fixed-size query
set; documents are scanned in place and nothing is shuffled but the counts of
the templates' words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, WORD_ALNUM, string_slices, word_hashes

SHARE = (90, 100)       # of a template's words that a block must hold

# --- fixed values: phrases and labels of the base scan, templates ------------
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "all-rights-reserved": ["All rights reserved"],
    "apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"],
    "cc-by-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "mit": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
# ---------------------------------------------------------------------------


def _hashes(phrase: str) -> np.ndarray:
    raw = LOWER[np.frombuffer(phrase.encode(), np.uint8)]
    return word_hashes(raw, np.array([0, len(raw)]), WORD_ALNUM)[0]


class Templates:
    """Template words in one table, rare first once counts are known."""

    def __init__(self, templates: dict[str, list[str]], share: tuple[int, int]):
        flat = [(label, np.unique(_hashes(t))) for label, texts in templates.items() for t in texts]
        flat = [(label, words) for label, words in flat if len(words)]
        self.labels = [label for label, _ in flat]
        self.words = np.unique(np.concatenate([w for _, w in flat] or [np.zeros(0, np.uint64)]))
        self.has = np.zeros((len(self.words), len(flat)), bool)
        for j, (_, w) in enumerate(flat):
            self.has[np.searchsorted(self.words, w), j] = True
        self.size = self.has.sum(0)
        self.need = -(-self.size * share[0] // share[1])

    def order(self, counts: np.ndarray) -> None:
        """Rank words by count (ties by hash); mark each template's prefix."""
        self.rank = np.empty(len(self.words), np.int64)
        self.rank[np.lexsort((self.words, counts))] = np.arange(len(self.words))
        self.prefix = np.zeros_like(self.has)
        for j in range(len(self.labels)):
            w = np.flatnonzero(self.has[:, j])
            w = w[np.argsort(self.rank[w])]
            self.prefix[w[:self.size[j] - self.need[j] + 1], j] = True

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word in the table, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        i = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[i] == hashes, i, -1)


def _count(templates: Templates):
    def run(batches):
        import pyarrow as pa
        total = np.zeros(len(templates.words), np.int64)
        for batch in batches:
            for _, buf, off in string_slices(batch.column(0)):
                i = templates.ids(word_hashes(LOWER[buf], off, WORD_ALNUM)[0])
                total += np.bincount(i[i >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])
    return run


def _block_of(buf: np.ndarray, off: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The block of each word: texts are cut at line ends and after . ! ? ;
    that white space follows."""
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    stop = np.isin(buf, np.frombuffer(b".!?;", np.uint8))
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:] = buf == 10
    cut[1:-1] |= stop[:-1] & space[1:]
    cut[off] = True
    return np.cumsum(cut)[start]


def _matches(t: Templates, ids: np.ndarray, block: np.ndarray):
    """(block, template, containment) of every matching pair. ``block`` does
    not fall."""
    n_words = np.bincount(block)
    some = ids >= 0
    pair = np.unique(block[some] * len(t.words) + ids[some]) if some.any() else np.zeros(0, np.int64)
    blocks, words = pair // max(1, len(t.words)), pair % max(1, len(t.words))
    near = np.flatnonzero(t.prefix[words].any(1))
    cand = np.unique(blocks[near])
    for b in cand:
        w = words[np.searchsorted(blocks, b):np.searchsorted(blocks, b, side="right")]
        for j in np.flatnonzero(t.prefix[w].any(0)):
            if n_words[b] < t.need[j]:                               # length
                continue
            first = t.rank[w[t.prefix[w, j]]].min()
            if (t.rank[w] >= first).sum() < t.need[j]:               # position
                continue
            both = int(t.has[w, j].sum())
            if both >= t.need[j]:
                yield int(b), int(j), both / int(t.size[j])


def _scan(t: Templates, phrases: list[tuple[np.ndarray, str]]):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for first, buf, off in string_slices(batch.column(1)):
                low = LOWER[buf]
                h, start, _, text = word_hashes(low, off, WORD_ALNUM)
                n = len(off) - 1
                begin = np.searchsorted(text, np.arange(n + 1))
                n_base, first_word, last_word = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
                base, labels, score = ([set() for _ in range(n)] for _ in range(3))
                for words, label in phrases:
                    m = len(h) - len(words) + 1
                    if m <= 0:
                        continue
                    hit = text[:m] == text[len(words) - 1:]
                    for i, w in enumerate(words):
                        hit &= h[i:i + m] == w
                    at = np.flatnonzero(hit)
                    place = at - begin[text[at]]
                    np.add.at(n_base, text[at], 1)
                    for d, p in zip(text[at], place):
                        first_word[d] = p if first_word[d] < 0 else min(first_word[d], p)
                        last_word[d] = max(last_word[d], p)
                        base[d].add(label)
                        score[d].add(1.0)
                if len(h):
                    block = _block_of(low, off, start)
                    for b, j, found in _matches(t, t.ids(h), block):
                        d = text[np.searchsorted(block, b)]
                        labels[d].add(t.labels[j])
                        score[d].add(found)
                places = [pa.array(x, pa.int64(), mask=x < 0) for x in (first_word, last_word)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(np.diff(begin)), pa.array(n_base), *places,
                     pa.array([",".join(sorted(x)) for x in base]),
                     pa.array([",".join(sorted(x | y)) for x, y in zip(base, labels)]),
                     pa.array([max(x, default=0.0) for x in score], pa.float64())],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan_licenses(documents: DataFrame, templates: dict[str, list[str]] | None = None,
                  share: tuple[int, int] = SHARE, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_base (places where a phrase's words stand
    consecutively), first_word and last_word (their smallest and largest
    start, else null), base_labels, labels (with the templates'; both
    distinct, sorted, comma-joined) and score (the largest containment found; a
    phrase counts 1).

    Words are runs of ASCII letters and digits and of non-ASCII characters,
    A-Z lower-cased. A null text is empty. Every input row gives one row,
    repeated ones too; other columns are ignored."""
    t = Templates(TEMPLATES if templates is None else templates, share)
    docs = documents.select("doc_id", "text")
    got = docs.select("text").mapInArrow(_count(t), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(t.words), np.int64)       # one number for each template word
    for r in got:
        counts[r["word"]] = r["n"]
    t.order(counts)
    spoken = [(_hashes(p), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    id_type = documents.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _scan(t, spoken), f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, "
                          "base_labels string, labels string, score double")
