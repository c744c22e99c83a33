import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerofeat.llm import bpe
from aerofeat.llm.registry import op13_bpe

SF001 = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def numbers(ids):
    return np.frombuffer(bytes(ids), "<u4").tolist()


def brute_merge(v, symbols):
    rank = dict(zip(v.pairs.tolist(), v.ranks.tolist()))
    symbols = list(symbols)
    while True:
        found = [(rank[p], i) for i in range(len(symbols) - 1) if (p := symbols[i] * v.n + symbols[i + 1]) in rank]
        if not found:
            return symbols
        r, i = min(found)
        symbols[i:i + 2] = [int(v.merged[r])]


def test_rows_merge_like_one_pair_at_a_time():
    v = bpe.read_vocabulary(WORDS)
    rnd = random.Random(2)
    letters = [int(v.first[ord(c)]) for c in "aehinorst"]
    for width in (1, 2, 3, 4, 7, 8, 33, 64):
        rows = [[rnd.choice(letters) for _ in range(rnd.randrange(width + 1))] for _ in range(200)]
        got = bpe.merge_rows(v, np.array([r + [-1] * (width - len(r)) for r in rows], np.int64).reshape(200, width))
        assert [[x for x in g if x >= 0] for g in got.tolist()] == [brute_merge(v, r) for r in rows]


def odd_texts():
    rnd = random.Random(1)
    every = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    parts = ["a", "'s", "<|endoftext|>", "<|startoftext|>", "<|", " ", "\x1c", "\x85", " ", "́", "é", "İ", "Σ", "1", "²", "!!", "the", "'LL"]
    return ["".join(map(chr, rnd.choices(every, k=60))) for _ in range(500)] + \
        ["".join(rnd.choice(parts) for _ in range(40)) for _ in range(500)] + \
        ["a" * 5000, "=-" * 3000, "the" * 2000, " ", "", "\x00", "word " * 50_000, "ab" * 300 + " ab" * 300]


def test_equals_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    rows = bpe.encode_documents(df, WORDS, decode=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert numbers(r.ids) == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_latin_texts_are_split_like_the_library_does():
    """Every character below LATIN_END, alone and beside others, by both ways."""
    e = bpe._Encoder(bpe.read_vocabulary(WORDS))
    library = Tokenizer.from_file(WORDS)
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} 'S{chr(c)}'ll" for c in range(bpe.LATIN_END)]
    assert e.latin and not any(e.beyond.search(t) for t in texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [numbers(i) for i in e.encode(texts)] == want
    e.latin = None
    assert [numbers(i) for i in e.encode(texts)] == want


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_decoding_is_an_operator_of_its_own(spark):
    df = spark.createDataFrame([("a", "The <|endoftext|> end"), ("b", None), (None, "x"), ("a", "y"), ("a", "y")], "doc_id string, text string")
    out = bpe.encode_documents(df, WORDS)
    got = sorted(((r.doc_id, r.decoded) for r in bpe.decode_documents(out, WORDS).collect()), key=str)
    assert got == sorted([("a", "the</w> <|endoftext|> end</w>"), ("b", ""), (None, "x</w>"), ("a", "y</w>"), ("a", "y</w>")], key=str)
    loose = spark.createDataFrame([(1, None), (2, bytearray(b"\xff\xff\xff\x00"))], "doc_id int, ids binary")
    assert {r.doc_id: r.decoded for r in bpe.decode_documents(loose, WORDS).collect()} == {1: None, 2: ""}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_documents(df, WORDS, decode=True).collect() == []


def test_pieces_forgotten_between_groups_give_the_same(monkeypatch):
    e = bpe._Encoder(bpe.read_vocabulary(WORDS))
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 3)
    texts = [f"one two{i} three" for i in range(20)]
    library = Tokenizer.from_file(WORDS)
    assert [numbers(e.encode([t])[0]) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_on_given_tables(spark):
    library = Tokenizer.from_file(WORDS)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op13_bpe(spark, SF001).collect()} == want
