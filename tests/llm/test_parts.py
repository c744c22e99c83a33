"""Working memory of the hashing steps inside tasks (pipeline, F1)."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from aerofeat.llm import decontaminate, jaccard, langid, repeats
from aerofeat.llm.text import parts


def texts(n: int) -> list[str]:
    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, size))) for size in rng.integers(2, 9, 2000)]
    return [" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(n)]


def model() -> langid.Model:
    column = np.zeros(langid._CODES, np.int16)
    return langid.Model(["de", "en"], column, np.array([0, 1, 2, 3]), [np.ones((1, 2), np.float32)] * 3, np.zeros(2, np.float32))


STEPS = {
    "common": jaccard._common_in_slice(5, 3),
    "features": jaccard._features(5, (80, 100), np.zeros(0, np.uint64), np.zeros(0, np.int64)),
    "sets": jaccard._sets(5),
    "suffixes": repeats._suffix_rows(100, 28),
    "fingerprints": decontaminate._fingerprints([(13, 7)]),
    "language": lambda batches: (langid._scored(b.column(1), np.ones(b.num_rows, bool), model()) for b in batches),
}


@pytest.mark.parametrize("step", STEPS)
def test_working_memory_is_a_few_parts(step):
    docs = texts(2500)                                  # 4.5 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(docs)], names=["_key", "text"])
    for _ in STEPS[step]([batch.slice(0, 200)]):        # tables that are kept between calls
        pass
    tracemalloc.start()
    try:
        for _ in STEPS[step]([batch]):
            pass
        assert tracemalloc.get_traced_memory()[1] < LIMIT[step] << 20
    finally:
        tracemalloc.stop()


LIMIT = {"common": 48, "features": 32, "sets": 32, "suffixes": 48, "fingerprints": 32, "language": 32}      # MB


def test_parts_hold_every_text_once():
    raw = [b"", b"abc", b"", b"d" * 50, b"ef", b""]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got = {}
    for first, part, o in parts(buf, off, 4):
        got |= {first + i: part[o[i]:o[i + 1]].tobytes() for i in range(len(o) - 1)}
    assert [got[i] for i in range(len(raw))] == raw
    assert [first for first, _, _ in parts(buf[:0], np.zeros(2, np.int64))] == [0]


def test_features_do_not_depend_on_the_part(monkeypatch):
    docs = [*texts(40), "", None, "a b", "c " * 4000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(docs))), pa.array(docs)], names=["_key", "text"])

    def rows():
        return [r for b in STEPS["features"]([batch]) for r in b.to_pylist()], \
            [r for b in STEPS["suffixes"]([batch]) for r in b.to_pylist()]

    whole = rows()
    small = jaccard.parts
    monkeypatch.setattr(jaccard, "parts", lambda buf, off: small(buf, off, 500))
    monkeypatch.setattr(repeats, "parts", lambda buf, off: small(buf, off, 500))
    assert rows() == whole and len(whole[0]) == len(docs)
