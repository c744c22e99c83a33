"""Vectorised text helpers that run inside tasks: Arrow string columns as
byte arrays, words, and 64-bit polynomial hashes of words and of runs.

Texts are handled in slices of a few MB (whole documents, never prefixes), so
the working memory of a task follows the slice, or the one longest document.
"""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 20
PART_BYTES = 1 << 18     # bytes that are hashed at once: each takes some 100 bytes of working memory
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text: digits, a-z and every non-ASCII byte
WORD_ALNUM = np.zeros(256, dtype=bool)
WORD_ALNUM[0x30:0x3A] = True
WORD_ALNUM[0x61:0x7B] = True
WORD_ALNUM[0x80:] = True
# words [^\x20\x09-\x0D]+
WORD_NONSPACE = np.ones(256, dtype=bool)
WORD_NONSPACE[[0x20, 9, 10, 11, 12, 13]] = False

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept between calls)."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _BASE_INV)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer (a bijection of 64-bit values)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """S with S[j] = sum of codes[i] * base**i for i < j."""
    s = np.empty(len(codes) + 1, np.uint64)
    s[0] = 0
    np.cumsum(codes * powers(len(codes))[0], out=s[1:])
    return s


def run_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end], the same wherever the run stands."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


def string_slices(column, max_bytes: int = SLICE_BYTES, max_rows: int = 1 << 16):
    """Cut an Arrow string column into slices of whole texts of about
    ``max_bytes``: yields (first row, bytes, offsets). A null is empty."""
    import pyarrow as pa

    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(off, off[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), first + max_rows, len(column))
        yield first, data[off[first]:off[last]], off[first:last + 1] - off[first]
        first = last


def parts(buf: np.ndarray, offsets: np.ndarray, max_bytes: int = PART_BYTES):
    """Cut texts that lie end to end in ``buf`` into parts of whole texts of
    about ``max_bytes``: yields (first text, bytes, offsets)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_runs(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Words of the texts that lie end to end in ``buf``: (start, end, text
    index) of each; a word never spans two texts."""
    mask = is_word[buf]
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    starts_text = np.zeros(len(buf) + 1, bool)
    starts_text[offsets] = True
    begins = mask.copy()
    begins[1:] &= ~mask[:-1] | starts_text[1:-1]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:] | starts_text[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, start, side="right") - 1
    return start, end, text


def word_hashes(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(hash, start, end, text index) of each word; ``buf`` is lower-cased by
    the caller if wanted."""
    start, end, text = word_runs(buf, offsets, is_word)
    sums = prefix_sums(BYTE_CODE[buf])
    return run_hash(sums, start, end), start, end, text


def gram_hashes(hashes: np.ndarray, text: np.ndarray, k: int):
    """Hash of each run of ``k`` words inside one text: (hash, index of the
    run's first word)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(text[:n] == text[k - 1:])
    return run_hash(prefix_sums(hashes), first, first + k), first
