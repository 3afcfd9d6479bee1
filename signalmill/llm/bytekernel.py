"""Byte-level text kernels shared by the operators that run on Arrow batches.

A batch of texts is one byte buffer with offsets, as Arrow holds it. Words are the
maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z, which is the same
as splitting code points because every UTF-8 continuation byte is above 0x7F. Words and
shingles are named by 64-bit hashes computed with prefix sums, so no Python object is made
per word. Temporary arrays are bounded: a batch is cut into runs of whole documents of about
``CHUNK_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _powers[name] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents whose texts together have about ``limit`` bytes (one document at least)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n + 1 word offsets of the documents."""
    word = ~IS_SPACE[buf]
    first = np.zeros(len(buf) + 1, dtype=bool)
    first[off] = True
    before = np.empty(len(buf), dtype=bool)
    if len(buf):
        before[0] = False
        before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.zeros(len(buf), dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[buf] * _power_table("up", _BASE, len(buf)), out=total[1:])
        h = (total[ends] - total[starts]) * _power_table("down", _BASE_INV, len(buf) + 1)[starts]
        h += (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return mix64(h)


def word_hashes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each lower-cased word, and the n + 1 word offsets of the documents."""
    starts, ends, woff = word_spans(buf, off)
    return span_hashes(LOWER[buf], starts, ends), woff


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of ``x``, ascending, and how often each occurs."""
    x = np.sort(x)
    edge = np.flatnonzero(np.r_[True, x[1:] != x[:-1]][: len(x)])
    return x[edge], np.diff(np.r_[edge, len(x)])


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each value its number among the different ones, ascending, and a place of each different one."""
    by = np.argsort(x)
    x = x[by]
    first = np.r_[True, x[1:] != x[:-1]][: len(x)]
    out = np.empty(len(x), dtype=np.int64)
    out[by] = np.cumsum(first) - 1
    return out, by[first]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive words (over document borders too: the caller skips those)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(m, n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = mix64(h * np.uint64(0x2545F4914F6CDD1D) + words[k : k + m])
    return h


def shingle_sets(buf: np.ndarray, off: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each document's distinct n-word shingles, ascending, and their n + 1 offsets.

    A document of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words, woff = word_hashes(buf, off)
    grams = gram_hashes(words, n)
    sets, sizes = [], np.zeros(len(off), dtype=np.int64)
    for d in range(len(off) - 1):
        a, b = int(woff[d]), int(woff[d + 1])
        if b - a >= n:
            s = np.sort(grams[a : b - n + 1])
            s = s[np.r_[True, s[1:] != s[:-1]]] if len(s) > 1 else s
        else:
            s = gram_hashes(words[a:b], b - a) if b > a else grams[:0]
        sets.append(s)
        sizes[d + 1] = len(s)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum(sizes)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive words, as ``gram_hashes`` but by prefix sums, whose work doesn't grow with n."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * _power_table("up", _BASE, len(words)), out=total[1:])
        h = (total[n:] - total[:m]) * _power_table("down", _BASE_INV, m)
        h += np.uint64(n) * np.uint64(0xA0761D6478BD642F)
    return mix64(h)


def sliding(x: np.ndarray, n: int, f: np.ufunc) -> np.ndarray:
    """``f`` (minimum or maximum) over each n consecutive values."""
    if len(x) < n:
        return x[:0]
    out, span = x, 1
    while 2 * span <= n:
        out, span = f(out[:-span], out[span:]), 2 * span
    return f(out[: len(out) - (n - span)], out[n - span :]) if span < n else out
