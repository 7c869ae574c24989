"""Numpy helpers for whole texts inside tasks: word spans, word and window hashes.

Texts are read straight from Arrow buffers in chunks of whole documents, so a
task's working memory follows the chunk size (or its longest single document).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: bytes that separate words in the white-space rule: space and 0x09-0x0D
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: bytes that separate words in the letters-and-digits rule: ASCII but 0-9, A-Z, a-z
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[b for b in range(128) if not chr(b).isalnum()]] = True
#: A-Z to a-z, other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def give_back() -> None:
    """Returns freed memory to the system; a reused worker would hold it while it idles."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def frugal(run: Callable) -> Callable:
    """A task function over batches that gives memory back when its partition ends."""

    def batches_then_give_back(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return batches_then_give_back


def frugal_group(run: Callable) -> Callable:
    """The same for a function over a group's table."""

    def group(table):
        try:
            return run(table)
        finally:
            give_back()

    return group


def frugal_groups(run: Callable) -> Callable:
    """The same for a function over two tables of a group."""

    def groups(left, right):
        try:
            return run(left, right)
        finally:
            give_back()

    return groups


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator: spreads every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=1)
def _powers_cached(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers_made(n)


def _powers_made(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, U64(_BASE))
    down = np.full(n + 1, U64(_BASE_INV))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


CHUNK = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    return _powers_cached(2 * CHUNK) if n <= 2 * CHUNK else _powers_made(n)


def chunks(text: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole documents of about ``limit`` bytes: (first row, end row, bytes, document offsets).

    Nulls are empty.  A document over the limit is a chunk of its own.
    """
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    n = len(text)
    if n == 0:
        return
    _, offsets, data = text.buffers()[-3:]
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    off = np.frombuffer(offsets, dtype=kind)[text.offset : text.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def word_spans(buf: np.ndarray, starts: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes not in ``gap``, and where each document's words begin."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    inside = ~gap[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[starts] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, starts)


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial hash modulo 2**64; see span_hash."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=U64)
    np.cumsum((buf.astype(U64) + U64(1)) * up[: len(buf)], out=out[1:])
    return out


def span_hash(run: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes s..e, the same wherever they stand."""
    _, down = powers(len(run) - 1)
    h = (run[e] - run[s]) * down[s]
    return mix(h + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_hashes(buf: np.ndarray, starts: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the chunk, and where each document's words begin."""
    s, e, first = word_spans(buf, starts, gap)
    return span_hash(prefix_hash(buf), s, e), first


def equal_spans(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes of ``a`` from ``at_a`` on are those of ``b`` from ``at_b`` on, for each span."""
    if not len(size):
        return np.zeros(0, dtype=bool)
    ends = np.cumsum(size)
    inside = np.arange(int(ends[-1]), dtype=np.int64) - np.repeat(ends - size, size)
    unlike = a[np.repeat(at_a, size) + inside] != b[np.repeat(at_b, size) + inside]
    found = np.concatenate(([0], np.cumsum(unlike)))
    return found[ends] == found[ends - size]


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of aligned hash columns, order-sensitive."""
    out = np.zeros(len(parts[0]), dtype=U64)
    for k, p in enumerate(parts):
        out = mix(out * U64(0x2545F4914F6CDD1D) + p + U64(k + 1))
    return out


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each document, sorted; and where each document's begin.

    A document of 1 to ``size`` - 1 words has one: its whole word sequence.
    """
    n = len(first) - 1
    grams = combine([words[k : len(words) - size + 1 + k] for k in range(size)]) if len(words) >= size else words[:0]
    out, counts = [], np.zeros(n + 1, dtype=np.int64)
    for d in range(n):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= size:
            x = np.sort(grams[a : b - size + 1])
            x = x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x
        elif b > a:
            x = combine([words[i : i + 1] for i in range(a, b)]) ^ U64(b - a)
        else:
            continue
        out.append(x)
        counts[d + 1] = len(x)
    return (np.concatenate(out) if out else words[:0]), np.cumsum(counts)
