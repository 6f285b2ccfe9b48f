"""Vectorised text helpers for Arrow tasks: words, hashes and per-row sums
over blocks of whole texts held as one byte array."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: bytes of text that one block holds; a longer text is a block of its own
BLOCK_BYTES = 1 << 20

_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def blocks(column: pa.Array, budget: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) of consecutive rows; null reads as empty."""
    first, size, texts = 0, 0, []
    for lo in range(0, len(column), 256):       # the batch as Python objects, a part at a time
        for t in column.slice(lo, 256).cast(pa.binary()).to_pylist():
            t = b"" if t is None else t
            if size and size + len(t) > budget:
                yield first, texts
                first, size, texts = first + len(texts), 0, []
            texts.append(t)
            size += len(t) + 1
    if texts:
        yield first, texts


def give_back() -> None:
    """Return freed memory, and the tables of powers, to the system."""
    _powers[:] = [np.ones(1, U64), np.ones(1, U64)]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def tidied(task):
    """``task`` (batches -> batches) that gives freed memory back at its end:
    worker processes are used again, by other stages too."""
    def run(batches):
        yield from task(batches)
        give_back()
    return run


def tidied_group(task):
    """``task`` (table -> table of a group) that gives freed memory back."""
    def run(table):
        out = task(table)
        give_back()
        return out
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, min(8 * len(_powers[0]), BLOCK_BYTES + 4096))
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, U64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p, out=p)
    return _powers


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which ``span_hash`` takes any span."""
    up = powers(len(data) + 1)[0]
    out = np.zeros(len(data) + 1, U64)
    sums = out[1:]      # in place: a block's sums are eight times its bytes
    sums[:] = data
    sums += U64(1)
    sums *= up[: len(data)]
    np.cumsum(sums, out=sums)
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes have equal hashes."""
    down = powers(len(sums))[1]
    raw = (sums[end] - sums[start]) * down[start]
    return mix(raw + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def raw_span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unmixed hashes of data[start:end], to compare spans of one length."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


@dataclass
class Words:
    """Words of a block. ``data`` holds the texts joined by a blank."""

    data: np.ndarray
    row_start: np.ndarray   # first byte of each text
    row_end: np.ndarray
    row: np.ndarray         # of each word
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.row_start)

    def per_row(self, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.row, weight, minlength=self.rows).astype(np.int64)

    def first(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def joined(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(length + 1) - length - 1
    return LOWER[data] if lower else data, start, start + length


def words(texts: list[bytes], separator: np.ndarray = SPACE, lower: bool = False,
          marks: np.ndarray | None = None) -> Words:
    """``marks``: bytes that are a word of their own at the end of a word, after a-z."""
    data, row_start, row_end = joined(texts, lower)
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(separator[data], out=inside[1:])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[0::2], edge[1::2]
    if marks is not None and len(end):
        before = data[np.maximum(end - 2, 0)]
        tail = marks[data[end - 1]] & (end - start > 1) & (before >= 0x61) & (before <= 0x7A)
        start, end = np.concatenate([start, end[tail] - 1]), np.concatenate([end - tail, end[tail]])
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
    row = np.searchsorted(row_start, start, side="right") - 1
    return Words(data, row_start, row_end, row, start, end, span_hash(prefix_hash(data), start, end))


_SEEDS = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every ``size``-word window in a row."""
    n = len(w.row) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    at = np.flatnonzero(w.row[:n] == w.row[size - 1:])
    total = np.zeros(len(at), U64)
    for k in range(size):
        total += w.hash[at + k] * _SEEDS[k]
    return at, mix(total)


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole (short) sequence of word hashes."""
    return mix((h * _SEEDS[: len(h)]).sum(dtype=U64, keepdims=True) + U64(len(h)))[0]


def repeated(key: np.ndarray) -> np.ndarray:
    """True where the key occurs more than once."""
    order = np.argsort(key)
    s = key[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
