"""Vectorised word splitting and word hashing over Arrow string columns.

All functions work on the UTF-8 bytes of a batch of texts at once, so the
per-word cost is a few numpy passes instead of a Python loop.  Word classes are
given as the set of ASCII bytes that separate words; bytes above 0x7F always
belong to words, which makes byte-wise and character-wise splitting equal.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ``[^\x20\x09-\x0D]+``: words between ASCII white space.
SPACE = bytes([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text: runs of a-z, 0-9 and non-ASCII.
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_ROOT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_UNROOT = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers of the hash root (or of its inverse), grown by doubling."""
    p = _powers[kind]
    if len(p) < n:
        base = int(_ROOT if kind == "up" else _UNROOT)
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        _powers[kind] = p
    return p[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class WordClass:
    """Separator set with its byte tables: word bytes, lower-casing, hash codes."""

    def __init__(self, separators: bytes, lower: bool = True):
        byte = np.arange(256, dtype=np.uint8)
        low = byte.copy()
        if lower:
            low[0x41:0x5B] += 0x20
        self.is_word = np.ones(256, bool)
        self.is_word[np.frombuffer(separators, np.uint8)] = False
        codes = mix64((np.arange(1, 257, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93))
        self.code = np.where(self.is_word, codes[low], np.uint64(0))
        self.low = low


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    large = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if large else np.int32)
    off = off[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def split_words(data: np.ndarray, off: np.ndarray, cls: WordClass):
    """Byte ``starts`` and ``ends`` of all words, and per text the index of its
    first word (n+1 entries)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = cls.is_word[data]
    s = w.copy()
    s[1:] &= ~w[:-1]
    e = w.copy()
    e[:-1] &= ~w[1:]
    b = off[:-1][off[:-1] < off[1:]]  # texts with bytes: a text's edge also ends a word
    s[b] = w[b]
    b = off[1:][off[:-1] < off[1:]] - 1
    e[b] = w[b]
    starts = np.flatnonzero(s)
    return starts, np.flatnonzero(e) + 1, np.searchsorted(starts, off)


def hash_words(data: np.ndarray, starts: np.ndarray, cls: WordClass) -> np.ndarray:
    """64-bit hash of each word (position-independent polynomial of its bytes)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    h = np.add.reduceat(cls.code[data] * _power("up", len(data)), starts)
    return mix64(h * _power("down", len(data))[starts])


def shingle_hashes(h: np.ndarray, first: np.ndarray, k: int):
    """Hashes of every run of ``k`` consecutive words inside a text, with the
    word index each starts at.  Texts with fewer words give none."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        acc = mix64(acc * np.uint64(0x9FB21C651E98DF25) + h[i:n - k + 1 + i] + np.uint64(i + 1))
    ok = np.ones(n - k + 1, bool)
    for i in range(1, k):  # a run may not cross into the next text
        b = first[(first >= i) & (first - i <= n - k)] - i
        ok[b] = False
    at = np.flatnonzero(ok)
    return acc[at], at


def slices(batch: pa.RecordBatch, text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``max_bytes`` of text (one row
    at least), which bounds the numpy temporaries whatever the batch size."""
    _, off = buffers(batch.column(batch.schema.get_field_index(text)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """Append columns; a column of the same name is replaced."""
    keep = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in keep] + list(new.values()),
                                      names=keep + list(new))


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving the freed memory of a task back to
    the system at its end: Python workers are kept for later tasks, beside which
    the JVM needs its own."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library: it keeps what it has

    return wrapped
