"""Words of Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, so UTF-8 text can be cut
without decoding it. Everything works on blocks of whole documents of a few megabytes, so
that memory depends on the block size and the longest document, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Keeps the first n bytes of eight that were loaded little-endian.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x + _M1
    x ^= x >> np.uint64(30)
    x *= _M2
    x ^= x >> np.uint64(27)
    x *= _M3
    x ^= x >> np.uint64(31)
    return x


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each start up to its end."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    length = ends - starts
    h = mix((eight[starts] & _FIRST[np.minimum(length, 8)]) + mix(length.astype(np.uint64)))
    at, rest = np.flatnonzero(length > 8), 8
    while len(at):
        left = length[at] - rest
        h[at] = mix(h[at] * _M2 + (eight[starts[at] + rest] & _FIRST[np.minimum(left, 8)]))
        at, rest = at[left > 8], rest + 8
    return h


class Block:
    """Consecutive documents: their bytes, and where each word and document begins."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, lower: bool = False):
        """data: bytes of the documents; offsets: n + 1 places in it; first: row of the first document."""
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        self.data, self.offsets, self.first, self.n_docs = data, offsets, first, len(offsets) - 1
        inside = _IN_WORD[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins[full] = inside[full]
        last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
        ends[last] = inside[last]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        #: Document d has the words from doc[d] up to doc[d + 1].
        self.doc = np.searchsorted(self.starts, offsets)

    def n_words(self) -> np.ndarray:
        return np.diff(self.doc)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return hash_spans(self.data, self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.doc))

    def room(self, k: int) -> np.ndarray:
        """Whether k words of one document begin at each word."""
        return np.arange(len(self.starts)) + k <= np.repeat(self.doc[1:], np.diff(self.doc))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def blocks(column: pa.Array, lower: bool = False, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The documents of a string or binary column, in order. A null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    _, offs, buf = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Block(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], row, lower)
        row = end
    pa.default_memory_pool().release_unused()  # a worker lives on between tasks


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k values that begin at each place; places near the end get what is there."""
    if not len(h):
        return h
    parts, have = {1: h}, 1
    while have * 2 <= k:
        parts[have * 2] = _pair(parts[have], have)
        have *= 2
    out, length = parts[have], have
    while length < k:
        step = max(p for p in parts if p <= k - length)
        out = _pair(out, length, parts[step])
        length += step
    return out


def _pair(left: np.ndarray, gap: int, right: np.ndarray | None = None) -> np.ndarray:
    right = left if right is None else right
    out = left * _M3
    out[: max(0, len(out) - gap)] += right[gap:]
    return mix(out)


def sliding(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f (minimum or maximum) over the w values from each place on, fewer at the end."""
    out, have = x.copy(), 1
    while have < w:
        step = min(have, w - have)
        if step < len(out):
            out[: len(out) - step] = f(out[: len(out) - step], out[step:])
        have += step
    return out
