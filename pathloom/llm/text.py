"""Words of many texts at once: numpy over the bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. Texts are taken as UTF-8, so the bytes of
any other character, whatever Unicode calls it, are part of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in groups of about so many bytes; a longer text is a group of its own.
CHUNK_BYTES = 1 << 20
_BLOCK = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BYTE_LOWER = _BYTE[LOWER]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(max(n, _BLOCK + 4096), base, dtype=U64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if len(kept) <= 4 * _BLOCK:
            _powers[base] = kept
    return kept[:n]


class Words:
    """The words of some texts: where they start and end, and which text they are of."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        """`inside` tells which bytes are parts of words, where these are not all but white space."""
        self.buf, self.offsets = buf, offsets
        self.n_docs = len(offsets) - 1
        inside = IS_WORD[buf] if inside is None else inside
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(buf))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Words i of text d: bounds[d] <= i < bounds[d + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of every word, with A-Z taken as a-z or not."""
        return segment_hashes(self.buf, self.starts, self.ends, lower)


def segment_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of every segment; segments are in order and do not overlap."""
    table = _BYTE_LOWER if lower else _BYTE
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + _BLOCK, side="right")))
        n = int(ends[j - 1] - at)
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(table[buf[at : at + n]] * _power(_BASE, n), out=total[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (total[e] - total[s]) * _power(_INVERSE, n + 1)[s]
        i = j
    return mix(out + (ends - starts).astype(U64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` neighbouring hashes, across texts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = np.full(n, size, dtype=U64)
    for k in range(size):
        out = out * U64(_BASE) + hashes[k : k + n]
    return mix(out)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[i] .. starts[i] + lengths[i] - 1 of every i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    skip = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - skip, lengths)


def groups(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of texts of about `limit` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n, i + 60_000)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[d]:bounds[d + 1]]."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def per_set_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of unsigned values[bounds[d]:bounds[d + 1]], modulo 2 ** 64."""
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
