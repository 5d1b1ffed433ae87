"""CRC-32 of many byte strings at once, and of their concatenations.

The checksum is linear over bits: that of `ab` is that of `a`, moved on by len(b) zero bytes, XOR that of `b`.
"""

from __future__ import annotations

import zlib

import numpy as np

U32 = np.uint32
#: Bytes of a segment that are taken column by column; the rest of a longer one goes through zlib.
_COLUMNS = 32


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=U32)
    for _ in range(8):
        table = (table >> U32(1)) ^ (table & U32(1)) * U32(0xEDB88320)
    return table


_TABLE = _byte_table()


def _move_tables() -> np.ndarray:
    """[n, k, byte]: what byte k of a checksum becomes by n zero bytes, n to 255."""
    out = np.empty((256, 4, 256), dtype=U32)
    out[0] = np.arange(256, dtype=U32) << (U32(8) * np.arange(4, dtype=U32))[:, None]
    for n in range(1, 256):
        out[n] = (out[n - 1] >> U32(8)) ^ _TABLE[out[n - 1] & U32(255)]
    return out.ravel()


_MOVE = _move_tables()


def moved(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums moved on by so many zero bytes each."""
    step = np.minimum(lengths, 255)
    at = step << 10
    out = _MOVE[at + (crcs & U32(255))] ^ _MOVE[at + 256 + ((crcs >> U32(8)) & U32(255))]
    out ^= _MOVE[at + 512 + ((crcs >> U32(16)) & U32(255))] ^ _MOVE[at + 768 + (crcs >> U32(24))]
    more = np.flatnonzero(lengths > 255)
    if len(more):
        out[more] = moved(out[more], lengths[more] - 255) if len(more) < 64 or int(lengths.max()) < 4096 else [
            _moved_far(int(c), int(n) - 255) for c, n in zip(out[more], lengths[more], strict=True)
        ]
    return out


def _moved_far(crc: int, zeros: int) -> int:
    # zlib turns all bits before and after.
    return zlib.crc32(bytes(zeros), crc) ^ zlib.crc32(bytes(zeros), 0)


def joined(left: np.ndarray, right: np.ndarray, right_lengths: np.ndarray) -> np.ndarray:
    """Checksums of left + right from those of both."""
    return moved(left, right_lengths) ^ right


def segment_crcs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The checksum of every segment of the bytes."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _COLUMNS).astype(np.int16), kind="stable")
    at, size = starts[order], np.minimum(lengths, _COLUMNS)[order]
    crc = np.full(len(at), 0xFFFFFFFF, dtype=U32)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))
        crc[:n] = (crc[:n] >> U32(8)) ^ _TABLE[(crc[:n] ^ buf[at[:n] + k]) & U32(255)]
    out = np.empty(len(at), dtype=U32)
    out[order] = ~crc
    for i in np.flatnonzero(lengths > _COLUMNS).tolist():
        out[i] = zlib.crc32(buf[starts[i] + _COLUMNS : ends[i]], int(out[i]))
    return out
