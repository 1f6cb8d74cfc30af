"""Integer arrays as compact binary values.

Hashes are exchanged many to a row: a task sorts what it has, splits it by hash
range and sends one row a range.  Differences of sorted values have few
significant bytes, and byte planes let the shuffle's compression see that.
"""

from __future__ import annotations

import struct

import numpy as np


def pack(a: np.ndarray) -> bytes:
    """Byte planes of 64-bit integers, without the leading planes that are zero."""
    planes = np.ascontiguousarray(a.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8).T
    used = max((i + 1 for i in range(8) if planes[i].any()), default=0)
    return struct.pack("<QB", len(a), used) + planes[:used].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    n, used = struct.unpack_from("<QB", raw)
    out = np.zeros((n, 8), dtype=np.uint8)
    if used:
        out[:, :used] = np.frombuffer(raw, dtype=np.uint8, offset=9).reshape(used, n).T
    return out.view("<u8").reshape(n)


def pack_sorted(a: np.ndarray) -> bytes:
    """Like pack, for ascending values."""
    return pack(np.diff(a.astype(np.uint64, copy=False), prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64)


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of ``ranges`` equal hash ranges each hash lies in; ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def runs(*columns: np.ndarray) -> np.ndarray:
    """First index of each run of equal rows in columns sorted alike."""
    n = len(columns[0])
    if not n:
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def run_numbers(first: np.ndarray, n: int) -> np.ndarray:
    """Number of the run of each row."""
    new = np.zeros(n, dtype=np.int64)
    new[first] = 1
    return np.cumsum(new) - 1


def spans(part: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, first, end) of each run of a sorted column."""
    ends = [*runs(part).tolist(), len(part)]
    return [(int(part[i]), i, j) for i, j in zip(ends, ends[1:], strict=False)]
