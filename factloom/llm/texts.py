"""Vectorised byte-level view of a batch of UTF-8 texts.

An Arrow string array is one byte buffer and one offset array. Everything here works on those two, for a block of rows at
a time (``blocks`` bounds a block's bytes; a longer text is a block of its own), so there is no Python loop over texts,
words or bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are processed at once.
BLOCK_BYTES = 2 << 20

U64 = np.uint64
#: 0x20 and 0x09-0x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII letters and digits, and every byte of a non-ASCII character
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the rows' offsets in them (rows + 1); a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "") if arr.null_count else arr.cast(pa.large_string())
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def block_views(arr: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = flat(arr)
    for lo, hi in blocks(offsets, limit):
        yield data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, which never cross a row, and the number of runs before each row (rows + 1)."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start, end = member.copy(), member.copy()
    start[1:] &= ~member[:-1] | edge[1:n]
    end[:-1] &= ~member[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(first: np.ndarray) -> np.ndarray:
    """Row of each item, from the number of items before each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def count_by_row(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True bytes of each row."""
    total = np.zeros(len(member) + 1, np.int64)
    np.cumsum(member, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


#: The first n of eight bytes.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)


class SpanHash:
    """64-bit hash of any spans of a block: the sum of their 8-byte pieces, each mixed with its place, mixed with the length."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.pieces = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = (end - start).astype(np.int64)
        count = -(-n // 8)
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(owner)) - first[owner]
        at = start[owner] + 8 * k
        v = self.pieces[at] & _HEAD[np.minimum(end[owner] - at, 8)]
        v = mixed(mixed(v) ^ ((k + 1).astype(U64) * U64(0x9DDFEA08EB382D69)))
        total = np.zeros(len(n), U64)
        some = np.flatnonzero(count)
        if len(some):
            total[some] = np.add.reduceat(v, first[some])
        return mixed(total + n.astype(U64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads a 64-bit value over all bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def hash_of(word: bytes) -> int:
    """SpanHash of one word."""
    data = np.frombuffer(word, np.uint8)
    return int(SpanHash(data)(np.array([0]), np.array([len(data)]))[0])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def squeezed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words joined by one space each: the new bytes, the words' starts and ends in them, and the words before each row."""
    starts, ends, first = runs(~SPACE[data], offsets)
    keep = ~SPACE[data]
    keep[starts[1:] - 1] |= SPACE[data[starts[1:] - 1]]
    if len(starts) and starts[0] > 0:
        keep[starts[0] - 1] = False
    # Words at the start of a row may have the row before right before them; those stay apart by their offsets alone.
    at = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    out = data[keep]
    out = np.where(SPACE[out], np.uint8(0x20), out)
    return out, at[starts], at[ends - 1] + 1 if len(ends) else ends, first


_P1, _P2, _P3, _P4, _P5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U64(n)) | (x >> U64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each span."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    n = len(padded)
    u8 = np.ndarray(n - 7, "<u8", padded, strides=(1,))
    u4 = np.ndarray(n - 3, "<u4", padded, strides=(1,))
    seed64 = np.array([seed], U64)
    h = np.full(len(start), seed64[0] + _P5, U64)
    pos, left = start.astype(np.int64), length.astype(np.int64)
    big = np.flatnonzero(left >= 32)
    if len(big):
        with np.errstate(over="ignore"):
            v = [np.full(len(big), x, U64) for x in (seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
        live, p, rest = np.arange(len(big)), pos[big], left[big]
        while len(live):
            for k in range(4):
                v[k][live] = _round(v[k][live], u8[p[live] + 8 * k])
            p[live] += 32
            rest[live] -= 32
            live = live[rest[live] >= 32]
        x = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            x = (x ^ _round(np.zeros(len(big), U64), v[k])) * _P1 + _P4
        h[big], pos[big], left[big] = x, p, rest
    h += length.astype(U64)
    for _ in range(3):
        if not len(s := np.flatnonzero(left >= 8)):
            break
        h[s] = _rotl(h[s] ^ _round(np.zeros(len(s), U64), u8[pos[s]]), 27) * _P1 + _P4
        pos[s] += 8
        left[s] -= 8
    if len(s := np.flatnonzero(left >= 4)):
        h[s] = _rotl(h[s] ^ (u4[pos[s]].astype(U64) * _P1), 23) * _P2 + _P3
        pos[s] += 4
        left[s] -= 4
    for _ in range(3):
        if not len(s := np.flatnonzero(left >= 1)):
            break
        h[s] = _rotl(h[s] ^ (padded[pos[s]].astype(U64) * _P5), 11) * _P1
        pos[s] += 1
        left[s] -= 1
    h = (h ^ (h >> U64(33))) * _P2
    h = (h ^ (h >> U64(29))) * _P3
    return h ^ (h >> U64(32))
