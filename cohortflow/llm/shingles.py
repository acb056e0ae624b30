"""Word hashes of Arrow text columns in numpy, whole columns at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about so many bytes (or one text, if it is longer).
SLICE = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: One odd multiplier for each place in a shingle, and one for each place in a text.
_PLACES = [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def release() -> None:
    """Give back what Arrow keeps of freed batches: Python workers outlive their tasks, and share an executor's memory."""
    pa.default_memory_pool().release_unused()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a published finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    global _powers, _inverse
    while len(_powers) < n:
        k = len(_powers)
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(_BASE, k, 1 << 64))])
        _inverse = np.concatenate([_inverse, _inverse * np.uint64(pow(_BASE_INV, k, 1 << 64))])
    return _powers[:n], _inverse[:n]


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of values[start:end] for each span, from one running sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] ^ (ends - starts).astype(np.uint64) * _MULT)


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a string column: the first row, the bytes, and the rows' offsets in them. Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of the rows, ASCII letters lower-cased: starts, ends, hashes, and each row's first word (and one more)."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        edge[0] = solid[0]
        edge[1:-1] = solid[1:] & ~solid[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        edge[inner] |= solid[inner]
        stop = np.zeros(len(data) + 1, dtype=bool)
        stop[1:-1] = ~solid[1:] & solid[:-1]
        stop[-1] = solid[-1]
        stop[inner] |= solid[inner - 1]
        starts, ends = np.flatnonzero(edge[:-1]), np.flatnonzero(stop)
    else:
        starts = ends = np.zeros(0, dtype=np.int64)
    hashes = spans_hash(_LOWER[data].astype(np.uint64) + np.uint64(1), starts, ends)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each row's distinct n-word shingles, sorted, and each row's first (and one more).

    A row of fewer words has its whole sequence as its only shingle; one of none has none.
    """
    total, count = len(hashes), np.diff(first)
    if total == 0:
        return hashes, np.zeros(len(first), dtype=np.int64)
    padded = np.concatenate([hashes, np.zeros(n - 1, dtype=np.uint64)])
    h = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        h += padded[k : k + total] * np.uint64(_PLACES[k % len(_PLACES)] | 1)
    h = mix(h)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(per)])
    at = np.repeat(first[:-1] - bounds[:-1], per) + np.arange(bounds[-1])
    h = h[at]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        h[bounds[short]] = mix(spans_hash(hashes, first[short], first[short + 1]) + np.uint64(n))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        h[a:b].sort()
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    new[bounds[:-1][per > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return h[new], kept[bounds]
