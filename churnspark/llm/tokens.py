"""Words, hashes and shingles of Arrow string columns, vectorised with numpy.

Small helpers for use inside ``mapInArrow`` tasks.  Texts are taken in chunks
of about a megabyte (a longer text is a chunk of its own), so that a task's
memory follows its longest text and not its batch.  Word hashes are polynomial
sums over the UTF-8 bytes modulo 2^64, finished by a 64-bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_STEP = [U64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]

#: Byte classes: 0 for space and U+0009..U+000D, 1 for all others.
SPACE_CLASS = np.ones(256, np.uint8)
SPACE_CLASS[[0x20, 9, 10, 11, 12, 13]] = 0
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i for i < n (kept between calls)."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(size, U64(base), U64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash."""
    x = (x ^ (x >> U64(30))) * _STEP[0]
    x = (x ^ (x >> U64(27))) * _STEP[1]
    return x ^ (x >> U64(31))


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def chunks(column, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0)."""
    data, at = text_bytes(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + max_bytes, "right")) - 1)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = SPACE_CLASS):
    """Maximal runs of one byte class other than 0, within a text:
    (starts, ends, run offsets per text)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = classes[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[offsets[offsets < len(data)]] = True
    b = np.flatnonzero(edge)
    e = np.append(b[1:], len(data))
    m = kind[b] > 0
    starts, ends = b[m], e[m]
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z-lower-cased words, and word offsets per text."""
    starts, ends, at = spans(data, offsets)
    return span_hashes(LOWER[data], starts, ends), at


def grams(h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, and their offsets."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(len(at), np.int64)
    total = np.zeros(n, U64)
    for j in range(k):
        total += h[j:j + n] * _STEP[j % len(_STEP)] ** U64(1 + j // len(_STEP))
    ends = np.repeat(at[1:], np.diff(at))[:n]
    inside = np.flatnonzero(np.arange(n) + k <= ends)
    return mix(total[inside]), np.searchsorted(inside, at)


def shingle_sets(h: np.ndarray, at: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer than k words has
    the whole sequence as one, a text without words none."""
    g, ga = grams(h, at, k)
    out = []
    for i in range(len(at) - 1):
        if ga[i + 1] > ga[i]:
            out.append(np.unique(g[ga[i]:ga[i + 1]]))
        elif at[i + 1] > at[i]:
            whole = h[at[i]:at[i + 1]]
            out.append(grams(whole, np.array([0, len(whole)]), len(whole))[0] ^ U64(len(whole)))
        else:
            out.append(np.zeros(0, U64))
    return out
