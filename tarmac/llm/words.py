"""Words and 64-bit hashes of whole Arrow text columns, computed with numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. A word's hash is a
polynomial of its bytes modulo 2^64 (each byte replaced by a fixed random number), taken from running sums
over the column, so no Python code runs per word. Long columns are cut into runs of whole rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE = np.random.Generator(np.random.PCG64(20260301)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: One odd factor for each place in a shingle.
_PLACE = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them), at least one row and about ``limit`` bytes each.

    NULL counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the number of the first word of each row (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of the first word of each row (one more at the end)."""
    starts, ends, first = word_bounds(data, offsets)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64)), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, repeats included, and the first of each row (one more at the end).

    A row of 1 to k - 1 words has one shingle, its whole sequence; a row without words has none.
    """
    rows, counts = len(first) - 1, np.diff(first)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    row_of = np.repeat(np.arange(rows), counts)
    at = np.flatnonzero(np.arange(len(words)) + k <= first[1:][row_of])
    full = np.zeros(len(at), np.uint64)
    for j in range(k):
        full += padded[at + j] * _PLACE[j]
    owner = row_of[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = counts[short].astype(np.uint64) * _PLACE[63]
        for j in range(k - 1):
            has = counts[short] > j
            whole[has] += padded[first[:-1][short][has] + j] * _PLACE[j]
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        full, owner = np.concatenate([full, whole])[order], owner[order]
    return mix(full), np.searchsorted(owner, np.arange(rows + 1))


def shingles_of(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each row, sorted."""
    for _, data, offsets in chunks(column):
        values, at = shingle_hashes(*word_hashes(data, offsets), k)
        for i in range(len(offsets) - 1):
            yield np.unique(values[at[i] : at[i + 1]])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed numbers, as Spark stores them."""
    return x.view(np.int64)
