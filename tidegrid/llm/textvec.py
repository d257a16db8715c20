"""Vectorised work on the bytes of Arrow string columns: words, hashes and n-grams with NumPy.

Texts are handled in blocks of about ``BLOCK`` bytes, so memory follows the block, or the
longest single text where that is longer, and never the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U64 = np.uint64

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words made of letters: ASCII letters and all bytes of longer UTF-8 sequences.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_HASH = _rng.integers(0, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_factors = np.ones(1, U64)


def factors(n: int) -> np.ndarray:
    """The first ``n`` of a sequence of odd numbers without structure, one for each place."""
    global _factors
    if len(_factors) < n:
        _factors = mix(np.arange(1, max(n, 4096) + 1, dtype=U64) * _STEP) | U64(1)
    return _factors[:n]


def blocks(column: pa.Array, size: int = BLOCK, rows: int = 4096) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + rows, n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 bytes and the offsets of rows among them."""
    first = (data & 0xC0) != 0x80
    if first.all():
        return data.astype(np.uint32), offsets
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(first, out=before[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), before[offsets]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of ``inside`` bytes, none of which crosses rows."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and don't overlap.

    It is a sum of a random number for each byte times one for its place, so the order of bytes in
    words as long as they may be gives no pattern in which sums agree.
    """
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    total = int(lengths.sum())
    base = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=base[1:])
    place = np.arange(total) - np.repeat(base, lengths)
    values = BYTE_HASH[data[place + np.repeat(starts, lengths)]] * factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, base) + lengths.astype(U64) * _STEP)


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width`` consecutive words and their rows, in order of rows.

    A row of fewer words gives its whole sequence as one shingle, a row of none gives none.
    """
    weights = factors(width + 2)[2:]
    counts = np.bincount(rows, minlength=n_rows)
    first = np.zeros(n_rows, np.int64)
    np.cumsum(counts[:-1], out=first[1:])
    found, owners = [], []
    if len(words) >= width:
        whole = rows[: len(rows) - width + 1] == rows[width - 1 :]
        value = np.zeros(len(whole), U64)
        for i in range(width):
            value += words[i : i + len(whole)] * weights[i]
        found.append(mix(value[whole] + U64(width)))
        owners.append(rows[: len(whole)][whole])
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            value = np.full(len(short), n, U64)
            for i in range(n):
                value += words[first[short] + i] * weights[i]
            found.append(mix(value))
            owners.append(short)
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    values, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return values[order], owner[order]


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles (words: between ASCII white space, A-Z lowered)."""
    for _, data, offsets in blocks(column):
        n = len(offsets) - 1
        data = LOWER[data]
        starts, ends, rows = spans(~WHITE[data], offsets)
        values, owner = shingles(span_hashes(data, starts, ends), rows, n, width)
        at = np.searchsorted(owner, np.arange(n + 1))
        for i in range(n):
            yield np.unique(values[at[i] : at[i + 1]])
