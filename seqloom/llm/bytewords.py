"""Words and word shingles of Arrow text columns as numpy arrays, without a Python step per word.

A batch of texts is one byte array. Words are runs of bytes of a given class; the hash of a word is
a polynomial over its bytes, taken from running sums, so the cost is a few passes over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at a time; a longer text is handled alone.
BLOCK_BYTES = 1 << 20
WIDTH = 5

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15 | 1)
_letters = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))

#: The white space that separates words, and A-Z onto a-z.
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: Letters of any script in UTF-8: ASCII letters and every byte of a longer sequence.
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = LETTER[128:] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64, at least ``n`` of them."""
    global _powers
    if len(_powers[0]) < n:
        made = []
        for step in (_STEP, _U(pow(int(_STEP), -1, 2**64))):
            grown = np.full(max(n, BLOCK_BYTES + 1), step, _U)
            grown[0] = 1
            made.append(np.multiply.accumulate(grown))
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row bounds) of groups of whole texts; null texts are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def words(raw: np.ndarray, bounds: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and lower-cased 64-bit hash of each word, and the first word of each row (plus the end)."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = member[raw]
    opens = inside[:-1].copy()
    if len(raw):
        after_same = inside[:-2]
        opens[1:] &= ~after_same
        at = bounds[:-1][bounds[:-1] < len(raw)]
        opens[at] = inside[at]
        closes = inside[:-1] & ~inside[1:]
        last = bounds[1:] - 1
        last = last[last >= 0]
        closes[last] = inside[last]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    forward, back = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(_letters[LOWER[raw]] * forward[: len(raw)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * back[starts])  # independent of the place
    return starts, ends, hashes, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, firsts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside a row, and the first of each row (plus the end).

    A row of fewer words has one: the whole sequence. A row without words has none.
    """
    counts = np.diff(firsts)
    total = len(hashes)
    factors = mix(np.arange(1, width + 1, dtype=_U)) | _U(1)
    made = np.zeros(total, _U)
    for k in range(width):
        made[: max(total - k, 0)] += hashes[k:] * factors[k]
    made = mix(made + _U(width))
    short = np.flatnonzero((counts > 0) & (counts < width))
    for row in short:
        own = hashes[firsts[row] : firsts[row + 1]]
        made[firsts[row]] = mix((own * factors[: len(own)]).sum(keepdims=True) + _U(len(own)))[0]
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    keep = np.zeros(total + 1, np.int32)
    has = per_row > 0
    np.add.at(keep, firsts[:-1][has], 1)
    np.add.at(keep, (firsts[:-1] + per_row)[has], -1)
    return made[np.cumsum(keep[:-1]) > 0], np.concatenate(([0], np.cumsum(per_row)))
