"""Vectorised work on the bytes of many texts at once.

Spark hands texts to a task as Arrow columns, whose strings lie one after the
other in a single buffer. These helpers see that buffer as one numpy array and
find words, window hashes and counts without a Python loop over rows. Slices
are bounded in bytes, so memory does not follow the number of rows in a batch;
a single text longer than the bound is a slice of its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters a-z, digits and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True
#: All but the blanks of ASCII.
UNBLANK = np.ones(256, bool)
UNBLANK[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power_table(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        have = np.full(max(size, SLICE_BYTES + 2), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
        if size > 32 * SLICE_BYTES:
            _powers[base] = have[: SLICE_BYTES + 2].copy()
    return have[:size]


class Hasher:
    """64-bit hashes of any stretch [start, end) of an array of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        size = len(codes)
        self.sums = np.zeros(size + 1, np.uint64)
        np.multiply(codes, _power_table(_BASE, size), out=self.sums[1:])
        np.cumsum(self.sums[1:], out=self.sums[1:])
        self.back = _power_table(_INVERSE, size + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(out + (end - start).astype(np.uint64))


class Texts:
    """Some texts as one byte array; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first_row: int = 0):
        self.data, self.bounds, self.first_row = data, bounds, first_row

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lower(self) -> "Texts":
        return Texts(LOWER[self.data], self.bounds, self.first_row)

    def hasher(self) -> Hasher:
        return Hasher(BYTE_CODES[self.data])

    def runs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of wanted bytes, within one text each."""
        inside = wanted[self.data]
        edge = np.zeros(len(inside) + 1, np.int8)
        edge[:-1] = inside
        edge[1:] -= inside
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        inner = self.bounds[1:-1]
        inner = np.unique(inner[(inner > 0) & (inner < len(inside))])
        cuts = inner[inside[inner] & inside[inner - 1]] if len(inner) else inner
        if len(cuts):
            starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
        return starts, ends

    def row_of(self, starts: np.ndarray) -> np.ndarray:
        """For sorted positions inside texts: the text that each lies in."""
        return np.searchsorted(self.bounds, starts, side="right") - 1

    def words(self, wanted: np.ndarray) -> "Words":
        starts, ends = self.runs(wanted)
        first = np.searchsorted(starts, self.bounds)
        return Words(self.hasher()(starts, ends), starts, ends, first)


class Words:
    """Words of some texts: hash, byte range; text i has words first[i] to first[i + 1]."""

    def __init__(self, hashes, starts, ends, first):
        self.hashes, self.starts, self.ends, self.first = hashes, starts, ends, first

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` items that lie within a row, and their rows."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    rows = np.repeat(np.arange(len(n)), n)
    ahead = np.cumsum(n) - n
    return np.arange(len(rows)) - ahead[rows] + first[:-1][rows], rows


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a column of strings into slices of at most ``most`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    whole = column.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        upto = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        upto = min(max(upto, row + 1), len(column))
        yield Texts(
            data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row], row
        )
        row = upto


def grouped_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's values; rows may be empty."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
