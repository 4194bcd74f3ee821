"""Texts of Arrow batches as flat numpy arrays, and hashes of all their substrings.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``. These are ASCII bytes, so splitting
the UTF-8 bytes gives the same words as splitting the characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

# Finaliser of the public MurmurHash3 and two odd multipliers.
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x *= MIX_1
    x ^= x >> np.uint64(33)
    x *= MIX_2
    x ^= x >> np.uint64(33)
    return x


def byte_values() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE_A))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins and the last ends;
    null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each come to about ``most`` bytes. A longer text
    makes a slice of its own, so memory follows the longest text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the index of the first word of each text (and one
    more, the number of words). ``separators`` tells for each byte whether it parts words;
    white space unless given."""
    inside = ~(space_table() if separators is None else separators)[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    begins = np.flatnonzero(begin)
    return begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n + 1, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class Substrings:
    """Polynomial hashes, modulo 2**64, of any substrings of ``values`` from prefix sums."""

    def __init__(self, values: np.ndarray, base: int = BASE_A):
        self.inverse = _powers(pow(base, -1, 1 << 64), len(values))
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers(base, len(values))[:-1], out=self.prefix[1:])

    def between(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.prefix[ends] - self.prefix[begins]) * self.inverse[begins])

    def all_of(self, width: int) -> np.ndarray:
        """Hash of every substring of ``width`` values."""
        n = max(0, len(self.prefix) - width)
        return mixed((self.prefix[width:] - self.prefix[:n]) * self.inverse[:n])


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    return Substrings(byte_values()[data]).between(begins, ends)


def starts_inside(first: np.ndarray, width: int) -> np.ndarray:
    """For texts whose values begin at ``first``: the places where ``width`` values of one
    text begin."""
    n = max(0, int(first[-1]) - width + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.flatnonzero(text[:n] == text[width - 1 : width - 1 + n])


def owners(first: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The text that each place belongs to."""
    return np.searchsorted(first, places, "right") - 1


def covered(n: int, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any of the spans."""
    steps = np.bincount(begins, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of sorted values, the i-th bytes of all values together: the
    high bytes of sorted values repeat and compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(blob: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def repeated(values: np.ndarray) -> np.ndarray:
    """The values that occur twice or more, once each, in order."""
    values = np.sort(values)
    return np.unique(values[1:][values[1:] == values[:-1]])


def is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are among the ordered ones."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values
