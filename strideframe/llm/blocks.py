"""Arrow batches as flat byte blocks: texts, words and rolling hashes without per-row Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes of text that one numpy pass works on; a longer single text is a block of its own.
BLOCK_BYTES = 1 << 20
BASE, LANE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEED = 20240607


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string or binary Arrow column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if int(lengths.sum()) != int(offsets[-1] - offsets[0]):
            data = data[ranges(offsets[:-1], lengths)]
            offsets = starts(lengths)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def starts(lengths) -> np.ndarray:
    """Offsets (one more than rows) of consecutive pieces."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(first, lengths) -> np.ndarray:
    """Concatenated aranges: first[i] .. first[i] + lengths[i]."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(np.asarray(first, np.int64) - (ends - lengths), lengths)
    return out


def cut(offsets, limit=None):
    """Row ranges of at most `limit` bytes, one row at least."""
    n, row = len(offsets) - 1, 0
    limit = limit or BLOCK_BYTES
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop
        row = stop


def blocks(batch, text, limit=None):
    """(first row, bytes, offsets) of each block of a record batch."""
    data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
    for a, b in cut(offsets, limit):
        yield a, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


class Kept(dict):
    """What a worker keeps; never sent with the functions that use it."""

    def __reduce__(self):
        return Kept, ()


_POWERS = Kept()


def powers(base, n) -> np.ndarray:
    """base**i mod 2**64 for i below n; the longest table of a base is kept, up to a few blocks' size."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        out = np.full(max(n, 1), base, np.uint64)
        out[0] = 1
        known = np.multiply.accumulate(out)
        if n <= 4 * BLOCK_BYTES:
            _POWERS[int(base)] = known
    return known[:max(n, 1)]


def inverse(base) -> np.uint64:
    """Inverse of an odd number mod 2**64."""
    return np.uint64(pow(int(base), -1, 1 << 64))


# A fixed random 64-bit value for each byte.
LETTERS = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Prefix hashes of a byte block; any piece of it is then hashed by two look-ups."""

    def __init__(self, data, base=BASE):
        n = len(data)
        self.back = powers(inverse(base), n + 1)
        terms = LETTERS[data]
        terms *= powers(base, n)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.prefix[1:])

    def pieces(self, first, stop):
        """Hash of data[first:stop] for arrays of bounds; equal bytes, equal hash."""
        h = self.prefix[stop] - self.prefix[first]
        h *= self.back[first]
        return h

    def windows(self, size):
        """Hash of each window of `size` bytes."""
        h = self.prefix[size:] - self.prefix[:-size]
        h *= self.back[:len(h)]
        return h


def words(data, offsets, inside) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, stop, words per row) of the maximal runs of bytes with inside[byte]; runs end with their row."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    on = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = on.copy()
    begin[1:] &= ~on[:-1] | edge[1:n]
    end = on.copy()
    end[:-1] &= ~on[1:] | edge[1:n]
    first, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return first, stop, np.diff(np.searchsorted(first, offsets))


def lower_table() -> np.ndarray:
    """Byte to byte: A-Z to a-z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def byte_set(*spans) -> np.ndarray:
    """Flags of 256 bytes that lie outside the given closed spans."""
    out = np.ones(256, bool)
    for a, b in spans:
        out[a:b + 1] = False
    return out


def column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def as_binary(data, lengths):
    """Binary Arrow array of consecutive pieces of a byte buffer."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(starts(lengths)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())
