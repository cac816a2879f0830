"""Vectorised views of Arrow text columns, shared by the operators of this subpackage.

A *block* is a run of rows whose UTF-8 bytes lie in one numpy buffer.  All scans below work on whole
blocks: no Python statement runs once per word.  Nulls are read as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text forms a block of its own.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Seeds of the two hashes of a span or window (arbitrary fixed numbers).
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: For each number of bytes, the bits of a lane that they fill.
_FILLED = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) of consecutive runs of rows of a string column."""
    if isinstance(column, pa.ChunkedArray):
        chunks = column.chunks
    else:
        chunks = [column]
    row = 0
    for chunk in chunks:
        if not len(chunk):
            continue
        chunk = pc.fill_null(chunk.cast(pa.large_string()), "")
        offs = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(chunk.buffers()[2], np.uint8) if chunk.buffers()[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(chunk):
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            to = min(to, len(chunk))
            yield row + at, data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
            at = to
        row += len(chunk)


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = 2 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices of about `limit` bytes of the text in a column, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, at = np.concatenate([[0], np.cumsum(size)]), 0
        while at < len(size):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; all other bytes stay."""
    return _LOWER[data]


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the runs of bytes other than 0x20 and 0x09-0x0D, and each row's first word number."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEEDS[0]) -> np.ndarray:
    """A 64-bit hash of the bytes of each span.

    Spans are cut into lanes of eight bytes.  Every lane is mixed with a key of its place (splitmix64 both times), so
    no arithmetic relation between lanes survives; the sum of the lanes is mixed with the length.
    """
    n, size = len(data), ends - starts
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = data
    lanes = np.ndarray(n + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    key = mix(np.array([seed], U64))
    h = mix((lanes[starts] & _FILLED[np.minimum(size, 8)]) ^ key)
    long = np.flatnonzero(size > 8)
    if len(long):
        more = (size[long] - 1) // 8  # lanes after the first
        first = np.cumsum(more) - more
        place = np.arange(int(more.sum())) - np.repeat(first, more) + 1
        at = np.repeat(starts[long], more) + 8 * place
        filled = _FILLED[np.minimum(np.repeat(ends[long], more) - at, 8)]
        h[long] += np.add.reduceat(mix((lanes[at] & filled) ^ mix(place.astype(U64) + key)), first)
    return mix(h ^ size.astype(U64) * U64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, width: int, seed: int = SEEDS[1]) -> np.ndarray:
    """A 64-bit hash of every run of `width` consecutive values of h (those that fit).

    Runs of 1, 2, 4, ... values are joined pair by pair, each time with a mix in between; a window is the join of
    the powers of two that its width is made of.
    """
    n = len(h) - width + 1
    if n < 1:
        return np.zeros(0, U64)
    times = U64(seed | 1)
    step, power, done, out = h, 1, 0, np.full(n, width, U64)
    while True:
        if width & power:
            out = mix(out * times + step[done : done + n])
            done += power
        if 2 * power > width:
            return out
        step = mix(step[:-power] * times + step[power:])
        power *= 2


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the words at which a window of `width` words of one row starts. first: each row's first word number."""
    n = int(first[-1])
    ok = np.ones(max(0, n - width + 1), bool)
    for back in range(1, width):
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return np.flatnonzero(ok)


def rows_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row of each word number."""
    return np.searchsorted(first, at, "right") - 1
