"""Array views of text: Arrow string columns as byte arrays, word spans and span hashes.

Everything works on slices of bounded size, so that a Python worker's memory follows the slice and not
the partition. A null text counts as an empty one. Bytes of a string column that aren't UTF-8 are read as U+FFFD.
Hashes mix every code before codes are put together, so that no sum or power of a base can cancel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled at once; a longer single document is a slice of its own.
SLICE_BYTES = 1 << 20

_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xC2B2AE3D27D4EB4F)
_U32 = np.uint64(32)

#: The six ASCII white-space bytes separate words.
IS_WORD_BYTE = np.ones(256, bool)
IS_WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False

#: The lowest k bytes of a number.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x ^ (x >> _U32)
    x = x * _MIX
    x = x ^ (x >> _U32)
    x = x * _MIX
    return x ^ (x >> _U32)


def span_hash(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of codes[start:end] for each span: every code is mixed with a key of its place, then all are added and mixed."""
    lens = ends - starts
    if not len(lens):
        return np.zeros(0, np.uint64)
    before = np.cumsum(lens) - lens
    place = np.arange(int(lens.sum())) - np.repeat(before, lens)
    each = mix(codes[place + np.repeat(starts, lens)].astype(np.uint64) + (place.astype(np.uint64) + np.uint64(1)) * _STEP)
    sums = np.zeros(len(lens), np.uint64)
    some = lens > 0
    if some.any():
        sums[some] = np.add.reduceat(each, before[some])
    return mix(sums + lens.astype(np.uint64) * _ODD)


def row_hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of a matrix of codes."""
    out = np.full(len(codes), _STEP, np.uint64)
    for k in range(codes.shape[1]):
        out = mix(out * _ODD + codes[:, k])
    return out


def window_hash(codes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of codes[i : i + width] for each i at which a window fits, put together from halves."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at = None, 0  # out[i] is the hash of codes[i : i + at]
    power, size = mix(codes + _STEP), 1
    while True:
        if width & size:
            out = power if out is None else _join(out, power, at)
            at += size
        if at == width:
            return out[:n]
        power = _join(power, power, size)
        size *= 2


def _join(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
    n = min(len(left), len(right) - by)
    return mix((left[:n] ^ _STEP) * _ODD + right[by : by + n])


def texts(column: pa.Array) -> list[str | None]:
    """The values of a string column."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [b if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.large_binary()).to_pylist()]


def valid(column: pa.Array) -> pa.Array:
    """The column, with bytes that aren't UTF-8 read as U+FFFD."""
    try:
        column.validate(full=True)
        return column
    except pa.ArrowInvalid:
        return pa.array(texts(column), column.type)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_binary(column.type):
        column = valid(column).cast(pa.large_binary())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of values that hold at most limit bytes, or one value."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, j
        i = j


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all values, and the n + 1 places of each value's words among them."""
    inside = IS_WORD_BYTE[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(buf), bool)
    after[:-1] = inside[1:]
    edge = offs[(offs > 0) & (offs < len(buf))]
    before[edge] = False
    after[edge - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each span of bytes. Up to 16 bytes are mixed as two numbers, longer ones go through XXH3."""
    lens = ends - starts
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    lanes = np.ndarray((len(buf) + 9,), "<u8", padded, 0, (1,))  # eight bytes from every place
    low = lanes[starts] & _KEEP[np.minimum(lens, 8)]
    high = lanes[starts + 8 * (lens > 8)] & _KEEP[np.clip(lens - 8, 0, 8)]
    size = lens.astype(np.uint64)
    h = mix(mix(low + _STEP) * _ODD + (high ^ size))
    g = mix(mix(high + _ODD) * _STEP + (low ^ (size << _U32)))
    for i in np.flatnonzero(lens > 16):
        whole = xxhash.xxh3_128_intdigest(buf[starts[i] : ends[i]].tobytes())
        h[i], g[i] = whole & 0xFFFFFFFFFFFFFFFF, whole >> 64
    return h, g


def window_starts(first: np.ndarray, width: int) -> np.ndarray:
    """Places of the words at which a full window of one value starts."""
    room = np.zeros(int(first[-1]) + 1, np.int32)
    full = np.maximum(first[1:] - width + 1, first[:-1])
    np.add.at(room, first[:-1], 1)
    np.add.at(room, full, -1)
    return np.flatnonzero(np.cumsum(room)[:-1] > 0)


def ragged(flat: np.ndarray, at: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """flat[at[i] : at[i] + lens[i]] for each i, one after another."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return flat[np.repeat(at - before, lens) + np.arange(total)]
