"""Words of Arrow text batches as numpy arrays: places, hashes, hashes of runs of words.

All functions work on the UTF-8 bytes of a slice of a batch, without a Python object per word. The
separators are ASCII, and no byte of a longer UTF-8 character is, so bytes give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
LONG_WORD = 64

SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
#: Word bytes of `[^\x20\x09-\x0D]+`.
NON_SPACE = np.ones(256, bool)
NON_SPACE[SPACES] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

U64 = np.uint64
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=U64)
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the n + 1 offsets of its rows. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most `most` bytes, or one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def sliced(column, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets) of the slices of a text column."""
    data, offsets = text_bytes(column)
    for lo, hi in slices(data, offsets, most):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NON_SPACE):
    """(starts, ends, bounds): byte places of the words; words bounds[i]:bounds[i + 1] are of row i."""
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin, end = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
        first[begin] = inside[begin]
        last[end] = inside[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit; overwrites x."""
    x ^= x >> U64(32)
    x *= U64(0xE9846AF9B1A615D)
    x ^= x >> U64(32)
    x *= U64(0xE9846AF9B1A615D)
    x ^= x >> U64(28)
    return x


def xxhash64(numbers: np.ndarray) -> np.ndarray:
    """`F.xxhash64` of whole numbers of 64 bits."""
    p1, p2, p3, p4, p5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: x << U64(n) | x >> U64(64 - n)
    with np.errstate(over="ignore"):
        h = (U64(42) + p5 + U64(8)) ^ turn(numbers.view(U64) * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h = (h ^ h >> U64(33)) * p2
        h = (h ^ h >> U64(29)) * p3
        return (h ^ h >> U64(32)).view(np.int64)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, way: int = 0) -> np.ndarray:
    """64-bit hashes of the words; the two ways are independent. Up to 8 bytes, words of one length
    have no collisions."""
    length = ends - starts
    hashes = length.astype(U64) * U64(_SEEDS[way]) + U64(_BASES[way])
    if not len(starts):
        return hashes
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    longest = int(length.max())
    for at in range(0, min(longest, LONG_WORD), 8):
        some = slice(None) if at == 0 else np.flatnonzero(length > at)
        block = eights[starts[some] + at] & _MASKS[np.minimum(length[some] - at, 8)]
        hashes[some] = mix(hashes[some] ^ block)
    if longest > LONG_WORD:
        for i in np.flatnonzero(length > LONG_WORD):
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=_SEEDS[way])
    return hashes


def hash_runs(hashes: np.ndarray, n: int, way: int = 0) -> np.ndarray:
    """Hash of every n consecutive words, from the words' hashes: len - n + 1 values."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    base = _BASES[way] | 1
    out, size = None, 0
    block, width = hashes, 1  # block[i]: hash of `width` words from i
    while True:
        if n & width:
            if out is None:
                out, size = block, width
            else:  # the run so far stands before this block
                left = out[: len(hashes) - size - width + 1]
                out = left * U64(pow(base, width, 1 << 64)) + block[size : size + len(left)]
                size += width
        if width * 2 > n:
            break
        step = block[width:]
        block = block[: len(step)] * U64(pow(base, width, 1 << 64)) + step
        width *= 2
    return mix(out.copy())


def whole_runs(bounds: np.ndarray, n: int) -> np.ndarray:
    """True for each run start whose n words are of one row; as long as hash_runs' result."""
    total = int(bounds[-1]) - n + 1
    if total <= 0:
        return np.zeros(0, bool)
    ok = np.ones(int(bounds[-1]), bool)
    for i in range(1, n):  # the last n - 1 words of each row begin no run
        end = bounds[1:] - i
        ok[end[end >= bounds[:-1]]] = False
    return ok[:total]


def covered(starts: np.ndarray, n: int, lengths=1, total: int = 0) -> np.ndarray:
    """True for each of `total` words inside a run of n words that begins at any of `starts`, or at
    any of the `lengths` places from it on."""
    change = np.zeros(total + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + lengths - 1 + n, total), -1)
    return np.cumsum(change[:-1]) > 0


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())


def unpack(column, dtype) -> np.ndarray:
    """All values of a column of packed arrays, in order."""
    data, _ = text_bytes(column)
    return np.frombuffer(data if data.ctypes.data % 8 == 0 else data.tobytes(), dtype)
