"""Work on the UTF-8 buffers of Arrow string columns with numpy.

Polynomial hashes are taken modulo 2**64. ``prefix`` holds the sums of ``value[i] * B**i``;
the hash of a range is a difference of two of them times a power of the inverse of ``B``,
so every substring has a hash in constant time. Bytes are replaced by random 64-bit values
first, and results are mixed, so that low bits may be used as well. Such hashes are for windows
of a few hundred values: modulo a power of two, certain long strings of two letters have one
hash for every base. Words, which may be long, are hashed by a random value for each byte and
place instead.
"""

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

# Texts are handled in groups of about so many bytes: arrays of eight bytes per character
# stay small, whatever the size of the Arrow batch.
GROUP_BYTES = 1 << 20

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

# Places of anchors take the low bits of the compared values; the same number everywhere, so
# that equal windows compare equally.
PLACE_BITS = np.uint64(28)

_POWERS = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``INVERSE**i`` for i up to ``n`` at least."""
    if not _POWERS or len(_POWERS["up"]) <= n:
        size = max(2 * n, GROUP_BYTES + 1)
        for name, base in (("up", BASE), ("down", INVERSE)):
            factors = np.full(size + 1, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors)
    return _POWERS["up"], _POWERS["down"]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash over 64-bit values."""
    up, _ = powers(len(values))
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values ``start`` to ``end`` (exclusive), the same wherever they stand."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of every ``k`` consecutive values."""
    if len(values) < k:
        return np.empty(0, dtype=np.uint64)
    prefix = prefix_hashes(values)
    _, down = powers(len(prefix))
    return mix((prefix[k:] - prefix[:-k]) * down[: len(values) - k + 1])


def release():
    """Give memory that is no longer used back to the system.

    Python workers live from task to task and share the memory of their executor; what the
    allocators of Arrow and C keep for later use would add up.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their offsets; a null counts as an empty text."""
    release()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), offsets


def groups(offsets: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive texts of about ``most`` bytes together; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for every text the number of the first of its words.

    Words are runs of bytes other than the six ASCII spaces; they do not cross texts.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    inside = ~SPACES[data[low:high]]
    first = np.zeros(high - low + 1, dtype=bool)
    first[offsets - low] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start = np.flatnonzero(starts) + low
    end = np.flatnonzero(ends) + low + 1
    return start, end, np.searchsorted(start, offsets)


_PLACES = 64
_PLACE_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACED = mix(
    BYTE_VALUES[None, :] + np.arange(1, _PLACES + 1, dtype=np.uint64)[:, None] * _PLACE_STEP
).reshape(-1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of every word; ``lower`` folds A-Z first.

    The sum of one random value for every byte at its place in the word: of a table for the first
    places, of the mixed place and byte behind them.
    """
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):  # piece by piece, for arrays of eight bytes per letter
        j = int(np.searchsorted(end, start[i] + GROUP_BYTES // 8, "right"))
        j = max(j, i + 1)
        length = end[i:j] - start[i:j]
        first = np.cumsum(length) - length
        total = int(length.sum())
        place = np.arange(total) - np.repeat(first, length)
        piece = data[place + np.repeat(start[i:j], length)]
        if lower:
            piece = LOWER[piece]
        values = _PLACED[np.minimum(place, _PLACES - 1) * 256 + piece]
        far = np.flatnonzero(place >= _PLACES)
        if len(far):
            values[far] = mix(BYTE_VALUES[piece[far]] + (place[far].astype(np.uint64) + np.uint64(1)) * _PLACE_STEP)
        out[i:j] = mix(np.add.reduceat(values, first))
        i = j
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span, best = 1, values
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:]) if span else best
        span *= 2
    if span < width:
        rest = width - span
        best = np.minimum(best[: len(values) - width + 1], best[rest:])
    return best


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` grams the place of its least gram, the leftmost of equals.

    Equal windows have their anchor at the same distance from the start, wherever they
    stand: this is what brings equal passages together without comparing all windows.
    """
    if len(grams) < width:
        return np.empty(0, dtype=np.int64)
    place = np.arange(len(grams), dtype=np.uint64)
    if len(grams) >> int(PLACE_BITS):
        raise ValueError("too many grams at once")
    keyed = ((grams >> PLACE_BITS) << PLACE_BITS) | place
    below = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    return (sliding_min(keyed, width) & below).astype(np.int64)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``start[i]`` to ``start[i] + count[i]``, one after another."""
    total = int(count.sum())
    if total == 0:
        return np.empty(0, dtype=np.int64)
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(total)


def text_of(data: np.ndarray, start: int, end: int) -> bytes:
    return data[start:end].tobytes()
