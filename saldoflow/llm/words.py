"""Words and word shingles of whole texts as arrays of 64-bit hashes.

A word is a run of bytes other than space and U+0009 to U+000D, with A-Z lower-cased. Texts are read from Arrow
buffers in slices of bounded size, so memory does not grow with a batch; only the hashes of one text are held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
# A worker holds about fifty bytes for each byte of a slice.
SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.ones(256, dtype=bool)
_MARK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits (one to one)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    held = max(_powers, default=0)
    if size <= held <= max(size, 2 * SLICE_BYTES):
        size = held
    else:
        _powers.clear()
        up = np.full(size, _BASE)
        down = np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def fold_latin(data: np.ndarray) -> np.ndarray:
    """Lower-cases the letters U+00C0 to U+00DE in UTF-8 bytes."""
    upper = np.zeros(len(data), dtype=bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return np.where(upper, data + np.uint8(0x20), data)


def _single_signs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the letters in UTF-8 bytes of scripts written without blanks: Han, kana, Thai, Lao, Burmese, Khmer."""
    a, b = data[:-1], data[1:]
    within = lambda low, high: (b >= low) & (b <= high)
    three = ((a >= 0xE4) & (a <= 0xE9) & within(0x80, 0xBF)) | ((a == 0xE3) & (within(0x81, 0x83) | within(0x90, 0xBF))) | ((a == 0xEF) & within(0xA4, 0xAB))
    three |= ((a == 0xE0) & within(0xB8, 0xBB)) | ((a == 0xE1) & (within(0x80, 0x82) | within(0x9E, 0x9F)))
    three, four = np.flatnonzero(three), np.flatnonzero((a == 0xF0) & within(0xA0, 0xB3))
    return np.concatenate([three, four]), np.concatenate([three + 3, four + 4])


def _hash_words(data: np.ndarray, breaks: np.ndarray, fold: bool, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words in ``data``; a word also ends at each offset in ``breaks``."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), empty, empty
    if plain:
        data = fold_latin(data)
        breaks = np.concatenate([breaks, *_single_signs(data)])
    space = (_MARK if plain else _SPACE)[data]
    before = np.empty(n + 1, dtype=bool)
    before[0] = True
    before[1:] = space
    before[breaks[breaks <= n]] = True
    starts = np.flatnonzero(before[:-1] & ~space)
    after = np.empty(n + 1, dtype=bool)
    after[:-1] = space
    after[-1] = True
    after[breaks[breaks <= n]] = True
    ends = np.flatnonzero(after[1:] & ~space) + 1
    up, down = _power_tables(n)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[data] if fold else data) * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts, ends


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and their offsets; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pieces(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes of one text, cut at white space."""
    start = 0
    while start < len(data):
        stop = min(len(data), start + size)
        while stop < len(data):
            blank = np.flatnonzero(_SPACE[data[stop : stop + size]])
            if len(blank):
                stop += int(blank[0])
                break
            stop = min(len(data), stop + size)
        yield start, stop
        start = stop


def word_slices(
    texts: pa.Array, size: int = SLICE_BYTES, fold: bool = True, plain: bool = False
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Yields (first, last, hashes, bounds, starts, ends) for consecutive texts.

    ``hashes[bounds[i]:bounds[i + 1]]`` are the words of text ``first + i``; ``starts`` and ``ends`` are their byte
    offsets in the text. Without ``fold`` the hash tells upper from lower case. With ``plain`` all
    ASCII signs but letters and digits are blanks, Latin letters with marks are lower-cased too, and each letter of a script
    without blanks is a word.
    """
    data, offsets = buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        part = data[offsets[first] : offsets[last]]
        if last == first + 1 and len(part) > size:
            found = [(*_hash_words(part[a:b], np.zeros(0, dtype=np.int64), fold, plain), a) for a, b in _pieces(part, size)]
            hashes = np.concatenate([x[0] for x in found])
            starts = np.concatenate([x[1] + x[3] for x in found])
            ends = np.concatenate([x[2] + x[3] for x in found])
            bounds = np.array([0, len(hashes)])
        else:
            local = offsets[first : last + 1] - offsets[first]
            hashes, starts, ends = _hash_words(part, local, fold, plain)
            bounds = np.searchsorted(starts, local)
            shift = np.repeat(local[:-1], np.diff(bounds))
            starts, ends = starts - shift, ends - shift
        yield first, last, hashes, bounds, starts, ends
        first = last


def shingles(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash at position i covers words i to i + size - 1."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total *= np.uint64(0xA0761D6478BD642F)
        total += words[k : k + n]
    return mix(total)


def shingle_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Yields (index, shingle hashes in order) for every text; a text of one to four words has one shingle of all."""
    for first, last, hashes, bounds, _, _ in word_slices(texts):
        grams = shingles(hashes)
        for i in range(first, last):
            a, b = int(bounds[i - first]), int(bounds[i - first + 1])
            if b - a >= SHINGLE_WORDS:
                yield i, grams[a : b - SHINGLE_WORDS + 1]
            elif b > a:
                yield i, mix(shingles(hashes[a:b], b - a) + np.uint64(b - a))
            else:
                yield i, grams[:0]
