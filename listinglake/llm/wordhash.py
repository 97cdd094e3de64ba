"""Words of many texts at once, and hashes of word windows, in numpy.

Works on the UTF-8 bytes of an Arrow batch.  Words are runs of bytes that are not one of
0x20, 0x09-0x0D; all of these are ASCII, so no character is ever cut.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, 2**64, size=n, dtype=np.uint64
    )


# One random value per byte, and one odd multiplier per position within a window.
_BYTE = {seed: _random_words(1000 + seed, 256) for seed in (1, 2)}
_STEP = {1: np.uint64(0xD6E8FEB86659FD93), 2: np.uint64(0xA0761D6478BD642F)}
_WINDOW = {1: np.uint64(0xE7037ED1A0B428DB), 2: np.uint64(0x8EBC6AF09C88C6E3)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    data: np.ndarray  # bytes of all texts
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte behind each word
    first: np.ndarray  # first word of each text, and the number of words at the end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    # A separator put between the texts keeps words of two texts apart.
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = ~SEPARATOR[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets] = False
    start = np.flatnonzero(inside & ~before)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    after = np.flatnonzero((~inside | cut)[1:] & inside[:-1]) + 1
    return Words(data, start, after, np.searchsorted(start, offsets))


def word_hashes(words: Words, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    n = len(words.start)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    length = words.end - words.start
    longest = int(length.max())
    power = np.full(longest, _STEP[seed], dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    # Bytes of the words only, one after another.
    begin = np.cumsum(length) - length
    place = np.arange(int(length.sum()), dtype=np.int64)
    within = place - np.repeat(begin, length)
    values = _BYTE[seed][words.data[within + np.repeat(words.start, length)]]
    values *= power[within]
    return mix(np.add.reduceat(values, begin) + length.astype(np.uint64))


def window_hashes(hashes: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hashes of the k words from each word on; the last k-1 positions are left out.

    Windows may run over the end of a text: the caller drops those.
    """
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    odd = _random_words(2000 + seed, k) | np.uint64(1)
    if k <= 8:
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total += hashes[j : j + n] * odd[j]
        return mix(total)
    # Sums over a window as differences of running sums; all modulo 2**64.
    up = np.full(len(hashes), _WINDOW[seed], dtype=np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    back = np.uint64(pow(int(_WINDOW[seed]), -1, 2**64))
    down = np.full(n, back, dtype=np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    run = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up, out=run[1:])
    return mix((run[k:] - run[:n]) * down)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct k-word shingles over lower-cased words.

    A text of fewer words has its whole sequence as the one shingle; one without words
    has none.
    """
    words = words_of(column, lower=True)
    hashes = word_hashes(words)
    windows = window_hashes(hashes, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(windows[a : b - k + 1]))
        elif b > a:
            odd = _random_words(3000 + b - a, b - a) | np.uint64(1)
            out.append(mix((hashes[a:b] * odd).sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(hashes[:0])
    return out


def span_hashes(
    hashes: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 1
) -> np.ndarray:
    """Hashes of the words from start to before end, for spans of any length."""
    up = np.full(len(hashes) + 1, _WINDOW[seed], dtype=np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    down = np.full(len(hashes) + 1, pow(int(_WINDOW[seed]), -1, 2**64), dtype=np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    run = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=run[1:])
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """The batch in slices of about ``limit`` bytes of text, at least a row each.

    The arrays above take some fifty bytes per byte of text, so slices bound the memory
    of a task by its longest text.
    """
    text = batch.column(column)
    sizes = pa.compute.binary_length(text.cast(pa.large_binary())).fill_null(0)
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at = 0
    while at < len(total):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
