"""Words of whole Arrow batches as spans and 64-bit hashes, without a Python object per word.

Texts stay in Arrow's one UTF-8 buffer. A word is a maximal run of bytes that a 256-entry table
marks; every separator used here is ASCII, so bytes decide as characters would. Hashes are
differences of a running polynomial sum with a random value per byte, brought back to position 0
by the inverse power and then mixed, so equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; keeps the running sums inside a core's cache.
SEGMENT = 1 << 18
#: Bytes of text handed out at a time, unless one text alone is longer.
BLOCK = 1 << 21

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII white space.
NOT_WHITE = ~WHITE
#: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_first : _last + 1] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values, the same in every process."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed & _MASK))


_VALUES = stream(11, 256)
_VALUES_FOLDED = _VALUES[FOLD]
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, SEGMENT + 4096)
        for name, base in (("_powers", _BASE), ("_inverses", _BASE_INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            globals()[name] = np.cumprod(factors)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A hash of each span of ``data``; ``fold`` takes A-Z as a-z. Spans must be in order."""
    out = np.empty(len(starts), np.uint64)
    values = _VALUES_FOLDED if fold else _VALUES
    i = 0
    while i < len(starts):
        begin = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, begin + SEGMENT, side="right")))
        stop = int(ends[j - 1])
        _grow(stop - begin + 1)
        sums = np.empty(stop - begin + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[begin:stop]] * _powers[: stop - begin], out=sums[1:])
        first = starts[i:j] - begin
        out[i:j] = (sums[ends[i:j] - begin] - sums[first]) * _inverses[first]
        i = j
    return mix(out)


def word_spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin in those lists.

    ``bounds`` holds the byte offsets of the texts, one more than there are texts. ``table`` gives
    a byte's class; a word is a run of one class other than 0.
    """
    classes = np.zeros(len(data) + 2, np.uint8)
    classes[1:-1] = table[data]
    edge = classes[1:] != classes[:-1]
    edge[bounds] = True
    starts = np.flatnonzero(edge & (classes[1:] > 0))
    ends = np.flatnonzero(edge & (classes[:-1] > 0))
    return starts, ends, np.searchsorted(starts, bounds)


def text_blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, bounds) over a string column, about ``size`` bytes
    at a time; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, raw = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct, sorted hashes of the runs of ``k`` words; the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(n, k)
    total = np.zeros(n - width + 1, np.uint64)
    for place, factor in enumerate(stream(29, width) | np.uint64(1)):
        total += hashes[place : place + n - width + 1] * factor
    return np.unique(mix(total + np.uint64(width)))
