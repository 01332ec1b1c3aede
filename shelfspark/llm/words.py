"""Words of whole texts as hash arrays, computed on the UTF-8 bytes of Arrow columns.

A word is ``[^\\x20\\x09-\\x0D]+``. These characters are single bytes in UTF-8, so words are cut at bytes.
Hashes have 64 bits and do not depend on the process, the batch or the place in the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    return _mixed(x + np.uint64((salt * int(_ODD) + 0x1234567) % 2**64))


IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(step: np.uint64, length: int) -> np.ndarray:
    table = _powers.get(str(step))
    if table is None or len(table) < length:
        table = np.full(max(length, _SEGMENT + 1), step, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        if len(table) == _SEGMENT + 1:
            _powers[str(step)] = table
    return table[:length]


def powers(length: int, back: bool = False) -> np.ndarray:
    """Powers of an odd constant, or of its inverse, modulo 2**64."""
    return _power(_BACK if back else _STEP, length)


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``most`` bytes; a longer text is a run of its own.

    Nulls count as empty texts.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if not rows:
        return
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of the first word of each row (one more at the end).

    ``is_word`` tells for each byte whether it belongs to a word.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = is_word[data]
    start, end = word.copy(), np.zeros(size + 1, bool)
    start[1:] &= ~word[:-1]
    end[1:size] = word[:-1] & ~word[1:]
    end[size] = word[-1]
    edge = offsets[(offsets > 0) & (offsets < size)]
    start[edge] = word[edge]
    end[edge] = word[edge - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, seed: int = 0) -> np.ndarray:
    """A hash for each word; another ``seed`` gives another hash, independent of the first.

    A word is cut into blocks of eight bytes. Each block goes through the mixing function together with its place, so
    that no linear relation between words carries over to their sums; the sum is mixed with the word's length.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    begin, end = starts[0], ends[-1]
    padded = np.zeros(end - begin + 8, np.uint8)
    padded[:-8] = _LOWER[data[begin:end]] if lower else data[begin:end]
    blocks = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at, lengths = starts - begin, ends - starts
    salt = np.uint64((seed + 1) * int(_ODD) % 2**64)
    sums = _mixed((blocks[at] & _MASKS[np.minimum(lengths, 8)]) ^ salt)
    long = np.flatnonzero(lengths > 8)
    if len(long):
        more = (lengths[long] - 1) // 8
        first = np.cumsum(more) - more
        place = np.arange(1, int(more.sum()) + 1) - np.repeat(first, more)
        values = blocks[np.repeat(at[long], more) + 8 * place] & _MASKS[np.minimum(np.repeat(lengths[long], more) - 8 * place, 8)]
        values = _mixed(values ^ _mixed(place.astype(np.uint64) * _ODD + salt))
        sums[long] += np.add.reduceat(values, first)
    return _mixed(sums + lengths.astype(np.uint64) * _ODD)


def runs_of(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """A hash for each ``k`` consecutive words: entry i covers words i to i + k - 1."""
    count = len(hashes) - k + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(k):
        total = total * _ODD + hashes[j : j + count]
    return mixed(total, salt + k)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    return np.unique(runs_of(hashes, min(k, len(hashes))))


def rows_of_words(column, lower: bool = False, seed: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every row of a text column."""
    for first, data, offsets in chunks(column):
        starts, ends, bounds = spans(data, offsets)
        hashes = word_hashes(data, starts, ends, lower, seed)
        for i in range(len(offsets) - 1):
            yield first + i, hashes[bounds[i] : bounds[i + 1]]


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's bigint."""
    return np.ascontiguousarray(x).view(np.int64)
