"""Token ids of whole texts, unit by unit.

A text is cut into units whose ids do not depend on what stands around them: words, and the white space between them.
The units of a chunk are hashed with numpy, each distinct unit is encoded once a worker, and a document's ids are
gathered by array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from shelfspark.llm import words


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + count], one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return flat[np.arange(total) + np.repeat(starts - before, counts)]


class Units:
    """Ids of units seen, in a table of ``2**bits`` places of which each holds the last unit that fell on it.

    A unit's place follows from its hash. 64 bits of this hash and 32 bits of an independent one, both of its bytes, must agree
    for it to be found. A unit that has lost its place is encoded again when it comes back, so frequent units are held nearly always. Units of more
    than ``LONG`` ids are not held, which bounds the table's memory.
    """

    LONG = 32

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bits: int = 20, kind: type = np.int32):
        """``kind`` holds an id: ``np.uint16`` for vocabularies of up to 65,536 ids."""
        self.encode, self.mask = encode, np.uint64((1 << bits) - 1)
        size = 1 << bits
        self.keys, self.checks = np.zeros(size, np.uint64), np.zeros(size, np.uint32)
        self.starts, self.counts = np.zeros(size, np.int32), np.full(size, -1, np.int8)
        self.flat = np.zeros(6 * size, kind)
        self.used = 0

    def _compact(self, needed: int) -> None:
        """Makes room for ``needed`` ids behind those of held units."""
        if self.used + needed <= len(self.flat):
            return
        live = np.flatnonzero(self.counts >= 0)
        counts = self.counts[live].astype(np.int64)
        ids = gathered(self.flat, self.starts[live].astype(np.int64), counts)
        self.used = len(ids)
        size = max(6 * len(self.keys), 2 * self.used) + needed
        self.flat = np.zeros(size, self.flat.dtype)
        self.flat[: self.used] = ids
        self.starts[live] = np.cumsum(counts) - counts

    def find(self, hashes: np.ndarray, checks: np.ndarray, spell: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``flat`` and number of ids of each unit; ``spell`` gives the bytes of unit i."""
        slot = (hashes & self.mask).astype(np.int64)
        checks = (checks >> np.uint64(32)).astype(np.uint32)
        known = (self.keys[slot] == hashes) & (self.checks[slot] == checks) & (self.counts[slot] >= 0)
        new = np.flatnonzero(~known)
        if not len(new):
            return self.starts[slot].astype(np.int64), self.counts[slot].astype(np.int64)
        order = new[np.lexsort((checks[new], hashes[new]))]
        other = np.ones(len(order), bool)
        other[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
        first = order[other]
        ids, counts = self.encode([spell(i) for i in first.tolist()])
        self._compact(len(ids))
        where, sizes = self.starts[slot].astype(np.int64), self.counts[slot].astype(np.int64)
        self.flat[self.used : self.used + len(ids)] = ids
        begin = self.used + np.cumsum(counts) - counts
        back = np.cumsum(other) - 1
        where[order], sizes[order] = begin[back], counts[back]
        held = counts <= self.LONG
        at = slot[first[held]]
        self.keys[at], self.checks[at] = hashes[first[held]], checks[first[held]]
        self.starts[at], self.counts[at] = begin[held], counts[held]
        self.used += len(ids)
        return where, sizes


def word_ids(column, units: Units) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) where white space separates words and gives no ids itself."""
    for first, data, offsets in words.chunks(column):
        starts, ends, bounds = words.spans(data, offsets)
        hashes, checks = (words.word_hashes(data, starts, ends, seed=seed) for seed in (0, 1))
        where, counts = units.find(hashes, checks, lambda i: data[starts[i] : ends[i]].tobytes())
        ids = gathered(units.flat, where, counts)
        edges = np.concatenate(([0], np.cumsum(counts)))[bounds]
        for i in range(len(offsets) - 1):
            yield first + i, ids[edges[i] : edges[i + 1]]
