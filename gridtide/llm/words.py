"""Words and runs of words as numbers, many documents at a time.

Documents of one task are laid end to end in slices of a bounded size, and
everything about their words is worked out with array operations on the slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
# Odd multipliers of the two hash families.
FAMILIES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(maxsize=8)
def _powers(base: int) -> np.ndarray:
    powers = np.full(BLOCK, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def powers_at(base: int, places: np.ndarray) -> np.ndarray:
    """base ** place, from a table of one block and a power for each block."""
    blocks = np.full((int(places.max()) >> BLOCK_BITS) + 1 if len(places) else 1, pow(base, BLOCK, 1 << 64), dtype=np.uint64)
    blocks[0] = 1
    return _powers(base)[places & (BLOCK - 1)] * np.cumprod(blocks, dtype=np.uint64)[places >> BLOCK_BITS]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
    """A hash of values[start:end] for each pair, from one running sum."""
    base = FAMILIES[family]
    total, step, weight = np.zeros(len(values) + 1, dtype=np.uint64), pow(base, BLOCK, 1 << 64), 1
    for at in range(0, len(values), BLOCK):
        part = values[at : at + BLOCK].astype(np.uint64)
        up_to = total[at + 1 : at + 1 + len(part)]
        np.cumsum(part * (_powers(base)[: len(part)] * np.uint64(weight)), out=up_to)
        up_to += total[at]
        weight = weight * step % (1 << 64)
    inverse = powers_at(pow(base, -1, 1 << 64), starts)
    return mixed((total[ends] - total[starts]) * inverse + (ends - starts).astype(np.uint64))


class Slice:
    """Documents laid end to end.

    ``ids`` and ``rows`` identify them; ``first`` has the number of each
    document's first word, and of the word after the last document.
    """

    def __init__(self, ids: list[int], rows: list[int], texts: list[bytes], lower: bool = False):
        self.ids, self.rows = np.array(ids, dtype=np.int64), np.array(rows, dtype=np.int64)
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[1:] = (data != 32) & ((data < 9) | (data > 13))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.sizes = sizes
        self.first = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(sizes)]))
        self.data = data
        self._hashes: dict[int, np.ndarray] = {}

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word_hashes(self, family: int = 0) -> np.ndarray:
        if family not in self._hashes:
            values = self.data.astype(np.uint16) + np.uint16(1)
            self._hashes[family] = range_hashes(values, self.starts, self.ends, family)
        return self._hashes[family]

    def run_starts(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Document number and first word of every run of that many words."""
        docs = np.repeat(np.arange(len(self.ids)), self.counts())
        at = np.arange(len(docs))
        fits = at + length <= self.first[1:][docs]
        return docs[fits], at[fits]

    def run_hashes(self, at: np.ndarray, length: int, family: int = 0) -> np.ndarray:
        return range_hashes(self.word_hashes(family), at, at + length, family)


def in_parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most that many rows: what a batch holds as Arrow data
    should not all be Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def in_slices(
    batches: Iterable[pa.RecordBatch], extra: str | None = None, limit: int = SLICE_BYTES, unique: bool = True
) -> Iterator[tuple]:
    """Lists of ids, rows, texts (and of one more column) of a bounded number
    of bytes; a longer document is a slice of its own. With ``unique``
    documents of a slice stand in the order of (id, row), each pair once."""
    held, size = [], 0
    for batch in in_parts(batches):
        columns = [batch.column(c).to_pylist() for c in ("_id", "_row", "_text", *([extra] if extra else []))]
        for values in zip(*columns, strict=True):
            if held and size + len(values[2]) > limit:
                yield _as_lists(held, unique)
                held, size = [], 0
            held.append(values)
            size += len(values[2])
    if held:
        yield _as_lists(held, unique)


def _as_lists(held: list[tuple], unique: bool) -> tuple:
    if unique:
        once = {v[:2]: v for v in held}
        held = [once[k] for k in sorted(once)]
    return tuple(list(c) for c in zip(*held, strict=True))
