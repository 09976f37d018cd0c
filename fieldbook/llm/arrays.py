"""Whole columns of text as byte arrays: words, hashes and runs, a block at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text handled at once; what a task holds is some twenty times this.
BLOCK_BYTES = 1 << 20
#: Text whose words are hashed at once: what that needs stays in a processor's cache.
PIECE_BYTES = 1 << 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words made of letters and digits; every byte of a non-ASCII character is one.
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[65:91] = LETTERS[128:] = True

#: Bytes of words between blanks.
BLACK = np.ones(256, bool)
BLACK[[9, 10, 11, 12, 13, 32]] = False

_P = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
_Q = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}


def release() -> None:
    """Give freed memory back: workers live on between tasks, and share an executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A map over batches that leaves no freed memory behind."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from step(batches)
        finally:
            release()

    return run


def tidy_group(step: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a map over groups."""

    def run(group: pa.Table) -> pa.Table:
        try:
            return step(group)
        finally:
            release()

    return run


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64, for i below `count`."""
    if "up" not in _POWERS or len(_POWERS["up"]) < count:
        size = max(count, BLOCK_BYTES + 1)
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:count], _POWERS["down"][:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads low bits to all."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """C with C[e] - C[s] = P**s times the polynomial hash of data[s:e]."""
    up, _ = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of data[start:end], equal for equal content anywhere."""
    _, down = powers(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(
    data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows of about `size` bytes."""
    row = 0
    while row < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), len(offsets) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _pieces(word: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about `size` bytes that do not cut a word."""
    start, n = 0, len(word)
    while start < n:
        end = start + size
        while end < n and word[end] and word[end - 1]:
            rest = np.flatnonzero(~word[end : end + 4096])
            end += int(rest[0]) if len(rest) else 4096
        end = min(end, n)
        yield start, end
        start = end


def words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, hash and row of each word; `data` is lower-cased by the caller.

    `kind` tells which bytes make words.  Words do not cross rows.
    """
    n = len(data)
    inside = kind[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # a row starts here
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:n]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    hashes = np.empty(len(starts), np.uint64)
    done = 0
    for low, high in _pieces(inside, offsets, PIECE_BYTES):
        upto = int(np.searchsorted(starts, high))
        sums = prefix_hashes(data[low:high])
        hashes[done:upto] = range_hashes(sums, starts[done:upto] - low, ends[done:upto] - low)
        done = upto
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, mixed(hashes), rows


def order_of(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order by row and hash; equal pairs in any order."""
    if not len(rows):
        return np.zeros(0, np.int64)
    # One number holds the row and the hash's highest bits, which leave few ties.
    bits = np.uint64(max(1, int(rows.max()).bit_length()))
    lead = rows.astype(np.uint64) << (np.uint64(64) - bits) | hashes >> bits
    order = np.argsort(lead)
    lead = lead[order]
    same = lead[1:] == lead[:-1]
    same &= hashes[order[1:]] != hashes[order[:-1]]
    if same.any():
        # All of a tie: by number of the tie and whole hash.
        tie = np.cumsum(np.append(True, lead[1:] != lead[:-1]))
        tied = np.flatnonzero(np.isin(tie, tie[1:][same]))
        some = order[tied]
        order[tied] = some[np.lexsort((hashes[some], tie[tied]))]
    return order


class Numbers:
    """Distinct 64-bit numbers but 0, told by the order in which they came: open addressing."""

    def __init__(self, keys: np.ndarray | None = None) -> None:
        self.count = 0
        self._allot(10)
        if keys is not None:
            self.add(keys)

    def _allot(self, bits: int) -> None:
        self._bits = bits
        self._keys = np.zeros(1 << bits, np.uint64)
        self._at = np.zeros(1 << bits, np.int32)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_P)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where it is none of them."""
        places = self._home(keys)
        held = self._keys[places]
        found = np.where(held == keys, self._at[places], -1)
        open_ = np.flatnonzero((held != keys) & (held != 0))
        places = places[open_]
        while len(open_):
            places = (places + 1) & (len(self._keys) - 1)
            held, wanted = self._keys[places], keys[open_]
            hit = held == wanted
            found[open_[hit]] = self._at[places[hit]]
            stays = ~hit & (held != 0)
            open_, places = open_[stays], places[stays]
        return found

    def add(self, keys: np.ndarray) -> None:
        """Distinct keys that are not among them yet."""
        bits = self._bits
        while 2 * (self.count + len(keys)) > 1 << bits:
            bits += 1
        if bits > self._bits:
            here = np.flatnonzero(self._keys)
            old, at = self._keys[here], self._at[here]
            self._allot(bits)
            self._put(old, at)
        self._put(keys, np.arange(self.count, self.count + len(keys), dtype=np.int32))
        self.count += len(keys)

    def _put(self, keys: np.ndarray, at: np.ndarray) -> None:
        places = self._home(keys)
        while len(keys):
            free = self._keys[places] == 0
            self._keys[places[free]] = keys[free]  # one of those that meet at a place
            own = self._keys[places] == keys
            self._at[places[own]] = at[own]
            keys, at, places = keys[~own], at[~own], (places[~own] + 1) & (len(self._keys) - 1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each `size` consecutive words, by the first of them."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = hashes[:n].copy()
    for k in range(1, size):
        found *= _Q
        found += hashes[k : k + n]
    return mixed(found)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count of them) for each pair, one after another."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - before, counts)
