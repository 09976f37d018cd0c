"""Texts cut into the words of a subword tokenizer, a block of rows at a time.

The cut follows the two common patterns, byte-level (a blank before a word belongs to it)
and word-end (blanks are dropped, digits stand alone), on arrays of code points.  Distinct
words are met by their hash, so that a tokenizer sees each of them once.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Callable
from functools import cache

import numpy as np

from fieldbook.llm import arrays

SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)
#: Words a worker remembers; beyond this it starts over.
REMEMBERED = 1 << 20

# Unicode's white space.
_BLANKS = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def code_point_kinds() -> np.ndarray:
    """Per code point: blank, letter, number or other; UNSURE where it is unassigned."""
    first = {"L": LETTER, "N": NUMBER}
    kinds = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        kinds[code] = UNSURE if category == "Cn" else first.get(category[0], OTHER)
    kinds[_BLANKS] = SPACE
    return kinds


@cache
def lower_code_points() -> np.ndarray:
    """Lower case per code point; 0 where it is not one code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            lower = chr(code).lower()
            table[code] = ord(lower) if len(lower) == 1 else 0
    return table


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """The block's text, its code points, and row offsets in code points."""
    text = data.tobytes().decode("utf-8", "surrogatepass")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    return text, points, leads[offsets]


def _contractions(points: np.ndarray, kinds: np.ndarray, opens: np.ndarray, offsets: np.ndarray) -> None:
    """Let a lone apostrophe that opens a word take the ending after it, as in 's or 'll."""
    quotes = np.flatnonzero((points == 39) & opens)
    room = offsets[np.searchsorted(offsets, quotes, "right")] - quotes
    quotes, room = quotes[room > 1], room[room > 1]
    one = points[quotes + 1]
    two = points[np.minimum(quotes + 2, len(points) - 1)]
    short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
    long = (
        ((one == ord("r")) & (two == ord("e")))
        | ((one == ord("v")) & (two == ord("e")))
        | ((one == ord("l")) & (two == ord("l")))
    ) & (room > 2)
    for chosen, size in ((short, 1), (long & ~short, 2)):
        at = quotes[chosen]
        opens[at + 1] = False
        ends = at + 1 + size
        opens[ends[ends < len(points)]] = True


def byte_level_words(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words under the byte-level pattern; they cover everything."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = code_point_kinds()[points]
    kinds[kinds == UNSURE] = OTHER  # neither letter nor number, as in the library's pattern
    heads = np.zeros(n + 1, bool)
    heads[offsets] = True
    opens = np.empty(n, bool)
    opens[0] = True
    opens[1:] = (kinds[1:] != kinds[:-1]) | heads[1:n]
    blank = kinds == SPACE
    # The last of some blanks, where a word follows in the row.
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~heads[1:n])
    attached = points[last] == 32
    opens[last] = True
    opens[last[attached] + 1] = False
    _contractions(points, kinds, opens, offsets)
    starts = np.flatnonzero(opens)
    return starts, np.append(starts[1:], n)


def word_end_words(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words under the word-end pattern, on lower-case code points."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = code_point_kinds()[points]
    heads = np.zeros(n + 1, bool)
    heads[offsets] = True
    opens = np.empty(n, bool)
    opens[0] = True
    opens[1:] = (kinds[1:] != kinds[:-1]) | heads[1:n] | (kinds[1:] == NUMBER)
    _contractions(points, kinds, opens, offsets)
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], n)
    word = kinds[starts] != SPACE
    return starts[word], ends[word]


class WordIds:
    """Ids of words, asked for once a word.

    `encode` maps a list of words to all their ids, one after another, and the number of each.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        self._encode = encode
        self._clear()

    def _clear(self) -> None:
        self._known = arrays.Numbers()
        # Ids of all words, and where each word's begin; both have room for more.
        self._ids = np.zeros(1 << 10, np.uint32)
        self._starts = np.zeros(1 << 10, np.int64)

    def _remember(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        n = self._known.count
        begin = int(self._starts[n])
        self._ids = _with_room(self._ids, begin + len(ids))
        self._starts = _with_room(self._starts, n + len(counts) + 1)
        self._ids[begin : begin + len(ids)] = ids
        self._starts[n + 1 : n + 1 + len(counts)] = begin + np.cumsum(counts)
        self._known.add(hashes)

    def of(
        self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words one after another, and the number of ids of each word."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        hashes = arrays.mixed(arrays.range_hashes(arrays.prefix_hashes(points), starts, ends))
        hashes[hashes == 0] = 1
        if self._known.count > REMEMBERED:
            self._clear()
        entry = self._known.find(hashes)
        unknown = np.flatnonzero(entry < 0)
        if len(unknown):
            fresh, first = np.unique(hashes[unknown], return_index=True)
            first = unknown[first]
            spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            self._remember(fresh, *self._encode([text[a:b] for a, b in spans]))
            entry[unknown] = self._known.find(hashes[unknown])
        begin = self._starts[entry]
        counts = self._starts[entry + 1] - begin
        return self._ids[arrays.ranges(begin, counts)], counts


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    """`values`, followed by zeros if there are fewer than `size`."""
    if len(values) >= size:
        return values
    return np.append(values, np.zeros(max(len(values), size - len(values)), values.dtype))


def flat(coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words one after another, and the number of each."""
    counts = np.fromiter(map(len, coded), np.int64, len(coded))
    return np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(counts.sum())), counts
