"""Steps of the text operators over whole blocks: each equals the plain form, in few passes."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from fieldbook.llm import arrays, bpe_automaton, jaccard, pretokens, workload


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return arrays.buffers(pa.array([t.decode() for t in texts]))


def test_rows_and_hashes_are_ordered_as_by_lexsort():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 40, 5000)
    hashes = rng.integers(0, 9, 5000).astype(np.uint64) | rng.integers(0, 3, 5000).astype(np.uint64) << np.uint64(60)
    order, plain = arrays.order_of(rows, hashes), np.lexsort((hashes, rows))
    assert (rows[order] == rows[plain]).all() and (hashes[order] == hashes[plain]).all()
    assert not len(arrays.order_of(rows[:0], hashes[:0]))


def test_shingles_are_distinct_by_row_and_hash_without_a_sort_of_two_keys(monkeypatch):
    random.seed(5)
    texts = [" ".join(random.choice("abc") for _ in range(n)).encode() for n in (0, 1, 4, 5, 60, 400)]
    calls = []
    plain = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: calls.append(1) or plain(keys))
    rows, hashes = jaccard.shingles(*joined(texts))
    pairs = list(zip(rows.tolist(), hashes.tolist(), strict=True))
    assert pairs == sorted(set(pairs)) and not calls
    words = [t.split() for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(s) for s in sets]


def test_numbers_are_found_in_the_order_they_came():
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(1, 1 << 62, 9000).astype(np.uint64))
    rng.shuffle(keys)
    known = arrays.Numbers(keys[:10])
    for low in range(10, 7000, 1990):
        known.add(keys[low : low + 1990])
    n = known.count
    assert known.find(keys[:n]).tolist() == list(range(n))
    assert (known.find(keys[n:]) == -1).all() and len(keys) > n


@pytest.fixture(scope="module")
def vocabulary():
    return Path(workload.BYTE_VOCABULARY).read_text()


def made_up_words(count: int) -> list[bytes]:
    random.seed(7)
    parts = ["th", "e", "an", "ing", " ", "é", "ß", "日本", "tion", "x", "q", "...", "\n", "0", "77", "<|", "’s"]
    words = {"".join(random.choice(parts) for _ in range(random.randint(1, 14))) for _ in range(count)}
    return [w.encode() for w in sorted(words)]


def test_new_words_of_a_block_are_walked_together(monkeypatch, vocabulary):
    automaton = bpe_automaton.Automaton(vocabulary)
    words = [*made_up_words(1500), b"ab" * 40, b"", b"a", b"-" * 500, b"\xff\xfe", *made_up_words(50)]
    expected = [automaton.encode(w) for w in words]
    calls = []
    plain = automaton.encode
    monkeypatch.setattr(automaton, "encode", lambda word: calls.append(word) or plain(word))
    monkeypatch.setattr(bpe_automaton, "MOST_MET", 100)
    ids, counts = automaton.encode_all(words)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == expected
    long = [w for w in words if len(w) > bpe_automaton.WIDE]
    assert len(calls) <= len(long) + 1 + bpe_automaton.FEW
    few, number = automaton.encode_all(words[:3])
    assert few.tolist() == sum(expected[:3], []) and number.tolist() == [len(p) for p in expected[:3]]
    nothing, none = automaton.encode_all([])
    assert not len(nothing) and not len(none)


def test_words_are_asked_for_once_until_too_many_are_remembered(monkeypatch):
    asked = []

    def encode(words):
        asked.extend(words)
        return pretokens.flat([[ord(c) for c in w] for w in words])

    words = pretokens.WordIds(encode)

    def of(text):
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        starts, ends = pretokens.byte_level_words(points, np.array([0, len(points)]))
        ids, counts = words.of(text, points, starts, ends)
        assert ids.tolist() == points.tolist() and counts.tolist() == (ends - starts).tolist()

    of("one two one two three")
    of(" two four" + " five" * 9)
    assert sorted(asked) == sorted(["one", " two", " one", " three", " four", " five"])
    of(" ".join(map(str, range(5000))))
    before = len(asked)
    monkeypatch.setattr(pretokens, "REMEMBERED", 10)
    of(" two four")
    assert len(asked) == before + 2
