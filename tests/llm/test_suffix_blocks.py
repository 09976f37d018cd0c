"""Steps of the suffix operator over whole blocks: each equals the plain form, in few passes."""

import random

import numpy as np
import pyarrow as pa
import pytest

from fieldbook.llm import arrays, suffix_dedup


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return arrays.buffers(pa.array([t.decode() for t in texts]))


def test_runs_do_not_depend_on_where_a_text_stands(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 64)
    random.seed(1)
    text = "".join(random.choice("abcdef ") for _ in range(1500)).encode()
    _, first, count, anchor, key, run = suffix_dedup.runs(*joined([text]))
    assert count.sum() == len(text) - suffix_dedup.LENGTH + 1
    for before in ([b"x" * 17], [b"", b"yz " * 33, b"short"]):
        found = suffix_dedup.runs(*joined([*before, text, b"z" * 70]))
        own = found[0] == len(before)
        begin = sum(map(len, before))
        expected = (first + begin, count, anchor + begin, key, run)
        assert all((got[own] == want).all() for got, want in zip(found[1:], expected, strict=True))


@pytest.mark.parametrize("piece", [1 << 15, 100])
def test_suffixes_of_many_groups_are_sorted_with_their_hashes_taken_once(monkeypatch, piece):
    random.seed(2)
    base = "".join(random.choice("ab") for _ in range(300))
    raw = "".join(base[k : k + piece] for k in (random.randrange(250) for _ in range(60))).encode() + b"c" * 60
    data = np.frombuffer(raw, np.uint8)
    sums = arrays.prefix_hashes(data)
    suffixes = np.array(random.sample(range(len(raw) - 50), len(raw) // 2))
    groups = np.array([random.choice([0, 3, 1 << 30, 1 << 41]) for _ in suffixes])
    calls = []
    plain = arrays.range_hashes
    monkeypatch.setattr(arrays, "range_hashes", lambda *args: calls.append(1) or plain(*args))
    order = suffix_dedup.suffix_order(data, sums, suffixes, groups)
    assert len(calls) == 1
    got = [(int(groups[k]), raw[suffixes[k] : suffixes[k] + 50]) for k in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(suffixes)))
    assert got == sorted(got)


def test_entries_are_arranged_by_key_run_and_document():
    random.seed(3)
    entries = np.array(
        [(random.randrange(4) << 45 | 1, random.randrange(6) << random.choice([0, 40]), random.randrange(-3, 9)) for _ in range(900)],
        suffix_dedup._RUN,
    )
    assert entries[suffix_dedup._arranged(entries)].tolist() == sorted(entries.tolist())
