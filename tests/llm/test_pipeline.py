"""Each stage of corpus_pipeline.py, and all of them in a row, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fieldbook.llm import workload
from test_text_operators import BENCH, lowered, shingle_sets
from tests_llm_shapes import ODD_TEXTS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHING = ["component_id", "n_words", "n_hit", "hit_bytes", "n_bytes", "kept_text", "score", "ids", "more"]
N_LABELLED = 400


def documents_rows() -> list[tuple]:
    """(id, text): labelled ones with planted words, then copies, shared bytes, test windows."""
    random.seed(12)
    words = [f"plain{k}" for k in range(300)]

    def prose(n):
        return random.choices(words, k=n)

    rows = []
    for k in range(N_LABELLED):
        own = prose(40)
        if k % 4 == 0:
            own[3], own[20] = random.choice(["vilest", "vileness"]), "vile"
        rows.append((k, " ".join(own)))
    base = prose(80)
    near = [*base[:40], "other", *base[41:]]
    shared = " ".join(prose(15))
    partly = " ".join(prose(20))
    odd = [(2000 + k, text) for k, text in enumerate(ODD_TEXTS)]
    rows += [
        (1003, " ".join(near)), (1001, " ".join(base)), (1002, " ".join(base).upper()),
        (1010, shared + " " + " ".join(prose(20))), (1011, " ".join(prose(20)) + " " + shared), (1012, shared),
        (1013, "é" * 80), (1014, "x" + "é" * 80 + "y"),
        (1020, BENCH[0][1]), (1021, partly + ", " + BENCH[1][1].upper() + "! é"), (1022, BENCH[1][1]),
        (1030, " ".join(prose(30))), (1030, " ".join(prose(30))), (1031, rows[401 - 2][1]),
        (1032, "vile vilest " + " ".join(prose(30))),
        (None, " ".join(base)), (None, shared), (None, None), (None, "vile vileness " + " ".join(prose(30))),
        *odd,
    ]
    return [(k, text, None if n % 3 else "en", "s", len(text or "")) for n, (k, text) in enumerate(rows)]


def not_toxic(rows):
    return [r for r in rows if not re.search(r"\bvile", r[1] or "")]


def firsts(rows):
    sets = [(r[0], s) for r, (_, s) in zip(rows, shingle_sets(enumerate(r[1] for r in rows)), strict=True)]
    known = [(k, s) for k, s in sets if k is not None]
    parent = {k: k for k, _ in known}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for n, (a, of_a) in enumerate(known):
        for b, of_b in known[:n]:
            both = len(of_a & of_b)
            if both and 100 * both >= 75 * len(of_a | of_b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return [r for r in rows if r[0] is None or root(r[0]) == r[0]]


def cut_repeats(rows):
    def key(row):
        return float("inf") if row[0] is None else row[0]

    first: dict = {}
    for row in sorted(rows, key=key):
        raw = (row[1] or "").encode()
        for k in range(len(raw) - 49):
            first.setdefault(raw[k : k + 50], key(row))
    out = []
    for row in rows:
        text, raw = row[1] or "", (row[1] or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < key(row):
                gone[k : k + 50] = b"\1" * 50
        left, at = "", 0
        for char in text:
            size = len(char.encode())
            left += "" if all(gone[at : at + size]) else char
            at += size
        if left or not raw:
            out.append((row[0], left, *row[2:4], len(left)))
    return out


def cut_benchmarks(rows):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    tests = [re.findall(pattern, lowered(text)) for _, text in BENCH]
    windows = {tuple(t[k : k + min(10, len(t))]) for t in tests if t for k in range(len(t) - min(10, len(t)) + 1)}
    out = []
    for row in rows:
        found = list(re.finditer(pattern, lowered(row[1])))
        words = [m.group() for m in found]
        spans = [(k, k + n) for n in {len(w) for w in windows} for k in range(len(words)) if tuple(words[k : k + n]) in windows]
        covered = {k for a, b in spans for k in range(a, b)}
        if covered and len(covered) >= 0.5 * len(words):
            continue
        text = row[1]
        if spans:
            gone = {c for a, b in spans for c in range(found[a].start(), found[b - 1].end())}
            text = "".join(c for k, c in enumerate(text) if k not in gone)
        out.append((row[0], text, *row[2:4], row[4] if text is None else len(text)))
    return out


def tokens(rows):
    library = Tokenizer.from_file(workload.BYTE_VOCABULARY)
    out = []
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((
            row[0], *row[2:], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(), tuple(ids),
        ))
    return out


BRUTE = [not_toxic, firsts, cut_repeats, cut_benchmarks, tokens]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("pipeline"))
    labels = [
        (k, 0, int((k % 4 == 0) != (zlib.crc32(str(k).encode()) % 5 == 0))) for k in range(N_LABELLED)
    ]
    spark.createDataFrame(documents_rows(), SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where


def plain(frame):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in frame.collect())


@pytest.mark.parametrize("k", range(5))
def test_a_stage_equals_brute_force_beside_clashing_columns(spark, sf_dir, k):
    rows = documents_rows()
    extra = ", ".join(f"{name} string" for name in CLASHING)
    docs = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], f"{SCHEMA}, {extra}")
    found = corpus_pipeline.STAGES[k][1](spark, docs, sf_dir)
    expected = Counter(BRUTE[k](rows))
    assert plain(found) == expected
    assert k == 4 or (found.columns == corpus_pipeline.COLUMNS and expected != Counter(rows))


@pytest.mark.parametrize("k", range(5))
def test_a_stage_of_no_rows_has_none(spark, sf_dir, k):
    assert corpus_pipeline.STAGES[k][1](spark, spark.createDataFrame([], SCHEMA), sf_dir).collect() == []


def test_the_pipeline_equals_its_stages_by_brute_force(spark, sf_dir):
    rows = documents_rows()
    for brute in BRUTE:
        rows = brute(rows)
    assert plain(corpus_pipeline.run(spark, sf_dir)) == Counter(rows)
