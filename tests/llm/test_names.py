"""Columns of the input that are named like an operator's own give way to it."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldbook.llm import bpe_automaton, decontamination, quality, suffix_dedup, toxicity, urls, workload

TEXT = "a plain text of some words, enough of them to be a window of ten words or more"


def scan(docs):
    tests = docs.select(F.lit("i").alias("item_id"), "text")
    return decontamination.scan(docs, tests)


def score(docs):
    labels = docs.select("doc_id", F.lit(0).alias("toxic"), F.lit(1).alias("quality"))
    return toxicity.score(docs, toxicity.fit(docs, labels))


def encode(docs):
    return bpe_automaton.encode(docs, Path(workload.BYTE_VOCABULARY).read_text())


def judge(docs):
    pages = docs.withColumns({"url": F.lit("http://a.net/x"), "html": F.col("text")})
    return urls.judge(pages, workload.URL_RULES).drop("url")


@pytest.mark.parametrize(
    ("operator", "names"),
    [
        (scan, ["n_words", "N_Hit", "hit_words", "hit_bytes", "hit_items"]),
        (score, ["Score"]),
        (encode, ["n_tokens", "ids_sha256", "decoded_sha256", "IDS"]),
        (judge, ["host", "path", "Rule", "component_verdict", "verdict", "address", "fits"]),
        (suffix_dedup.deduplicated, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]),
        (quality.measured, ["n_words", "WORD_chars", "n_lines", "n_repeat_words", "_words"]),
    ],
)
def test_own_names_win(documents, operator, names):
    docs = documents([TEXT, None, TEXT + " and on"])
    plain = operator(docs)
    clashing = operator(docs.select("*", *[F.lit("theirs").alias(n) for n in names], F.lit("kept").alias("other")))
    assert clashing.columns.count("other") == 1
    assert len({c.lower() for c in clashing.columns}) == len(clashing.columns)
    assert sorted(clashing.columns) == sorted([*plain.columns, "other"])
    order = plain.columns
    assert sorted(map(str, clashing.select(*order).collect())) == sorted(map(str, plain.select(*order).collect()))
