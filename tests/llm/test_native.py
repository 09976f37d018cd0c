"""License scans, quality rules and URL filters against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldbook.llm import graph, licenses, quality, urls, workload
from tests_llm_shapes import ODD_TEXTS

PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "ExistingRDD")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


LICENSE_TEXTS = [
    *ODD_TEXTS,
    "Licensed under CC BY-NC 4.0. MIT License, mit\nlicense",
    "This work is licensed under the GNU General Public License, version 3",
    "SPDX-License-Identifier: Apache-2.0, see http://www.apache.org/licenses/LICENSE-2.0",
    "gnu general public license gnu general public license",
    "mit licenses cc byx acc by",
]


def test_license_places_equal_a_word_by_word_search(spark, documents):
    rows = licenses.summarise(licenses.detect(documents(LICENSE_TEXTS))).collect()
    found = {row["carried"]["doc_id"]: row for row in rows}
    assert len(rows) == len(LICENSE_TEXTS)
    for k, text in enumerate(LICENSE_TEXTS):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        starts, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            starts += here
            labels |= {label} if here else set()
        row = found[k]
        assert (row["n_words"], row["n_base"]) == (len(words), len(starts)), text
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_contained_detections_are_suppressed(spark, documents):
    texts = ["Licensed under CC BY-NC 4.0", "SPDX-License-Identifier: Apache-2.0", "under the MIT License"]
    rows = licenses.detect(documents(texts)).select("carried.doc_id", "label").collect()
    assert sorted((r[0], r[1]) for r in rows) == [(0, "cc-by-nc-4.0"), (1, "apache-2.0"), (2, "mit")]


def test_the_python_address_takes_no_words_but_its_own(spark, documents):
    """Licences after docs.python.org are found, near it and far from it."""
    texts = [
        "see docs.python.org for words, under Apache License 2.0 and also GPL version 3, read the license",
        "docs.python.org under MIT License " + "more words " * 400 + "the license",
        "docs.python.org/3.12/license.html and docs.python.org/pt-br/release/3.8.0/license or https://docs.python.org/license",
    ]
    found = licenses.detect(documents(texts)).select("carried.doc_id", "start", "end", "label").collect()
    labels = [sorted(r["label"] for r in found if r["doc_id"] == k) for k in range(3)]
    assert labels == [["apache-2.0", "gpl-3.0"], ["mit"], ["python-2.0"] * 3]
    assert all(r["end"] - r["start"] < 60 for r in found)


def resolved_by_hand(hits):
    """In rule order, each hit that overlaps none kept before."""
    kept = []
    for start, end, rule in sorted(hits, key=lambda h: (h[2], h[0], -h[1])):
        if not any(a < end and start < b for a, b, _ in kept):
            kept.append((start, end, rule))
    return kept


def test_suppression_equals_brute_force(spark, documents):
    rng = random.Random(12)
    sets = [["aXbXc", "bXc", "cXd", "a", "dXaXb"], ["aXb", "bXc", "cXd", "dXaXbXc", "c"]]
    sets += [["X".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(8)] for _ in range(6)]
    texts = ["a b c d a b c d a x a b", "a b", "x y", *(" ".join(rng.choice("abcdx") for _ in range(60)) for _ in range(8))]
    for patterns in sets:
        rules = [
            {"rule": k, "label": f"r{k}", "gate": p[0], "pattern": f"(?<= )(?:{p})(?= )".replace("X", "  "), "score": 0.5}
            for k, p in enumerate(patterns)
        ]
        got = licenses.detect(documents(texts), rules=rules).select("carried.doc_id", "start", "end", "rule").collect()
        for doc, text in enumerate(texts):
            stream = "  " + "  ".join(text.split()) + "  "
            hits = [(m.start(), m.end(), r["rule"]) for r in rules for m in re.finditer(r["pattern"], stream)]
            own = [tuple(r)[1:] for r in got if r["doc_id"] == doc and r["rule"] is not None]
            assert sorted(own) == sorted(resolved_by_hand(hits)), (patterns, text)
        assert {r["doc_id"] for r in got} == set(range(len(texts)))


NOTICE = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."


@pytest.mark.parametrize("written", [NOTICE, "Released under the Creative Commons Attribution{} 4.0 licence, see the text."])
def test_the_six_creative_commons_notices(spark, documents, written):
    names = {
        "": "cc-by-4.0", "-ShareAlike": "cc-by-sa-4.0", "-NoDerivatives": "cc-by-nd-4.0", "-NonCommercial": "cc-by-nc-4.0",
        "-NonCommercial-ShareAlike": "cc-by-nc-sa-4.0", "-NonCommercial-NoDerivatives": "cc-by-nc-nd-4.0",
    }
    rows = licenses.summarise(licenses.detect(documents([written.format(n) for n in names]))).collect()
    found = {r["carried"]["doc_id"]: r["labels"] for r in rows}
    assert [found[k] for k in range(6)] == list(names.values())


def quality_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts_equal_brute_force(spark, documents):
    texts = [*ODD_TEXTS, "a b c d e f\n" * 3 + "x y", "p q r s t u p q r s t v q r s t u", "x|y <z> & $5\nx|y <z> & $5"]
    rows = quality.measured(documents(texts, "n_lines_")).collect()
    for row in rows:
        got = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == quality_counts(texts[row["doc_id"]])


def test_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.01), (3, 500, 0.01), (12, 3000, 0.01), (40, 2000, 0.02)]
    for k, n, p in cases:
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert got == pytest.approx(exact, rel=1e-9)


def test_cutoffs_bound_false_rejections(spark):
    """Good texts have few symbols, bad ones many; a stratum of few labels gets no cutoff."""
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3800, "big").otherwise("small").alias("stratum"),
        F.when(F.col("id") % 4 == 0, 0).otherwise(1).alias("good"),
        F.when(F.col("id") % 4 == 0, 40).otherwise(F.when(F.col("id") % 97 == 1, 12).otherwise(0)).cast("long").alias("n_symbols"),
        *[F.lit(v).cast("long").alias(c) for c, v in {
            "word_chars": 100, "n_dup_lines": 0, "n_lines": 5, "n_repeat_words": 0, "n_words": 50,
            "n_seen_words": 5, "n_capitals": 1}.items()],
    )
    cutoffs = {r["stratum"]: r["cutoffs"] for r in quality.certified_cutoffs(rows, "stratum", "good").collect()}
    assert set(cutoffs) == {"big"}
    assert 120 < cutoffs["big"]["symbols"] <= 400
    judged = quality.judge(rows, quality.certified_cutoffs(rows, "stratum", "good"), "stratum")
    lost = judged.filter("good = 1 and not kept and stratum = 'big'").count()
    assert lost <= quality.RISK * 2850


PAGES = [
    (1, "http://a.com/x", '<link rel="canonical" href="https://q.net/z">'),
    (2, "http://b.com/", '<meta http-equiv="refresh" content="0; url=http://a.com/x#t">'),
    (3, "http://c.com/k/1", "<LINK HREF=../2 REL=canonical>"),
    (4, None, None),
    (5, "nourl", "<link rel=canonical href=/x>"),
    (6, "http://d.com/de", '<link href="http://www.example.net/en/1" rel="canonical">'),
    (7, "http://e.com/", "<meta http-equiv=refresh content=\"5;URL='http://d.com/de'\">"),
    (9, "http://Example.COM/de/x?y#z", ""),
    (10, "http://x.net", ""),
    (11, "http://www.net/en/", ""),
    (11, "http://www.net/en/", ""),
]


def test_urls_follow_rules_then_components(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = urls.judge(frame, workload.URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    got = sorted(map(tuple, rows), key=lambda r: r[0])
    assert got == [
        (1, "a.com", "/x", None, "block"),
        (2, "b.com", "/", None, "block"),
        (3, "c.com", "/k/1", None, "allow"),
        (4, "", "", None, "allow"),
        (5, "", "", None, "allow"),
        (6, "d.com", "/de", None, "allow"),
        (7, "e.com", "/", None, "allow"),
        (9, "example.com", "/de/x", "example.com/de/", "block"),
        (10, "x.net", "", None, "allow"),
        (11, "www.net", "/en/", "net/", "block"),
        (11, "www.net", "/en/", "net/", "block"),
    ]


def test_components_equal_a_search(spark):
    import random

    random.seed(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 260)]
    edges += [(random.randrange(300, 500), random.randrange(300, 500)) for _ in range(90)] + [(5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(frame).collect()}
    near: dict = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert got[node] == min(seen)
    assert set(got) == set(near)


def test_empty_tables_give_no_rows(spark, documents):
    nothing = documents(["x"]).limit(0)
    assert licenses.summarise(licenses.detect(nothing)).count() == 0
    assert quality.measured(nothing).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, workload.URL_RULES).count() == 0


def test_native_plans_run_no_python(spark, documents):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    frames = [
        licenses.summarise(licenses.detect(documents(["x"]))),
        quality.measured(documents(["x"])),
        urls.alias_edges(pages),
    ]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString().replace("Scan ExistingRDD", "Scan")
        assert not any(name in plan for name in PYTHON), plan
