"""Extraction, tokens, token files, suffixes, joins, decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldbook.llm import (
    bpe_automaton,
    decontamination,
    extraction,
    jaccard,
    pretokens,
    suffix_dedup,
    token_files,
    toxicity,
    workload,
)
from tests_llm_shapes import ODD_TEXTS


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p", ""),
        ("<nav>menu</nav><article><h1>T</h1><p>a  <b>b</b>c &amp;amp; d<br>e</p></article><footer>f</footer>", "T a bc &amp; d e"),
        ("<article><p>one<p>two<div class='comments'>no</div><form>no</form></article>", "one two"),
        ("<article><p>kept<script>var t='</p>'</script><style>p{}</style><!-- <p>no -->", "kept"),
        ("<article>x <aside>no</aside>y<div id=cookie-notice>no</div></article>", "x y"),
    ],
)
def test_extraction_keeps_the_article(page, text):
    assert " ".join(extraction.content_blocks(page)) == text


def test_extraction_without_marks_thresholds_paths():
    prose = "<p>" + "A sentence of some length, with marks; and more. " * 5 + "</p>"
    page = f"<div><div><ul><li>Home</li><li>News</li></ul></div><section>{prose * 3}</section><div><span>x</span></div></div>"
    text = " ".join(extraction.content_blocks(page))
    assert text.count("A sentence") == 15 and "Home" not in text


PROSE = "A sentence of some length, with marks; and more. " * 5
PARAGRAPHS = [f"{k} {PROSE.strip()}" for k in range(4)]
BODY = "".join(f"<p>{text}</p>" for text in PARAGRAPHS)
BOXES = "".join(f'<div class="elementor-widget-container"><p>{t}</p></div>' for t in PARAGRAPHS)


def test_extraction_ratios_decide_on_pages_with_a_marked_article():
    page = f"<body><div>{BODY}</div><article><h3>Next story</h3><p>A short teaser.</p></article></body>"
    blocks = extraction.content_blocks(page)
    assert blocks[:4] == PARAGRAPHS and "A short teaser." not in blocks
    menu = "<ul>" + "".join(f"<li>entry {k}</li>" for k in range(9)) + "</ul>"
    blocks = extraction.content_blocks(f"<article><h1>Head</h1>{BODY}<div>{menu}</div></article>")
    assert blocks[:5] == ["Head", *PARAGRAPHS]


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content-sidebar-wrap"><main>{BODY}</main></div><div>imprint</div>',
        f'<div class="site no-sidebar"><div>{BODY}</div><div class="comments"><p>Nice, thanks.</p></div></div>',
        f"<article>{BOXES}</article>",
        f"<div>{BOXES}</div>",
        f'<div class="ad">Buy it. Now, or never.</div><article>{BODY}</article>',
        f'<article>{BODY}</article><ol class="comment-list"><li><article><p>Great post, thank you. Yes.</p></article></li></ol>',
    ],
)
def test_extraction_class_words_only_lower_the_ratio(page):
    assert extraction.content_blocks(page) == PARAGRAPHS


def test_extraction_a_named_advert_stays_out_of_an_article_without_punctuation():
    page = "<div class=ad>Buy it, now. Or never.</div><article><p>" + "words and " * 30 + "</p></article>"
    assert extraction.content_blocks(page) == [("words and " * 30).strip()]


def test_extraction_query_keeps_other_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<article>a</article>", "z"), (None, None, None, None)], "page_id long, url string, html string, n_chars string")
    rows = extraction.extract(pages).orderBy(F.desc("page_id")).collect()
    assert [tuple(r) for r in rows] == [(1, "u", "z", "a"), (None, None, None, "")]


def random_texts(count: int, seed: int) -> list[str]:
    random.seed(seed)
    letters = "aabcdesT'  \n\tlrvem’é1２ 中Σ́​.,!\"\xa0　ॠİ<|"
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 30))) for _ in range(count)]


def test_byte_pair_codec_equals_the_library(spark, documents):
    texts = [*ODD_TEXTS, "don't we'll I've 's  's\n'll", "a <|endoftext|> b", *random_texts(400, 1)]
    library = Tokenizer.from_file(workload.BYTE_VOCABULARY)
    rows = bpe_automaton.encode(documents(texts, "extra"), Path(workload.BYTE_VOCABULARY).read_text()).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["extra"] == "x"
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_an_unassigned_code_point_stands_in_one_word_with_punctuation():
    points = np.array([ord(c) for c in "a !\u0378? b"], np.uint32)
    starts, ends = pretokens.byte_level_words(points, np.array([0, len(points)]))
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(0, 1), (1, 5), (5, 7)]


def test_automaton_paths_are_the_merges_of_random_words():
    automaton, _ = bpe_automaton.ready(Path(workload.BYTE_VOCABULARY).read_text())
    library = Tokenizer.from_file(workload.BYTE_VOCABULARY)
    random.seed(5)
    for _ in range(300):
        word = "".join(random.choice("aabeinorsttheé") for _ in range(random.randint(1, 25)))
        ids = automaton.encode(word.encode())
        assert ids == library.encode(word, add_special_tokens=False).ids
        assert automaton.emit(np.array(ids)).tobytes() == word.encode()


def test_token_files_give_back_every_document(spark, documents):
    texts = [*ODD_TEXTS, *random_texts(200, 2), '"" "', "the same words again and again " * 300]
    library = Tokenizer.from_file(workload.WORD_VOCABULARY)
    files = token_files.files(documents(texts), Path(workload.WORD_VOCABULARY).read_text())
    rows = sorted(token_files.read_back(files).collect(), key=lambda r: r["doc_id"])
    start = 0
    for row, text in zip(rows, texts, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_grammar_decodes_at_random():
    random.seed(4)
    docs = [[random.choice([3, 4, 5, 1]) for _ in range(random.randint(0, 400))] for _ in range(40)]
    ids = np.array([i for d in docs for i in (*d, token_files.CLOSE)], np.uint32)
    plain = np.where(ids == token_files.CLOSE, token_files.END_ID, ids)
    grammar = token_files.Grammar.from_bytes(token_files.compress(ids).to_bytes())
    assert len(grammar.left) and len(grammar.symbols) < len(ids) / 2
    assert (grammar.expand(grammar.symbols) == plain).all()
    for k, doc in enumerate(docs):
        assert grammar.document(k).tolist() == [*doc, token_files.END_ID]
    for start, stop in ((0, 1), (100, 900), (len(ids) - 3, len(ids))):
        assert (grammar.slice(start, stop) == plain[start:stop]).all()


def suffix_texts() -> list:
    random.seed(6)
    base = "".join(random.choice("abcdefgh é") for _ in range(900))
    shared = "".join(random.choice("xyzw ") for _ in range(120))
    texts = [base, base, base[:400] + "!" + base[401:], base[100:149], base[100:150], "q" * 300, "q" * 80]
    texts += [base[k : k + 200] + shared + str(k) * 60 for k in range(0, 600, 50)]
    return [*texts, *ODD_TEXTS, shared[:60] + "É" * 60, "É" * 60]


def brute_suffix(rows):
    first: dict = {}
    for doc, raw in rows:
        for k in range(len(raw) - 49):
            first.setdefault(raw[k : k + 50], doc)
    for doc, raw in rows:
        gone = [False] * len(raw)
        for k in range(len(raw) - 49):
            if first[raw[k : k + 50]] < doc:
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        yield doc, len(raw), sum(gone), spans, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize(("split", "chunk"), [(20_000, 1 << 22), (2, 2_000)])
def test_repeated_bytes_equal_brute_force(spark, documents, monkeypatch, split, chunk):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk)
    texts = suffix_texts()
    rows = suffix_dedup.deduplicated(documents(texts, "extra"), keep_text=True).collect()
    expected = {r[0]: r[1:] for r in brute_suffix([(k, (t or "").encode()) for k, t in enumerate(texts)])}
    assert len(rows) == len(texts)
    for row in rows:
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == expected[row["doc_id"]]
        row["kept_text"].encode()


def test_suffixes_are_sorted_and_collisions_refuted():
    random.seed(7)
    data = np.frombuffer("".join(random.choice("ab") for _ in range(4000)).encode() + b"c" * 60, np.uint8)
    sums = suffix_dedup.arrays.prefix_hashes(data)
    suffixes = np.array(random.sample(range(4000), 700))
    groups = np.sort(np.array([random.randrange(5) for _ in suffixes]))
    order = suffix_dedup.sort_suffixes(data, sums, suffixes, groups)
    raw = data.tobytes()
    for g in range(5):
        own = [raw[k : k + 50] for k in order[groups == g].tolist()]
        assert own == sorted(raw[k : k + 50] for k in suffixes[groups == g].tolist())
    forged = sums * np.uint64(0)  # every hash collides
    same = suffix_dedup.equal_neighbours(data, forged, order, groups)
    true = [raw[a : a + 50] == raw[b : b + 50] for a, b in zip(order[:-1].tolist(), order[1:].tolist(), strict=True)]
    assert (same == (np.array(true) & (groups[1:] == groups[:-1]))).all()


def shingle_sets(rows):
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        yield doc, {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near_texts(seed: int) -> list:
    random.seed(seed)
    words = [f"w{k}" for k in range(400)]
    line = " ".join(random.choices(words, k=30))
    base = random.choices(words, k=150)
    texts = []
    for k in range(70):
        own = [w if random.random() > 0.002 * (k % 12) else random.choice(words) for w in base]
        texts.append(" ".join(own) + (" " + line if k % 2 else ""))
    texts += [line + " " + " ".join(random.choices(words, k=5)) for _ in range(40)]
    return [*texts, texts[0].upper(), "a b c", "A  b\nc", "a b", *ODD_TEXTS]


@pytest.mark.parametrize(("hot", "together"), [(1000, 5000), (5, 5000), (5, 3)])
def test_shingle_join_equals_all_pairs(spark, documents, monkeypatch, hot, together):
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "TOGETHER", together)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    texts = near_texts(8)
    sets = dict(shingle_sets(enumerate(texts)))
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    rows = jaccard.linked(documents(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {
        k: (len(sets[k]), root(k)) for k in sets
    }


def test_shingle_join_sends_no_more_rows_than_a_near_group_has_members(spark, documents, monkeypatch):
    """120 copies of one text, each a little too far from most others: thousands of near pairs."""
    random.seed(3)
    words = [f"w{k}" for k in range(4000)]
    base = random.choices(words, k=150)
    texts = [" ".join(w if random.random() > 0.02 else random.choice(words) for w in base) for _ in range(120)]
    made = {}

    def counted(frame, name):
        made[name] = stored = keep(frame, name)
        return stored

    keep = jaccard.kept
    monkeypatch.setattr(jaccard, "kept", counted)
    rows = jaccard.linked(documents(texts)).collect()
    sets = dict(shingle_sets(enumerate(texts)))
    component = {k: k for k in sets}
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and component[a] != component[b]:
                x, y = sorted((component[a], component[b]))
                component = {k: x if c == y else c for k, c in component.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == component
    near = made["jaccard-near"]
    assert len(near.columns) == len(jaccard.NEAR)
    groups = near.select("centre", "i", "j", "salt").distinct().count()
    assert 0 < near.count() <= 120 * groups and made["jaccard-links"].count() < 120


BENCH = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short item of six words here"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
    (4, None),
    (5, " .,!"),
]


@pytest.mark.parametrize("block_bytes", [1 << 24, 64])
def test_benchmark_overlap_equals_brute_force(spark, documents, block_bytes):
    texts = [
        *ODD_TEXTS,
        "x " + BENCH[0][1].upper() + " y",
        "alpha, beta; gamma-delta epsilon zeta eta theta iota kappa z " + BENCH[1][1],
        "beta gamma delta epsilon zeta eta theta iota kappa",
        BENCH[1][1] + " " + BENCH[1][1],
    ]
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = decontamination.scan(documents(texts, "extra"), bench, block_bytes=block_bytes, keep_text=True).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = re.findall(pattern, lowered(texts[row["doc_id"]]))
        covered, items = set(), set()
        for item, text in BENCH:
            test = re.findall(pattern, lowered(text))
            n = min(10, len(test))
            windows = {tuple(test[k : k + n]) for k in range(len(test) - n + 1)} if n else set()
            for k in range(len(words)):
                if n and tuple(words[k : k + n]) in windows:
                    covered.update(range(k, k + n))
                    items.add(str(item))
        assert (row["n_words"], row["n_hit"], row["hit_items"]) == (len(words), len(covered), sorted(items))


def test_spans_are_cut_out(spark, documents):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    found = decontamination.scan(documents(["é before " + BENCH[1][1] + " after", None]), bench, keep_text=True)
    assert {r["text"] for r in decontamination.without_spans(found).collect()} == {"é before  after", None}


def test_toxicity_learns_planted_words_without_held_out_labels(spark):
    random.seed(9)
    words = [f"plain{k}" for k in range(300)]
    texts, toxic = [], []
    for k in range(900):
        bad = k % 4 == 0
        own = random.choices(words, k=40)
        if bad:
            own[3], own[20] = random.choice(["vilest", "vileness", "grubby"]), random.choice(["vile", "grubbing"])
        texts.append(None if k == 1 else " ".join(own))
        toxic.append(int(bad))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(
        # Held-out labels are wrong: learning from them would show.
        [(k, 0, (1 - t) if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, t in enumerate(toxic)],
        "doc_id long, quality int, toxic int",
    )
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    right = Counter((r["score"] >= 0.5) == bool(toxic[r["doc_id"]]) for r in rows)
    assert right[False] == 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_lexicon_counts_rows_outside_the_sample(spark, monkeypatch):
    """12 of 600 toxic rows have the rare word: too few in any sample of 20."""
    monkeypatch.setattr(toxicity, "COUNTED", 50)
    random.seed(10)
    words = [f"plain{k}" for k in range(300)]
    rows = [" ".join([*random.choices(words, k=20), "vile" * (k % 2)]) for k in range(1200)]
    training = [k for k in range(1, 1200, 2) if zlib.crc32(str(k).encode()) % 5]
    for k in training[::40][:12]:
        rows[k] += " quixotry"
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(1200)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.fit(docs, labels, sample=20).lexicon
    assert any("quixotry".startswith(entry) for entry in lexicon)
    assert any("vile".startswith(entry) for entry in lexicon)


def test_label_model_discounts_voters_that_repeat_one_another():
    rng = np.random.default_rng(1)
    truth = rng.random(3000) < 0.5
    good = np.where(rng.random(3000) < 0.9, truth, ~truth)
    noise = rng.random(3000) < 0.5
    votes = np.stack([good, noise, noise, noise], axis=1).astype(float)
    told = np.where(truth, 1, -1) * 1.0
    model = toxicity.fit_label_model(votes, told, 0.5)
    assert model.on_toxic[0] > 0.8 > 0.3 > model.on_other[0]
    assert model.worth[1] < 0.5 < model.worth[0]


def planted_votes(n=6000):
    """Votes and labels of known rates; the last voter repeats the third in 3 of 5 rows."""
    rng = np.random.default_rng(3)
    truth = rng.random(n) < 0.4
    on_toxic, on_other = np.array([0.8, 0.7, 0.6, 0.3, 0.3]), np.array([0.1, 0.2, 0.1, 0.05, 0.85])

    def drawn(k):
        return rng.random(n) < np.where(truth, on_toxic[k], on_other[k])

    votes = [drawn(k) for k in range(5)]
    votes.append(np.where(rng.random(n) < 0.6, votes[2], drawn(2)))
    labels = np.where(rng.random(n) < 0.9, truth, ~truth)
    return np.stack(votes, axis=1).astype(float), labels, truth, np.append(on_toxic, 0.6), np.append(on_other, 0.1)


@pytest.mark.parametrize("first", [0.8, 0.9, 0.99])
def test_label_model_finds_planted_rates_and_correlations(first):
    votes, labels, truth, on_toxic, on_other = planted_votes()
    model = toxicity.fit_label_model(votes, np.where(labels, 1, -1) * np.log(first / (1 - first)), 0.4)
    assert np.abs(model.on_toxic - on_toxic).max() < 0.05
    assert np.abs(model.on_other - on_other).max() < 0.05
    assert abs(model.label_on_toxic - 0.9) < 0.05 and abs(model.label_on_other - 0.1) < 0.05
    right = np.maximum(0.4 * on_toxic, 0.6 * on_other) / (0.4 * on_toxic + 0.6 * on_other)
    assert np.abs(model.accuracy - right).max() < 0.05
    planted = np.eye(6)
    planted[2, 5] = planted[5, 2] = 0.6
    assert np.abs(model.together - planted).max() < 0.05
    # Voters overrule wrong labels: the posterior is right more often than the labels.
    wrong = ((model.posterior(votes, labels) > 0.5) != truth).mean()
    assert wrong < 0.06 < 0.09 < (labels != truth).mean()


def test_toxicity_follows_voters_where_labels_are_wrong(spark, monkeypatch):
    """Every tenth label is wrong; scores are right nevertheless, and a rare chance word is none."""
    random.seed(12)
    words = [f"plain{k}" for k in range(200)]
    truth = [k % 3 == 0 for k in range(1500)]
    texts = [
        " ".join([*random.choices(words, k=20), *random.sample(["vile", "grubby", "quarrel"], 2 * t)])
        for t in truth
    ]
    labels = [int(t != (random.random() < 0.1)) for t in truth]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "LEAST_PRECISION", 0.7)
    model = toxicity.fit(docs, told)
    assert {entry[:3] for entry in model.lexicon} == {"vil", "gru", "qua"}
    rows = toxicity.score(docs, model).collect()
    assert sum((r["score"] >= 0.5) != truth[r["doc_id"]] for r in rows) == 0


def test_toxicity_learns_from_rows_that_have_a_text(spark):
    """Labels of documents that are not there change nothing; one text of a repeated id counts."""
    random.seed(13)
    words = [f"plain{k}" for k in range(100)]
    rows = [(k, " ".join([*random.choices(words, k=20), "vile" * (k % 2)])) for k in range(400)]
    docs = spark.createDataFrame(rows + rows[:7], "doc_id long, text string")
    labels = [(k, k % 2) for k in range(400)]
    more = [(k, 0) for k in range(10_000, 13_000)]
    one, two = (
        toxicity.fit(docs, spark.createDataFrame(r, "doc_id long, toxic int")) for r in (labels, labels + more)
    )
    assert one.lexicon == two.lexicon == ["vil"]
    assert np.allclose(one.weights, two.weights) and one.intercept == pytest.approx(two.intercept)


def test_toxicity_of_long_and_empty_texts(spark):
    docs = spark.createDataFrame(
        [(1, "plain words " * 200_000 + "vile grubby"), (2, ""), (3, None)], "doc_id long, text string"
    )
    model = toxicity.Classifier(["grubby", "vile"], np.zeros(2 + len(toxicity.PATTERNS)), -1.0)
    model.weights[:2] = 2.0
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert got[1] == pytest.approx(1 / (1 + np.exp(-3.0))) and got[2] == got[3] < 0.5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_without_labels_scores_alike(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(ODD_TEXTS).select("doc_id", "text")
    scores = {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(scores) == 1


def test_empty_tables_give_no_rows(spark, documents):
    nothing = documents(["x"]).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    byte, word = (Path(p).read_text() for p in (workload.BYTE_VOCABULARY, workload.WORD_VOCABULARY))
    assert bpe_automaton.encode(nothing, byte).count() == 0
    assert token_files.read_back(token_files.files(nothing, word)).count() == 0
    assert suffix_dedup.deduplicated(nothing).count() == 0
    assert jaccard.linked(nothing).count() == 0
    assert decontamination.scan(nothing, bench).count() == 0
    assert decontamination.scan(documents(ODD_TEXTS), bench).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("name", ["op4_url_filter", "op9_benchmark_overlap"])
def test_queries_equal_their_oracles(spark, name):
    from oracle_check import connect, difference

    with connect("/root/testdata/sf0.001") as connection:
        assert difference(spark, connection, name, "/root/testdata/sf0.001") is None


def test_toxicity_shuffles_few_texts_without_a_label(spark, documents):
    """Of 5,000 texts 300 may be learned from: all of these pass, and hardly another."""
    docs = documents([f"word{k} and more" for k in range(5000)]).select("doc_id", "text")
    ids = docs.select("doc_id").filter("doc_id % 13 = 5").filter(~toxicity.held_out(F.col("doc_id")))
    count = ids.count()
    bits = toxicity.id_filter(ids, count)
    assert bits.nbytes <= count * toxicity.SLOTS_PER_ID / 4 + 8
    passed = {r["doc_id"] for r in toxicity.maybe_labelled(docs, bits).collect()}
    wanted = {r["doc_id"] for r in ids.collect()}
    assert wanted <= passed and len(passed) < count + 0.1 * 5000
    none = toxicity.id_filter(ids.limit(0), 0)
    assert toxicity.maybe_labelled(docs, none).count() == 0


def test_word_beginnings_hold_a_block_of_text_at_a_time():
    """A batch of 4 MB, one text of it long: counts are right, and memory is that of a block."""
    long = " ".join(f"tale{k % 50}" for k in range(200_000))
    texts = [long, *[" ".join(f"word{(k + j) % 300}" for j in range(40)) for k in range(8000)], None]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array([k % 2 for k in range(len(texts))])], names=["text", "toxic"]
    )
    list(toxicity.begin_counts(iter([batch.slice(1, 1)])))  # tables of powers are made once
    tracemalloc.start()
    found = {}
    for part in toxicity.begin_counts(iter([batch])):
        found |= {r["entry"]: (r["toxic"], r["other"]) for r in part.to_pylist()}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    wanted = {begin: [0, 0] for begin in found}
    for k, text in enumerate(texts):
        for begin in {w[:n] for w in (text or "").split() for n in range(3, len(w) + 1)}:
            wanted[begin][1 - k % 2] += 1
    assert found == {begin: tuple(n) for begin, n in wanted.items()}
    assert peak < 60 << 20
