"""Ranked search, vector search and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import conversation_trie, kdtree, lexical, workload
from tests_llm_shapes import ODD_TEXTS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = {i: i + 32 for i in range(65, 91)}


def terms_of(text):
    return [t.translate(LOWERED) for t in TERM.findall(text or "")]


def ranked_by_hand(docs, items, k=10):
    counted = [(doc, terms_of(text)) for doc, text in docs]
    counted = [(doc, len(w), Counter(w)) for doc, w in counted if w]
    n_docs, n_terms = len(counted), sum(n for _, n, _ in counted)
    df = Counter(t for _, _, c in counted for t in c)
    found = set()
    for item, text in set(items):
        scores = []
        for doc, n, tf in counted:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in terms_of(text) if tf[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            found.add((item, rank, doc, -score))
    return found


def rows_of(frame, *columns):
    return {tuple(r[c] for c in columns) for r in frame.collect()}


def words(rng, n, vocabulary):
    # Few common words, many rare ones.
    return " ".join(f"w{int(vocabulary * rng.random() ** 3)}" for _ in range(n))


ITEMS = "item_id string, text string, doc_id string"


@pytest.fixture
def corpus():
    rng = random.Random(7)
    texts = [words(rng, rng.choice([1, 5, 40, 300]), 400) for _ in range(150)]
    # A third are copies of one text; some odd ones; a repeated and a null id.
    copy = words(rng, 30, 400)
    docs = [*enumerate(texts), *((1000 - k, copy) for k in range(80))]
    docs += [(2000 + k, text) for k, text in enumerate(ODD_TEXTS)]
    docs += [(3000, "Wide É中文 w1 W2"), (3000, "Wide É中文 w1 W2"), (None, copy), (3001, "w1 " * 70_000)]
    items = [(f"i{k}", words(rng, 12, 400)) for k in range(20)]
    items += [("copy", copy), ("copy", "w3 w3 W3 w9"), ("i0", items[0][1]), (None, "é É中文 wide"), ("none", None), ("blank", " ,;")]
    return docs, items


@pytest.mark.parametrize(("width", "block_bytes"), [(4096, 4 << 20), (16, 200)])
def test_ranked_search_equals_brute_force(spark, documents, corpus, width, block_bytes):
    docs, items = corpus
    frame = documents(docs, extra="score").repartition(5)
    asked = spark.createDataFrame([(*item, "x") for item in items], ITEMS)
    index = lexical.index(frame, width=width)
    found = lexical.search(index, asked, width=width, block_bytes=block_bytes)
    assert found.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == ranked_by_hand(docs, items)


def test_bounds_are_never_below_scores(corpus):
    docs, items = corpus
    asked = lexical.Queries([i for i, _ in items], [Counter(t.encode() for t in terms_of(x)) for _, x in items], 32)
    asked.documents, asked.words = 100, 5_000
    asked.weights = {t: 1 + zlib.crc32(t) % 5_000 for c in asked.terms for t in c}
    import pyarrow as pa

    texts = [t for _, t in docs if terms_of(t)]
    counts = [Counter(lexical.terms(t.encode())) for t in texts]
    sketched = [lexical.sketch(c, 32) for c in counts]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([sum(c.values()) for c in counts], pa.int64()), pa.array([p.tobytes() for p, _ in sketched]),
         pa.array([h.tobytes() for _, h in sketched])],
        names=["n_terms", "places", "peaks"],
    )
    for _, bounds in lexical._bounds(asked, asked.layout(), batch):
        for q in range(len(items)):
            for d, c in enumerate(counts):
                exact = asked.score(q, c, asked.length_norm(sum(c.values())))
                assert bounds[q][d] >= exact


def test_ranked_search_of_nothing(spark, documents):
    asked = spark.createDataFrame([("a", "b", "x")], ITEMS)
    assert lexical.ranked(documents([None, "", " , "]), asked).count() == 0
    assert lexical.ranked(documents([]), asked).count() == 0
    assert lexical.ranked(documents(["b"]), asked.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, score int, rank int"


def nearest_by_hand(rows, k=10):
    usable = []
    for vec, x in rows:
        if x is not None and all(v is not None and math.isfinite(v) for v in x):
            usable.append((vec, [math.floor(1024 * float(np.float32(v))) for v in x]))
    asked = {}
    for vec, x in usable:
        if vec is not None and vec % 100 == 0:
            asked[vec] = min(asked.get(vec, x), x)
    found = []
    for q, x in asked.items():
        scores = [
            (-sum(a * b for a, b in zip(x, y)), vec is None, vec)
            for vec, y in usable if vec != q and len(x) == len(y)
        ]
        ordered = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        found += [(q, rank, vec, -score) for rank, (score, _, vec) in enumerate(ordered, 1)]
    return sorted(found, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(vec, x, 1, 2, 3) for vec, x in rows], VECTORS)


@pytest.mark.parametrize(("shard", "leaf", "block"), [(8_192, 64, 8_192), (40, 4, 2)])
def test_nearest_equals_brute_force(spark, shard, leaf, block):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(700)]
    hot = rng.normal(size=8).tolist()
    rows += [(5_000 - k, hot) for k in range(350)]  # a third are copies, among them queries
    rows += [(6_000, [1.0, float("nan")] + [0.0] * 6), (6_001, None), (6_002, [None] * 8), (6_100, [float("inf")] * 8)]
    rows += [(None, rows[3][1]), (None, [50.0] * 8), (300, rows[7][1]), (9, rows[9][1])]
    rows += [(7_000, [1.0, 2.0]), (7_001, [3.0, -4.0]), (7_100, []), (7_101, []), (7_200, [1.0])]
    found = kdtree.nearest(vectors(spark, rows).repartition(6), F.col("vec_id") % 100 == 0, shard=shard, leaf=leaf, block=block)
    got = sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=str)
    assert got == nearest_by_hand(rows)


def test_nearest_of_large_components_is_exact(spark):
    rng = random.Random(5)
    rows = [(k, [rng.uniform(-2e6, 2e6) for _ in range(3)]) for k in range(200)]
    found = kdtree.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, shard=64, leaf=8)
    assert sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()), key=str) == nearest_by_hand(rows)


def test_nearest_beyond_64_bits_is_the_nearest_number(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, 0.0]), (2, [-1e12, 0.0])]
    found = kdtree.nearest(vectors(spark, rows), F.col("vec_id") == 0)
    assert [(r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(1, 2**63 - 1), (2, 1 - 2**63)]


def test_nearest_of_nothing(spark):
    assert kdtree.nearest(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert kdtree.nearest(vectors(spark, [(1, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0
    assert kdtree.nearest(vectors(spark, [(100, [1.0])]), F.col("vec_id") % 100 == 0).count() == 0


def trie_by_hand(rows):
    """Every node as its prefix, all counts by walking the members."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        built[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, convs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1]) if p else 0
    found = set()
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        found.add((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return found


TURNS = "conv_id long, turn long, role string, text string, depth string"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def some_conversations(seed, n=260, longest=9, texts=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        if conv % 7 == 3 and conv % 100:
            continue
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], f"t{rng.randrange(texts)} é🙂"))
    for conv in range(1_001, 1_090):  # copies of one conversation without a family head
        rows += [(conv, turn, "user", f"same {turn}") for turn in range(8)]
    rows += [(2_000, None, "user", "first"), (2_000, 0, None, None), (2_000, 1, "", ""), (2_001, 5, None, "x")]
    rows += [(2_002, 1, "a", "tie"), (2_002, 1, "b", "tie"), (2_002, 1, "a", "tie"), (None, 1, "a", "no one's")]
    rows += [(3_000, t, "user", f"{t % 3}") for t in range(400)] + [(3_001, t, "user", f"{t % 3}") for t in range(390)]
    return rows


@pytest.mark.parametrize(("segment", "shard_turns"), [(1_024, 200_000), (4, 60), (1, 1)])
def test_trie_equals_brute_force(spark, segment, shard_turns):
    rows = some_conversations(segment)
    frame = spark.createDataFrame([(*r, "x") for r in rows], TURNS).repartition(7)
    found = conversation_trie.nodes(frame, segment=segment, shard_turns=shard_turns)
    assert [kind for _, kind in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert rows_of(found, *NODE) == trie_by_hand(rows)
    assert found.count() == len(trie_by_hand(rows))


def test_trie_of_nothing_and_of_turnless(spark):
    assert conversation_trie.nodes(spark.createDataFrame([], TURNS)).count() == 0
    turnless = [c for c in range(101, 160) if zlib.crc32(str(c).encode()) % 6 > 0][:3]
    rows = [(c, 0, "user", "gone") for c in turnless]
    found = conversation_trie.nodes(spark.createDataFrame([(*r, "x") for r in rows], TURNS))
    assert rows_of(found, *NODE) == trie_by_hand(rows)


def test_two_fattest_is_the_most_even_number():
    for low in range(40):
        for high in range(low + 1, 41):
            assert conversation_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda n: n & -n)


def test_trie_finds_where_strings_leave():
    """Located nodes are the deepest whose string begins the searched one, and none is lost."""
    rng = random.Random(11)
    trie, known = conversation_trie.ZFastTrie(), set()
    for batch in range(30):
        strings = []
        for _ in range(8):
            turns = [rng.randrange(2) for _ in range(rng.randint(0, 24))]
            here, signatures = conversation_trie.ROOT, []
            for turn in turns:
                here = conversation_trie.chained(here, bytes([turn]))
                signatures.append(here)
            lengths = np.ones(len(turns), np.int64).tobytes()
            strings.append(conversation_trie._String(0, conversation_trie.ROOT, b"".join(signatures), lengths, 0))
            known.update([conversation_trie.ROOT, *signatures])
        trie.insert_batch([(s, (1, 0), batch) for s in strings])
        for s in strings:
            node = trie.locate(s)
            assert node.depth == s.end and node.string.at(node.depth) == s.at(s.end)
    assert {row[0] for row in trie.expanded()} == known
    for handle, node in trie.handles.items():
        assert handle == trie._handle(node) and len(node.children) != 1 or node.sums[0]


@pytest.mark.parametrize("name", ["op11_max_sketch_search", "op12_kd_tree_search", "op13_conversation_trie"])
def test_query_equals_its_sql(spark, name):
    import oracle_check

    sf_dir = "/root/testdata/sf0.001"
    con = oracle_check.connect(sf_dir)
    frame = workload.QUERIES[name](spark, sf_dir)
    result = con.execute(workload.ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = oracle_check.table_of(columns, result.fetchall())
    assert oracle_check.table_of(frame.columns, [tuple(r) for r in frame.collect()]) == expected
