"""Main text of pages: readers' comments, deep pages, and the method done slowly on trees."""

from __future__ import annotations

import math
import random
import re
import time
import tracemalloc

import pytest

from fieldbook.llm import extraction

ARTICLE = [f"{k} A sentence of some length, with marks; and more. Another one follows here, too." for k in range(3)]
BODY = "".join(f"<p>{text}</p>" for text in ARTICLE)


def comments(n, tag="div"):
    said = "I do not agree at all; it is wrong. Sorry, but read it again, please!"
    return "".join(f"<{tag} class='comment'><p>Reader {k}: {said}</p></{tag}>" for k in range(n))


@pytest.mark.parametrize("n", [1, 2, 4, 8, 20, 60, 500])
def test_comments_stay_out_however_many(n):
    for page in (
        f"<article>{BODY}<div class='comments'>{comments(n)}</div></article>",
        f"<article>{BODY}</article><div id='comments'>{comments(n)}</div>",
        f"<div><div>{BODY}</div><div id='disqus_thread'>{comments(n)}</div></div>",
        f"<main>{BODY}</main><ol class='commentlist'>{comments(n, 'li')}</ol>",
        f"<article>{BODY}</article><section class='comment-list'>{comments(n, 'article')}</section>",
        f"<div class='site has-comments'><article>{BODY}</article><div class=replies>{comments(n)}</div></div>",
    ):
        assert extraction.content_blocks(page) == ARTICLE


def test_a_page_of_comments_alone_is_empty():
    assert extraction.content_blocks(f"<div class=comments>{comments(9)}</div>") == []


@pytest.mark.parametrize("start", ["<div class=ad>x. ", "<div>x. ", "<h1>x. ", "<b id=ad>x. ", "<li>x. <ul>"])
def test_deep_pages_take_no_more_than_long_ones(start):
    page = start * 50_000
    began = time.time()
    extraction.content_blocks(page)
    assert time.time() - began < 20
    tracemalloc.start()
    extraction.content_blocks(start * 5_000)
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()


def test_long_pages_and_empty_tables(spark):
    page = "<article>" + "".join(f"<p>{k}: {ARTICLE[0]}</p>" for k in range(20_000)) + "</article>"
    rows = [(1, None, page), (2, "u", None), (2, "u", ""), (None, "u", page[:500])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = extraction.extract(frame).collect()
    assert found[0]["text"].count("A sentence") == 20_000 and [r["text"] for r in found[1:3]] == ["", ""]
    assert extraction.extract(frame.limit(0)).count() == 0


# A page as a tree: (tag, class, children), or a text.


def random_tree(rng, depth=0):
    if depth > 4 or rng.random() < 0.25:
        words = [rng.choice(["one", "two", "three,", "four.", "five;", "six!"]) for _ in range(rng.choice([1, 3, 12, 60]))]
        return ("p", "", [" ".join(words)])
    tag = rng.choice(["div", "div", "section", "article", "main", "ul"])
    name = rng.choice(["", "", "", "box", "sidebar", "widget", "comments", "reply", "ad banner"])
    return (tag, name, [random_tree(rng, depth + 1) for _ in range(rng.randint(1, 4))])


def written(tree):
    if isinstance(tree, str):
        return tree
    tag, name, children = tree
    return f"<{tag}" + (f' class="{name}"' if name else "") + f">{''.join(map(written, children))}</{tag}>"


def blocks_by_hand(tree):
    """The method over whole paths, each compared with every other."""
    nodes = []  # (path, text); an element of a path is (tag, marked, discussion)

    def walk(node, path):
        if isinstance(node, str):
            nodes.append((path, node))
            return
        tag, name, children = node
        words = set(re.findall("[a-z]+", name)) & extraction.MARKED
        discussion = bool(words & extraction.DISCUSSION)
        here = (tag, discussion if tag in extraction.ARTICLE else bool(words), discussion)
        for child in children:
            walk(child, (*path, here))

    walk(tree, ())
    prefixes = {path[:d] for path, _ in nodes for d in range(1, len(path) + 1)}
    talks = lambda path: [d for d in range(1, len(path) + 1) if path[d - 1][2]]
    articles = [p for p in prefixes if p[-1][0] in extraction.ARTICLE and not p[-1][2]]
    layout = set()
    if articles and all(talks(p) for p in articles):
        layout = {p[: talks(p)[0]] for p in articles if len(talks(p)) == 1}
    nodes = [(p, t) for p, t in nodes if all(p[:d] in layout for d in talks(p))]
    if not nodes:
        return []
    points = lambda text: len(extraction.PUNCTUATION.findall(text))
    total, marks = sum(len(t) for _, t in nodes), sum(points(t) for _, t in nodes)

    def factor(path):
        value = 1.0
        for d in range(1, len(path) + 1):
            if path[d - 1][1]:
                outside = [t for p, t in nodes if p[:d] != path[:d]]
                a, b = sum(map(len, outside)), sum(map(points, outside))
                if a >= 0.5 * total or b >= 0.2 * marks > 0:
                    value *= 0.1
        return value

    def ratios(measure):
        own = []
        for path, _ in nodes:
            same = [t for p, t in nodes if p == path]
            own.append(sum(map(measure, same)) / len(same))
        near = math.exp(-0.5)
        out = []
        for i, value in enumerate(own):
            pairs = [(1.0, value)] + [(near, own[j]) for j in (i - 1, i + 1) if 0 <= j < len(own)]
            out.append(sum(w * v for w, v in pairs) / sum(w for w, _ in pairs))
        return out

    fused = [
        math.log1p(a) * (1 + b) * factor(p) for a, b, (p, _) in zip(ratios(len), ratios(points), nodes, strict=True)
    ]
    plain = [f for f, (p, _) in zip(fused, nodes, strict=True) if factor(p) == 1.0] or fused
    kept = []
    for path, text in nodes:
        best = max(f for f, (p, _) in zip(fused, nodes, strict=True) if p == path)
        gain = 2.5 if any(e[0] in extraction.ARTICLE for e in path) else 1.0
        if best * gain >= 0.5 * sum(plain) / len(plain) - 1e-9:
            kept.append(text)
    return kept


def test_the_trie_does_what_whole_paths_do():
    differing = 0
    for seed in range(400):
        tree = ("body", "", [random_tree(random.Random(seed * 10 + k)) for k in range(3)])
        expected = blocks_by_hand(tree)
        assert extraction.content_blocks(written(tree)) == expected, written(tree)
        differing += 0 < len(expected) < written(tree).count("<p>")
    assert differing > 100
