"""Exact top-k inner products by KD-trees, one per shard of rows.

Rows become trees where they are read: a task builds a tree of each `shard` rows by splitting
at the median of the widest side, down to `leaf` rows, and keeps for every node the tight box
of its points and its least id.  No row is shuffled, so copies of one vector, however many, lie
in many trees.

A query walks a tree best-first.  For a box between low and high, the sum of
max(q * low, q * high) over the components is never below the inner product of the query and
any point inside; the bounds of all boxes of a tree for a block of queries are one matrix
product.  The walk ends when the best open box cannot beat the query's k-th best, which is
carried from tree to tree, and from a first share of the trees, searched alone, to all others.

Queries are collected and broadcast in blocks of at most `block` of them.

Vectors are compared as whole numbers, floor(scale * x).  While products fit 53 bits they are
computed in doubles, which is then exact; else in whole numbers of any size, and
scores beyond 64 bits become the nearest 64-bit number.

Defined results: vectors that are null or hold null or non-finite components take no part, as
query or candidate; vectors are compared with those of equal length only; rows that repeat an
id are candidates of their own, and none is a candidate of a query of that id; of different
query rows with one id the least vector is asked; a null id is no query, and as a candidate
stands after all others of equal score; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm import arrays
from fieldbook.llm.store import kept, shipped

SHARD = 8_192
LEAF = 64
SHARD_BYTES = 16 << 20
#: Queries in one broadcast block; twice as many may meet by chance.
BLOCK = 8_192
#: One tree in so many is searched first, for the others' thresholds.
FIRST_SHARE = 8
#: Queries whose bounds are computed together.
_TOGETHER = 256
#: Stands for a null id, after all ids.
_NO_ID = (1 << 63) - 1
_NO_SCORE = -(1 << 63)


def numbered(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """vec_id and the vector as whole numbers, for vectors of finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    doubles = F.col(embedding).cast("array<double>")
    return vectors.filter(F.col(embedding).isNotNull() & F.forall(doubles, finite)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))).alias("point"),
    )


@dataclass
class Tree:
    """Points in node order; nodes are boxes over ranges of them, children by number or -1."""

    points: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    spans: np.ndarray
    children: np.ndarray
    least: np.ndarray


def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> Tree:
    """Median splits along the widest side of each node's tight box."""
    order = np.arange(len(points))
    low, high, spans, children, least = [], [], [], [], []
    todo = [(0, len(points), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        node, inside = len(spans), points[order[start:end]]
        if parent >= 0:
            children[parent][side] = node
        low.append(inside.min(axis=0))
        high.append(inside.max(axis=0))
        spans.append((start, end))
        children.append([-1, -1])
        least.append(ids[order[start:end]].min())
        width = high[-1].astype(float) - low[-1] if inside.shape[1] else np.zeros(1)
        if end - start > leaf and width.max() > 0:
            middle = (end - start) // 2
            split = np.argpartition(inside[:, int(width.argmax())], middle)
            order[start:end] = order[start:end][split]
            todo += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
    return Tree(
        points[order], ids[order], np.array(low), np.array(high), np.array(spans, np.int64),
        np.array(children, np.int64), np.array(least, np.int64),
    )


_TREES = (
    "part int, number int, size long, ids binary, points binary, low binary, high binary, "
    "spans binary, children binary, least binary"
)


def forest(points: DataFrame, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """Numbered rows as stored trees, one row each."""
    shipped(points.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def tree(size: int, take: int | None) -> pa.RecordBatch:
            nonlocal number
            ids = np.concatenate([i for i, _ in waiting[size]])
            rows = np.concatenate([p for _, p in waiting[size]])
            waiting[size] = [(ids[take:], rows[take:])] if take is not None and take < len(ids) else []
            built = build(rows[:take], ids[:take], leaf)
            number += 1
            blobs = (built.ids, built.points, built.low, built.high, built.spans, built.children, built.least)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64())]
                + [pa.array([np.ascontiguousarray(b, np.int64).tobytes()], pa.binary()) for b in blobs],
                names=[field.split()[0] for field in _TREES.split(", ")],
            )

        for batch in batches:
            lists = batch.column("point")
            lengths = np.diff(lists.offsets.to_numpy())
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column("vec_id").fill_null(_NO_ID).to_numpy()
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                taken = values[(starts[rows][:, None] + np.arange(size)).astype(np.int64)]
                waiting.setdefault(size, []).append((ids[rows], taken))
                most = max(1, min(shard, SHARD_BYTES // (8 * max(1, size))))
                while sum(len(i) for i, _ in waiting[size]) >= most:
                    yield tree(size, most)
        for size in list(waiting):
            if sum(len(i) for i, _ in waiting[size]):
                yield tree(size, None)

    return points.mapInArrow(arrays.tidy(step), _TREES)


@dataclass
class Asked:
    """A block of queries of one length, with the (score, id) that a candidate has to beat."""

    ids: list[int]
    points: np.ndarray
    beat: list[tuple[int, int] | None]


def _number(size: int, *arrays_: np.ndarray) -> type:
    """Doubles where all products of these arrays' rows fit them, else whole numbers of any size."""
    most = max((float(np.abs(x.astype(np.float64)).max()) if x.size else 0.0) for x in arrays_)
    return np.float64 if size * most * most < 1 << 53 else object


def _whole(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.clip(scores, _NO_SCORE + 1, (1 << 63) - 1)
    return scores.astype(np.int64)


class _Walk:
    """The best candidates of one query over the trees met so far."""

    def __init__(self, own: int, k: int, beat: tuple[int, int] | None):
        self.own, self.k, self.heap = own, k, []
        self.beat = (_NO_SCORE, 0) if beat is None else (beat[0], -beat[1])

    def wanted(self, score: int, doc: int) -> bool:
        return (score, -doc) > self.beat

    def put(self, score: int, doc: int) -> None:
        if doc == self.own or not self.wanted(score, doc):
            return
        push = heapq.heappush if len(self.heap) < self.k else heapq.heapreplace
        push(self.heap, (score, -doc))
        if len(self.heap) == self.k:
            self.beat = max(self.beat, self.heap[0])

    def through(self, tree: Tree, bounds: np.ndarray, point: np.ndarray) -> None:
        """Best-first: the open box of the largest bound is next, until none can beat the k-th."""
        open_boxes = [(-int(bounds[0]), 0)]
        while open_boxes:
            most, node = heapq.heappop(open_boxes)
            if -most < self.beat[0]:
                return
            if not self.wanted(-most, int(tree.least[node])):
                continue
            if tree.children[node][0] < 0:
                start, end = tree.spans[node]
                scores = _whole(tree.points[start:end] @ point)
                for at in np.flatnonzero(scores >= self.beat[0]).tolist():
                    self.put(int(scores[at]), int(tree.ids[start + at]))
            else:
                for child in tree.children[node].tolist():
                    heapq.heappush(open_boxes, (-int(bounds[child]), child))


def _search(shared, k: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = {
            size: [_Walk(own, k, beat) for own, beat in zip(asked.ids, asked.beat, strict=True)]
            for size, asked in shared.value.items()
        }
        for batch in batches:
            for row in batch.to_pylist():
                asked = shared.value.get(row["size"])
                if asked is None:
                    continue
                read = {name: np.frombuffer(row[name], np.int64) for name in row if isinstance(row[name], bytes)}
                n, m = len(read["ids"]), len(read["least"])
                tree = Tree(
                    read["points"].reshape(n, row["size"]), read["ids"], read["low"].reshape(m, row["size"]),
                    read["high"].reshape(m, row["size"]), read["spans"].reshape(m, 2),
                    read["children"].reshape(m, 2), read["least"],
                )
                number = _number(row["size"], tree.low, tree.high, asked.points)
                boxes = np.concatenate([tree.high, tree.low], axis=1).astype(number).T
                tree.points = tree.points.astype(number)
                for low in range(0, len(asked.ids), _TOGETHER):
                    points = asked.points[low : low + _TOGETHER]
                    signed = np.concatenate([np.maximum(points, 0), np.minimum(points, 0)], axis=1)
                    bounds, points = _whole(signed.astype(number) @ boxes), points.astype(number)
                    for at in range(len(points)):
                        walks[row["size"]][low + at].through(tree, bounds[at], points[at])
        found = [
            (walk.own, -doc, score) for group in walks.values() for walk in group for score, doc in walk.heap
        ]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
        )

    return step


_FOUND = "query_id long, vec_id long, score long"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(trees: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of each query.

    `trees` comes from `forest` and should be stored; `queries` has vec_id and point.
    """
    spark = shipped(trees.sparkSession)
    asked = queries.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("point").alias("point"))
    n_blocks = max(1, -(-asked.count() // block))
    # The first tree of the first part is among them, so that there is always one.
    first_trees = F.pmod(F.col("part") + F.col("number") - 1, F.lit(FIRST_SHARE)) == 0
    results = []
    for at in range(n_blocks):
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == at).collect()
        by_size: dict[int, Asked] = {}
        for size in {len(r["point"]) for r in rows}:
            same = [r for r in rows if len(r["point"]) == size]
            points = np.array([r["point"] for r in same], np.int64).reshape(len(same), size)
            by_size[size] = Asked([r["vec_id"] for r in same], points, [None] * len(same))
        shared = spark.sparkContext.broadcast(by_size)
        early = kept(
            _top(trees.filter(first_trees).mapInArrow(arrays.tidy(_search(shared, k)), _FOUND), k), "first-trees"
        )
        worst = {r["query_id"]: (r["score"], r["vec_id"]) for r in early.filter(F.col("rank") == k).collect()}
        for group in by_size.values():
            group.beat = [worst.get(own) for own in group.ids]
        shared = spark.sparkContext.broadcast(by_size)
        late = trees.filter(~first_trees).mapInArrow(arrays.tidy(_search(shared, k)), _FOUND)
        results.append(_top(late.unionByName(early.drop("rank")), k))
    vec = F.when(F.col("vec_id") != _NO_ID, F.col("vec_id")).alias("vec_id")
    return reduce(DataFrame.unionByName, results).select("query_id", "rank", vec, "score")


def nearest(
    vectors: DataFrame, asked: F.Column, k: int = 10, scale: int = 1024, vec_id: str = "vec_id",
    embedding: str = "embedding", shard: int = SHARD, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """The k largest inner products of every row for which `asked` holds, against all rows."""
    points = numbered(vectors, vec_id, embedding, scale)
    trees = kept(forest(points, shard, leaf), "trees")
    return search(trees, numbered(vectors.filter(asked), vec_id, embedding, scale), k, block)
