"""Ranked lexical search by hashed max-sketches.

A document's sketch has `WIDTH` coordinates.  Every term is hashed to one of them, and the
coordinate keeps the largest impact of its terms.  An impact grows with the term's frequency
in a document of given length, so the coordinate holds the largest frequency: whatever the
corpus statistics become, the largest impact follows from it, and the index need not be built
anew when documents are added.  Only coordinates that are not zero are stored.

A batch of queries is looked up in the sketches of many documents at once.  The looked-up
impacts, weighted and summed, are never below a document's score.  Documents are rescored
exactly in the order of falling bounds until the bound falls below the threshold: first those
of the largest bounds overall, which give each query a score that its k-th best cannot
undercut; then, in one pass over the index, whatever may still reach it, each task raising
the threshold by what it finds.  No query's candidates are shuffled, so a text that a
third of all documents share costs each copy one rescoring where it stands.

Queries are collected and broadcast in blocks of at most `block_bytes` of text; more blocks
are more passes over the index.

Defined results: null texts and texts without terms are no documents and match nothing; rows that
repeat an id are documents of their own; a null id stands after all others of equal score;
items that repeat an id and a text are one item, those that repeat only the id are ranked
apart; an item without terms, an empty index or an empty table of items give no rows.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm import arrays
from fieldbook.llm.store import kept, shipped

WIDTH = 4096
#: Text of items in one broadcast block.
BLOCK_BYTES = 4 << 20
#: Documents whose sketches are laid out together, and queries whose bounds are.
_DOCUMENTS = 512
#: A stored frequency of this size stands for any that is as large or larger.
_MOST = 65_535
#: What the impact of no frequency exceeds.
_IMPACT_LIMIT = 1_000_000
#: Stands for a null id, after all ids.
_NO_ID = (1 << 63) - 1

# Every byte that belongs to no term becomes a blank; A-Z are lower-cased.
_FOLD = bytes(
    arrays.LOWER[byte] if arrays.LETTERS[byte] else 32 for byte in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def sketch(counts: Counter[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in use, ascending, and the largest frequency folded into each."""
    peaks: dict[int, int] = {}
    for term, count in counts.items():
        at = zlib.crc32(term) % width
        if count > peaks.get(at, 0):
            peaks[at] = count
    places = np.fromiter(peaks, np.uint16, len(peaks))
    heights = np.minimum(np.fromiter(peaks.values(), np.int64, len(peaks)), _MOST)
    order = np.argsort(places)
    return places[order], heights[order].astype(np.uint16)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """A row per document with terms: doc_id, n_terms, its sketch, and the text for rescoring."""
    shipped(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes, rows, places, heights = [], [], [], []
            for row, raw in enumerate(texts.cast(pa.binary()).to_pylist()):
                found = terms(raw)
                if found:
                    at, peaks = sketch(Counter(found), width)
                    sizes.append(len(found))
                    rows.append(row)
                    places.append(at.tobytes())
                    heights.append(peaks.tobytes())
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), pa.array(sizes, pa.int64()), pa.array(places, pa.binary()),
                 pa.array(heights, pa.binary()), texts.take(take)],
                names=["doc_id", "n_terms", "places", "peaks", "text"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.filter(F.col("text").isNotNull()).mapInArrow(
        arrays.tidy(step), "doc_id long, n_terms long, places binary, peaks binary, text string"
    )


@dataclass
class Queries:
    """A block of items: their terms, and once counted, weights and thresholds."""

    names: list
    terms: list[Counter[bytes]]
    width: int
    documents: int = 0
    words: int = 0
    weights: dict[bytes, int] | None = None
    floors: list[int] | None = None

    def length_norm(self, n_terms):
        return 100 - 75 + (75 * n_terms * self.documents) // self.words

    def layout(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Which row of a looked-up matrix each coordinate has, and each query's rows and weights."""
        place = np.full(self.width, -1, np.int64)
        looked = []
        for counts in self.terms:
            at: dict[int, int] = {}
            for term, count in counts.items():
                weight = count * self.weights.get(term, 0)
                if weight:
                    c = zlib.crc32(term) % self.width
                    at[c] = at.get(c, 0) + weight
            looked.append((np.fromiter(at, np.int64, len(at)), np.fromiter(at.values(), np.int64, len(at))))
        used = np.unique(np.concatenate([c for c, _ in looked])) if looked else np.zeros(0, np.int64)
        place[used] = np.arange(len(used))
        return place, [(place[c], w) for c, w in looked]

    def score(self, query: int, counts: dict[bytes, int], norm: int) -> int:
        total = 0
        for term, times in self.terms[query].items():
            tf = counts.get(term)
            if tf:
                total += times * self.weights[term] * ((1_000_000_000 * tf) // (1_000 * tf + 8 * norm))
        return total


def _bounds(queries: Queries, layout, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, bounds by query and document) for slices of a batch of sketches."""
    place, looked = layout
    used = int(place.max()) + 1 if len(place) else 0
    sizes = batch.column("n_terms").to_numpy()
    all_places, all_peaks = batch.column("places"), batch.column("peaks")
    for low in range(0, batch.num_rows, _DOCUMENTS):
        n = min(_DOCUMENTS, batch.num_rows - low)
        raw = [v.as_py() for v in all_places.slice(low, n)]
        counts = np.array([len(r) // 2 for r in raw], np.int64)
        at = place[np.frombuffer(b"".join(raw), np.uint16)]
        peak = np.frombuffer(b"".join(v.as_py() for v in all_peaks.slice(low, n)), np.uint16).astype(np.int64)
        row = np.repeat(np.arange(n), counts)
        hit = at >= 0
        at, peak, row = at[hit], peak[hit], row[hit]
        norm = queries.length_norm(sizes[low : low + n].astype(object)).astype(np.int64)[row]
        impact = (1_000_000_000 * peak) // (1_000 * peak + 8 * norm)
        impact[peak == _MOST] = _IMPACT_LIMIT
        matrix = np.zeros((used, n), np.int64)
        matrix[at, row] = impact
        yield low, np.stack([w @ matrix[rows] if len(rows) else np.zeros(n, np.int64) for rows, w in looked])


class _Best:
    """The k best (score, id) of each query; the worst of a full list is its threshold."""

    def __init__(self, queries: int, k: int, floors: list[int] | None = None):
        self.k, self.heaps, self.floors = k, [[] for _ in range(queries)], floors or [0] * queries

    def wanted(self, query: int, most: int, doc: int) -> bool:
        """Whether a document of at most this score may still enter."""
        heap = self.heaps[query]
        if most <= 0 or most < self.floors[query]:
            return False
        return len(heap) < self.k or (most, -doc) > heap[0]

    def put(self, query: int, score: int, doc: int) -> None:
        if self.wanted(query, score, doc):
            push = heapq.heappush if len(self.heaps[query]) < self.k else heapq.heapreplace
            push(self.heaps[query], (score, -doc))

    def batch(self) -> pa.RecordBatch:
        found = [(q, -doc, score) for q, heap in enumerate(self.heaps) for score, doc in heap]
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"]
        )


_FOUND = "query long, doc_id long, score long"


def _ids(batch: pa.RecordBatch) -> list[int]:
    return [_NO_ID if v is None else v for v in batch.column("doc_id").to_pylist()]


def _largest_bounds(shared, k: int):
    """Per task and query, the k documents of the largest bounds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, layout = shared.value, shared.value.layout()
        best = _Best(len(queries.terms), k)
        for batch in batches:
            ids = _ids(batch)
            for low, bounds in _bounds(queries, layout, batch):
                for query, row in enumerate(bounds):
                    top = np.argpartition(-row, k - 1)[:k] if len(row) > k else np.arange(len(row))
                    for at in top.tolist():
                        best.put(query, int(row[at]), ids[low + at])
        yield best.batch()

    return step


def _rescored(shared, k: int):
    """Per task and query, the k best scores; texts are read in the order of falling bounds."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, layout = shared.value, shared.value.layout()
        best = _Best(len(queries.terms), k, queries.floors)
        floors = np.array(best.floors, np.int64)
        for batch in batches:
            ids, texts = _ids(batch), batch.column("text")
            sizes = batch.column("n_terms").to_pylist()
            for low, bounds in _bounds(queries, layout, batch):
                counted: dict[int, Counter[bytes]] = {}
                for query, row in enumerate(bounds):
                    may = np.flatnonzero((row > 0) & (row >= floors[query]))
                    for at in may[np.argsort(-row[may], kind="stable")].tolist():
                        most, doc = int(row[at]), ids[low + at]
                        if not best.wanted(query, most, doc):
                            if len(best.heaps[query]) == k and most < best.heaps[query][0][0]:
                                break  # no later bound is larger
                            continue
                        if at not in counted:
                            counted[at] = Counter(terms(texts[low + at].as_py().encode()))
                        norm = queries.length_norm(sizes[low + at])
                        best.put(query, queries.score(query, counted[at], norm), doc)
        yield best.batch()

    return step


def _document_frequencies(shared):
    """Per task, in how many documents each term of the items stands."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, counts = shared.value, Counter()
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()).to_pylist():
                counts.update(asked.intersection(terms(raw)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            names=["term", "df"],
        )

    return step


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    indexed: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
    width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item.

    `indexed` comes from `index` of the same width, and should be stored.
    """
    spark = shipped(indexed.sparkSession)
    asked = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("words")).distinct()
    total = asked.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    size = indexed.agg(F.count("*").alias("n"), F.sum("n_terms").alias("words")).first()
    results = []
    for block in range(n_blocks):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_blocks)) == block).collect()
        queries = Queries([r["item_id"] for r in rows], [Counter(terms(r["words"].encode())) for r in rows], width)
        if not rows or not size["n"]:
            continue
        queries.documents, queries.words = size["n"], size["words"]
        vocabulary = spark.sparkContext.broadcast(frozenset().union(*queries.terms))
        counted = indexed.select("text").mapInArrow(
            arrays.tidy(_document_frequencies(vocabulary)), "term binary, df long"
        )
        queries.weights = {
            bytes(r["term"]): math.floor(1000 * math.log((2 * queries.documents + 2) / (2 * r["df"] + 1)))
            for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect()
        }
        sketches = indexed.select("doc_id", "n_terms", "places", "peaks")
        shared = spark.sparkContext.broadcast(queries)
        likely = _top(sketches.mapInArrow(arrays.tidy(_largest_bounds(shared, k)), _FOUND), k)
        first = indexed.join(likely.select("doc_id").distinct(), "doc_id", "left_semi")
        scored = _top(first.mapInArrow(arrays.tidy(_rescored(shared, k)), _FOUND), k)
        floors = {
            r["query"]: r["floor"]
            for r in scored.filter(F.col("rank") == k).select("query", F.col("score").alias("floor")).collect()
        }
        queries.floors = [floors.get(q, 0) for q in range(len(rows))]
        shared = spark.sparkContext.broadcast(queries)
        found = _top(indexed.mapInArrow(arrays.tidy(_rescored(shared, k)), _FOUND), k)
        named = spark.createDataFrame(
            list(enumerate(queries.names)), f"query long, item_id {items.schema[item_id].dataType.simpleString()}"
        )
        results.append(found.join(F.broadcast(named), "query"))
    if not results:
        kind = items.schema[item_id].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    doc = F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id")
    return reduce(DataFrame.unionByName, results).select("item_id", "rank", doc, "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best documents of each item, by an index that is stored first."""
    return search(kept(index(docs), "lexical-index"), items, k)
