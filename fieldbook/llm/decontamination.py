"""Benchmark decontamination: training texts against a broadcast set of test windows.

A window is `size` consecutive words of a benchmark item (all its words if they are
fewer).  Each text's windows are looked up by hash, hits are verified by their words, and
the words they cover are reported or cut out.

The set is broadcast, so its size is bounded: benchmark items are taken in blocks of at
most `block_bytes` of text, each block a scan step of its own over the same rows.

Defined results: null or wordless text has no hit; items without words hit nothing;
equal windows of several items count for each of them; repeated rows are scanned alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from fieldbook.llm import arrays
from fieldbook.llm.store import shipped, without_names

SIZE = 10
#: Text of benchmark items in one broadcast set.
BLOCK_BYTES = 16 << 20
_BITS = 22

SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


@dataclass
class WindowSet:
    """Windows by their length: a bit per hash prefix, sorted hashes, and items by words."""

    lengths: dict[int, tuple[np.ndarray, np.ndarray]]
    items: dict[bytes, list[str]]


def window_set(items: list[tuple[str, str]], size: int = SIZE) -> WindowSet:
    """The windows of (item id, text) pairs."""
    data, offsets = arrays.buffers(pa.array([text for _, text in items], pa.string()))
    data = arrays.LOWER[data]
    starts, ends, hashes, rows = arrays.words(data, offsets, arrays.LETTERS)
    raw = data.tobytes()
    first = np.searchsorted(rows, np.arange(len(items) + 1))
    found: dict[int, set[int]] = {}
    owners: dict[bytes, dict[str, None]] = {}
    by_length = {length: arrays.windows(hashes, length) for length in range(1, size + 1)}
    for k, (name, _) in enumerate(items):
        n = int(first[k + 1] - first[k])
        length = min(n, size)
        for at in range(int(first[k]), int(first[k]) + n - length + 1 if n else int(first[k])):
            found.setdefault(length, set()).add(int(by_length[length][at]))
            text = b" ".join(raw[starts[w] : ends[w]] for w in range(at, at + length))
            owners.setdefault(text, {})[name] = None
    lengths = {}
    for length, values in found.items():
        ordered = np.sort(np.fromiter(values, np.uint64, len(values)))
        seen = np.zeros(1 << _BITS, bool)
        seen[(ordered >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        lengths[length] = (seen, ordered)
    return WindowSet(lengths, {text: list(names) for text, names in owners.items()})


def _hits(
    tests: WindowSet, data: np.ndarray, offsets: np.ndarray, found: tuple
) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words are covered, and per row the items whose windows occur."""
    starts, ends, hashes, rows = found
    cover = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for length, (bits, ordered) in tests.lengths.items():
        windows = arrays.windows(hashes, length)
        if not len(windows):
            continue
        prefix = (windows >> np.uint64(64 - _BITS)).astype(np.int64)
        near = np.flatnonzero(bits[prefix])
        near = near[rows[near] == rows[near + length - 1]]
        at = np.minimum(np.searchsorted(ordered, windows[near]), len(ordered) - 1)
        for w in near[ordered[at] == windows[near]].tolist():
            text = b" ".join(data[starts[v] : ends[v]].tobytes() for v in range(w, w + length))
            names = tests.items.get(text)
            if names is not None:
                cover[w] += 1
                cover[w + length] -= 1
                items.setdefault(int(rows[w]), set()).update(names)
    return np.cumsum(cover[:-1]) > 0, items


def _scan(tests, text: str) -> Callable[[Iterator], Iterator]:
    """Adds what the windows of the broadcast `tests` hit to what an earlier step found."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            data, offsets = arrays.buffers(columns[text])
            names_before = columns["hit_items"].to_pylist()
            spans_before = columns["hit_words"].to_pylist()
            bytes_before = columns["hit_bytes"].to_pylist()
            n_words = np.zeros(batch.num_rows, np.int64)
            for low, high, part, places in arrays.blocks(data, offsets):
                lower = arrays.LOWER[part]
                found = arrays.words(lower, places, arrays.LETTERS)
                starts, ends, _, rows = found
                n_words[low:high] = np.bincount(rows, minlength=high - low)
                covered, items = _hits(tests.value, lower, places, found)
                if not items:
                    continue
                first = np.searchsorted(rows, np.arange(high - low))
                hit = np.flatnonzero(covered)
                # Runs of covered words that follow one another in one row.
                new = np.ones(len(hit), bool)
                new[1:] = (np.diff(hit) > 1) | (np.diff(rows[hit]) > 0)
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(hit)) - 1
                for a, b in zip(hit[heads].tolist(), hit[tails].tolist(), strict=True):
                    row = int(rows[a])
                    spans_before[low + row].append(
                        {"start": a - int(first[row]), "end": b + 1 - int(first[row])}
                    )
                    bytes_before[low + row].append(
                        {"start": int(starts[a] - places[row]), "end": int(ends[b] - places[row])}
                    )
                for row, names in items.items():
                    names_before[low + row].extend(names)
            columns["n_words"] = pa.array(n_words)
            columns["hit_items"] = pa.array(names_before, batch.schema.field("hit_items").type)
            columns["hit_words"] = pa.array(spans_before, batch.schema.field("hit_words").type)
            columns["hit_bytes"] = pa.array(bytes_before, batch.schema.field("hit_bytes").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return step


def _merged(spans: str):
    """Sorted spans with those that touch or overlap joined."""
    joined = F.aggregate(
        F.array_sort(F.col(spans)),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return joined


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = SIZE, block_bytes: int = BLOCK_BYTES, keep_text: bool = False,
) -> DataFrame:
    """`docs` with n_words, n_hit, hit_words and hit_bytes (spans), and hit_items (sorted).

    The text itself is carried only with `keep_text`.  Columns of `docs` that have one of
    these names give way.
    """
    spark = shipped(docs.sparkSession)
    docs = without_names(docs, "n_words", "n_hit", "hit_words", "hit_bytes", "hit_items")
    tests = benchmark.select(
        F.col(item_id).cast("string").alias("name"),
        F.coalesce(F.col(item_text), F.lit("")).alias("words"),
    )
    total = tests.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    n_blocks = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    found = docs.select(
        *docs.columns,
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<string>").alias("hit_items"),
        F.array().cast(SPANS).alias("hit_words"),
        F.array().cast(SPANS).alias("hit_bytes"),
    )
    for k in range(n_blocks):
        block = tests.filter(F.pmod(F.xxhash64("name", "words"), F.lit(n_blocks)) == k)
        pairs = [(row["name"], row["words"]) for row in block.collect()]
        shared = spark.sparkContext.broadcast(window_set(pairs, size))
        found = found.mapInArrow(arrays.tidy(_scan(shared, text)), found.schema)
    merged = found.withColumn("hit_words", _merged("hit_words")).withColumn(
        "hit_bytes", _merged("hit_bytes")
    )
    counted = merged.withColumn(
        "n_hit",
        F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]),
    ).withColumn("hit_items", F.array_sort(F.array_distinct("hit_items")))
    return counted if keep_text else counted.drop(text)


def without_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Scanned rows with their hit_bytes cut out of the text; spans are of whole words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            for row, spans in enumerate(batch.column("hit_bytes").to_pylist()):
                if spans:
                    raw, done, kept = texts[row].encode(), 0, []
                    for span in spans:
                        kept.append(raw[done : span["start"]])
                        done = span["end"]
                    texts[row] = b"".join([*kept, raw[done:]]).decode()
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[text] = pa.array(texts, batch.schema.field(text).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return found.mapInArrow(arrays.tidy(step), found.schema)
