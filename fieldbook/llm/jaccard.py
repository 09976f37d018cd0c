"""Similarity join of texts on word shingles, exact at a Jaccard threshold.

A text's set holds the hashes of its distinct `SIZE`-word shingles.  Shingles get one global
order, rare before frequent, by counts of the most frequent ones (a bounded table, which
decides only speed).  Two sets that meet the threshold share a shingle among the first
p = n - ceil(t n) + 1 of each, and two among the first p + 1.  So rare shingles of the
prefix are indexed singly; where a prefix holds a few shingles of the frequent class, their
pairs are indexed in their stead.  (A text with many frequent ones indexes those singly,
and meets every text on them.)

Index entries travel packed, many to a row, to buckets of keys.  Groups of equal keys are
not expanded to pairs: each member is verified against the most central one.  Components
of the links found say which groups are done; in the rest, pairs of texts of different
components pass a parity-bitmap bound on their overlap, in blocks.  The texts that have such
a pair meet again with their whole sets, and only links that join components are sent on, so
no step makes more rows than a group has members.  Verification compares whole sets.

Defined results: texts without words are linked with nothing; a text of fewer words than a
shingle has one shingle, all its words; equal sets are linked; repeated ids are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import arrays
from fieldbook.llm.graph import components
from fieldbook.llm.store import kept, shipped

SIZE = 5
PERCENT = 75
#: Text handled at once when entries are packed.
CHUNK_BYTES = 1 << 22
#: Shingles in the table of frequent ones (16 bytes each), which is broadcast.
FREQUENT = 1 << 17
#: A shingle of so many counted texts is of the frequent class.
HOT = 1000
#: A text with at most so many frequent shingles in its prefix indexes their pairs.
PAIRED = 12
#: Index entries a bucket should hold, and texts a block of a large group.
BUCKET_ENTRIES = 200_000
BLOCK = 2048
#: Shingles of a block's texts, and of the texts that a bucket verifies.
BLOCK_SHINGLES = 1 << 21
BUCKET_SHINGLES = 500_000
#: Rows of one centre and pair of blocks that stay together; more are split by key.
TOGETHER = 5000

#: What says where texts with near pairs meet, and what they are.
NEAR = ("centre", "i", "j", "salt", "block", "component", "doc", "n")
RARE_KEY, PAIR_ONLY, FREQUENT_KEY = range(3)  # how a text is indexed under a key
_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8"), ("n", "<u4"), ("score", "u1"), ("role", "u1")])


def required(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Least overlap of a set of n with any set that meets the threshold."""
    return -(-n * percent // 100)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct shingles, by row and hash."""
    _, _, hashes, rows = arrays.words(arrays.LOWER[data], offsets, arrays.BLACK)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    first = np.cumsum(counts) - counts
    found_rows, found = [], []
    windows = arrays.windows(hashes, size)
    whole = np.flatnonzero(rows[: len(windows)] == rows[len(rows) - len(windows) :])
    found_rows.append(rows[whole])
    found.append(windows[whole])
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            found_rows.append(short)
            found.append(arrays.windows(hashes, n)[first[short]] ^ np.uint64(n))
    rows, hashes = np.concatenate(found_rows), np.concatenate(found)
    order = arrays.order_of(rows, hashes)
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, bytes and offsets of runs of rows of about CHUNK_BYTES, across batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        data, offsets = arrays.buffers(batch.column("text"))
        for low, high, _, _ in arrays.blocks(data, offsets, CHUNK_BYTES):
            part = batch.slice(low, high - low)
            held.append(part)
            size += int(offsets[high] - offsets[low])
            if size >= CHUNK_BYTES:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    whole = pa.Table.from_batches(parts).combine_chunks()
    return (whole.column("doc").combine_chunks(), *arrays.buffers(whole.column("text")))


def _identities(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that tell a set from others."""
    return _sums(arrays.mixed(hashes), counts), _sums(arrays.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), counts)


def _census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its set's size, identity and bitmap; per chunk the shingles of several sets."""
    names = ["doc", "n", "one", "two", "bits", "token", "texts"]
    for docs, data, offsets in _chunks(batches):
        rows, hashes = shingles(data, offsets)
        counts = np.bincount(rows, minlength=len(docs))
        one, two = _identities(hashes, counts)
        ends = np.cumsum(counts)
        bits = [parity_bits(hashes[e - c : e], int(c)) for c, e in zip(counts.tolist(), ends.tolist(), strict=True)]
        nothing = pa.nulls(len(docs), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                docs, pa.array(counts), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                pa.array(bits, pa.binary()), nothing, nothing,
            ],
            names=names,
        )
        _, first = np.unique(one, return_index=True)
        once = np.zeros(len(docs), bool)
        once[first] = True
        tokens, texts = np.unique(hashes[once[rows]], return_counts=True)
        often = texts > 1
        nothing = pa.nulls(int(often.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [nothing, nothing, nothing, nothing, pa.nulls(len(nothing), pa.binary()), pa.array(tokens[often].view(np.int64)), pa.array(texts[often])],
            names=names,
        )


def frequent_table(tokens: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles with their counts, at most `most`, by shingle."""
    counts = tokens.groupBy("token").agg(F.sum("texts").alias("texts"))
    counts = kept(counts, "shingle-counts")
    steps = (
        counts.groupBy(F.floor(F.log2("texts") * 4).alias("step")).count().orderBy(F.desc("step")).collect()
    )
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    chosen = counts.filter(F.floor(F.log2("texts") * 4) >= least).toPandas()
    chosen = chosen.assign(token=chosen["token"].to_numpy(np.int64).view(np.uint64)).sort_values("token")
    return chosen["token"].to_numpy(), chosen["texts"].to_numpy(np.int64)


def index_entries(
    docs: np.ndarray, rows: np.ndarray, hashes: np.ndarray, table: tuple[np.ndarray, np.ndarray],
    percent: int = PERCENT,
) -> np.ndarray:
    """The index entries of a chunk's sets, which come by row and hash."""
    tokens, texts = table
    counts = np.bincount(rows, minlength=len(docs))
    often = np.zeros(len(hashes), np.int64)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
        known = tokens[at] == hashes
        often[known] = texts[at[known]]
    # The same rank for all that are not in the table: their order is that of the hash.
    order = np.argsort(rows.astype(np.int64) << 40 | often, kind="stable")
    rows, hashes, often = rows[order], hashes[order], often[order]
    place = np.arange(len(rows)) - (np.cumsum(counts) - counts)[rows]
    prefix = (counts - required(counts, percent) + 1)[rows]
    weight = np.zeros(len(docs))
    np.add.at(weight, rows, np.log2(often + 1.0))
    score = np.minimum(255, 16 * weight / np.maximum(counts, 1)).astype(np.uint8)
    hot = (often >= HOT) & (place <= prefix)
    n_hot = np.bincount(rows[hot], minlength=len(docs))
    paired = n_hot <= PAIRED
    first = np.flatnonzero(place < prefix)
    singles = np.empty(len(first), _ENTRY)
    singles["key"] = hashes[first]
    singles["role"] = np.where(hot[first], np.where(paired[rows[first]], PAIR_ONLY, FREQUENT_KEY), RARE_KEY)
    singles["doc"] = docs[rows[first]]
    singles["n"] = counts[rows[first]]
    singles["score"] = score[rows[first]]
    found = [singles]
    hot_at = np.flatnonzero(hot & paired[rows])
    for gap in range(1, PAIRED):
        # Pairs of a text's frequent shingles that stand `gap` apart among them.
        left = np.arange(len(hot_at) - gap) if len(hot_at) > gap else np.zeros(0, np.int64)
        same = left[rows[hot_at[left]] == rows[hot_at[left + gap]]]
        same = same[place[hot_at[same]] < prefix[hot_at[same]]]
        if not len(same):
            continue
        pairs = np.empty(len(same), _ENTRY)
        pairs["key"] = arrays.mixed(hashes[hot_at[same]] * np.uint64(3) + hashes[hot_at[same + gap]])
        pairs["role"] = RARE_KEY
        pairs["doc"] = docs[rows[hot_at[same]]]
        pairs["n"] = counts[rows[hot_at[same]]]
        pairs["score"] = score[rows[hot_at[same]]]
        found.append(pairs)
    return np.concatenate(found)


def pack(entries: np.ndarray) -> bytes:
    """Bytes of entries, place after place, so that equal high bytes lie together."""
    return entries.view(np.uint8).reshape(-1, entries.dtype.itemsize).T.tobytes()


def unpack(data: bytes, kind: np.dtype) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def _stars(percent: int):
    """Per bucket: pairs of a group's centre and members, and groups that have other pairs."""

    def step(bucket: pa.Table) -> pa.Table:
        entries = np.concatenate([unpack(p.as_py(), _ENTRY) for p in bucket.column("payload")])
        entries = entries[np.lexsort((entries["doc"], -entries["score"].astype(np.int64), entries["role"] == PAIR_ONLY, entries["key"]))]
        # The centre leads its group: most central of those that meet all others.
        heads = np.flatnonzero(np.append(True, entries["key"][1:] != entries["key"][:-1]))
        sizes = np.diff(np.append(heads, len(entries)))
        live = (sizes > 1) & (entries["role"][heads] != PAIR_ONLY)
        stays = np.repeat(live, sizes)
        entries, sizes = entries[stays], sizes[live]
        centre = np.repeat(entries[np.cumsum(sizes) - sizes], sizes)
        small = np.minimum(entries["n"], centre["n"]).astype(np.int64) * 100
        large = np.maximum(entries["n"], centre["n"]).astype(np.int64) * percent
        pairs = (entries["doc"] != centre["doc"]) & (small >= large)
        one = np.unique(np.stack([centre["doc"][pairs], entries["doc"][pairs]]), axis=1)
        more = np.repeat(sizes > 2, sizes)
        rest, leads = entries[more], centre["doc"][more]

        def column(found: np.ndarray, before: int, after: int) -> pa.Array:
            values = pa.array(found.astype(np.int64), pa.int64())
            return pa.concat_arrays([pa.nulls(before, pa.int64()), values, pa.nulls(after, pa.int64())])

        n, m = one.shape[1], len(rest)
        return pa.table(
            {
                "a": column(one[0], 0, m),
                "b": column(one[1], 0, m),
                "key": column(np.ascontiguousarray(rest["key"]).view(np.int64) if m else np.zeros(0, np.int64), n, 0),
                "doc": column(rest["doc"], n, 0),
                "n": column(rest["n"], n, 0),
                "role": column(rest["role"], n, 0),
                "centre": column(leads, n, 0),
            }
        )

    return step


def _verified(pairs: DataFrame, read: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets meet the threshold."""
    sizes = sets.dropDuplicates(["doc"]).select("doc", "n", "bits")
    for end in ("a", "b"):
        pairs = pairs.join(sizes.withColumnsRenamed({"doc": end, "n": f"n_{end}", "bits": f"bits_{end}"}), end)
    pairs = kept(pairs.mapInArrow(arrays.tidy(_pair_bound(percent)), "a bigint, b bigint"), "jaccard-bounded")
    # A hot end gets a salt for each few hundred of its pairs, and is sent once a salt.
    degree = pairs.groupBy("a").count()
    salted = pairs.join(degree, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / 256)).cast("int").alias("salt")
    )
    wanted = salted.select("a", "salt", F.col("b").alias("doc")).union(
        salted.select("a", "salt", F.col("a").alias("doc")).distinct()
    )
    buckets = max(8, pairs.count() // 200)
    texts = read.join(wanted.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    sent = wanted.join(texts, "doc").withColumn("bucket", F.pmod(F.xxhash64("a", "salt"), F.lit(buckets)))

    def step(bucket: pa.Table) -> pa.Table:
        docs, centres, salts = (bucket.column(c).combine_chunks().to_numpy() for c in ("doc", "a", "salt"))
        text = bucket.column("text").combine_chunks()
        order = np.lexsort((docs != centres, salts, centres))  # a centre leads its group
        ones, twos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        heads = np.flatnonzero(docs[order] == centres[order])
        for first, last in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            group = order[first:last]
            data, offsets = arrays.buffers(text.take(pa.array(group)))
            own = None
            for low, high, part, places in arrays.blocks(data, offsets):
                rows, hashes = shingles(part, places)
                counts = np.bincount(rows, minlength=high - low)
                if own is None:
                    own = hashes[rows == 0]
                where = np.minimum(np.searchsorted(own, hashes), len(own) - 1)
                both = np.bincount(rows[own[where] == hashes], minlength=high - low)
                good = docs[group[low:high]][100 * both >= percent * (counts + len(own) - both)]
                twos.append(good)
                ones.append(np.full(len(good), centres[group[0]]))
        one, two = np.concatenate(ones), np.concatenate(twos)
        return pa.table({"a": pa.array(one[one != two], pa.int64()), "b": pa.array(two[one != two], pa.int64())})

    return sent.groupBy("bucket").applyInArrow(arrays.tidy_group(step), "a bigint, b bigint")


def parity_bits(hashes: np.ndarray, n: int) -> bytes:
    """Bit k is the parity of how many hashes fall on it; one to two bits to a shingle."""
    size = 64 * max(1, 1 << max(0, math.ceil(math.log2(max(n, 1) / 64))))
    counts = np.bincount((arrays.mixed(hashes) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A parity bitmap at a smaller power of two: halves are added."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _may_meet(apart: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b can meet the threshold, if so many parities differ.

    Every difference of parity is a shingle that only one of the sets has.
    """
    both = (a + b - apart.astype(np.int64)) // 2
    return 100 * both >= percent * (a + b - both)


def _pair_bound(percent: int):
    """Of pairs with the bitmaps of both, those that the bound lets pass."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            bits = [[np.frombuffer(b, np.uint64) for b in batch.column(c).to_pylist()] for c in ("bits_a", "bits_b")]
            apart = np.zeros(batch.num_rows, np.int64)
            for k, (x, y) in enumerate(zip(*bits, strict=True)):
                width = min(len(x), len(y))
                apart[k] = np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum()
            passed = pa.array(_may_meet(apart, *sizes, percent))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(passed) for c in ("a", "b")], names=["a", "b"])

    return step


def _group_pairs(columns: dict[str, np.ndarray], raw: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group or pair of blocks, of different components, that the bound lets pass."""
    order = np.argsort(columns["n"], kind="stable")
    columns = {c: v[order] for c, v in columns.items()}
    raw = [raw[k] for k in order.tolist()]
    n, docs, component = columns["n"], columns["doc"], columns["component"]
    single = columns["role"] != PAIR_ONLY
    led = docs == columns["centre"]  # its pairs have been verified
    two_blocks = columns["i"][0] != columns["j"][0]
    # By size, so that a text meets a run of sizes that can still reach the threshold.
    reach = np.searchsorted(n, n * 100 // percent, "right")
    left, right = [], []
    for k in range(len(n) - 1):
        if led[k]:
            continue
        others = np.arange(k + 1, reach[k])
        ok = (component[others] != component[k]) & (single[others] | single[k]) & ~led[others]
        if two_blocks:
            ok &= columns["block"][others] != columns["block"][k]
        others = others[ok]
        if not len(others):
            continue
        width = len(raw[k])
        # Sizes are near one another, and so bitmaps are of one width or the next.
        table = np.stack([_folded(raw[m], width) for m in others.tolist()])
        apart = np.bitwise_count(table ^ raw[k]).sum(axis=1)
        others = others[_may_meet(apart, n[others], n[k], percent)]
        left.append(np.full(len(others), docs[k]))
        right.append(docs[others])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _near_rows(percent: int):
    """Of all groups of a bucket, the texts that have a near pair, once for a centre and blocks.

    Pairs themselves grow with the square of a group and are not sent on.
    """

    def step(bucket: pa.Table) -> pa.Table:
        names = ("key", "i", "j", "doc", "n", "role", "centre", "component", "block", "salt")
        columns = {c: bucket.column(c).combine_chunks().to_numpy() for c in names}
        order = np.lexsort((columns["j"], columns["i"], columns["key"]))
        columns = {c: v[order] for c, v in columns.items()}
        bits = bucket.column("bits").combine_chunks()
        heads = _heads(columns, ("key", "i", "j"))
        found = [np.zeros(0, np.int64)]
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            raw = [np.frombuffer(bits[k].as_py(), np.uint64) for k in order[a:b].tolist()]
            one, two = _group_pairs({c: v[a:b] for c, v in columns.items()}, raw, percent)
            found.append(a + np.flatnonzero(np.isin(columns["doc"][a:b], np.union1d(one, two))))
        at = np.concatenate(found)
        chosen = {c: columns[c][at].astype(np.int64) for c in NEAR}
        order = np.lexsort([chosen[c] for c in reversed(NEAR)])
        first = _heads({c: v[order] for c, v in chosen.items()}, NEAR)
        return pa.table({c: pa.array(v[order][first], pa.int64()) for c, v in chosen.items()})

    return step


def _heads(columns: dict[str, np.ndarray], by: tuple[str, ...]) -> np.ndarray:
    """Where runs of equal columns begin."""
    size = len(columns[by[0]])
    same = np.ones(max(size - 1, 0), bool)
    for c in by:
        same &= columns[c][1:] == columns[c][:-1]
    return np.flatnonzero(np.append(True, ~same)) if size else np.zeros(0, np.int64)


def _near_links(percent: int):
    """Per centre and blocks, links by whole sets: as many as join components, no more."""

    def step(bucket: pa.Table) -> pa.Table:
        columns = {c: bucket.column(c).combine_chunks().to_numpy() for c in NEAR}
        text = bucket.column("text").combine_chunks()
        order = np.lexsort([columns[c] for c in NEAR[:4]])
        columns = {c: v[order] for c, v in columns.items()}
        heads = _heads(columns, NEAR[:4])
        links: list[tuple[int, int]] = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            part = {c: v[a:b] for c, v in columns.items()}
            links += _joining(part, text.take(pa.array(order[a:b])), percent)
        return pa.table({c: pa.array([link[k] for link in links], pa.int64()) for k, c in enumerate("ab")})

    return step


def _joining(columns: dict[str, np.ndarray], text: pa.Array, percent: int) -> list[tuple[int, int]]:
    """Verified links between texts, by size, that were of different components until then."""
    sets: list[np.ndarray] = []
    data, offsets = arrays.buffers(text)
    for low, high, part, places in arrays.blocks(data, offsets):
        rows, hashes = shingles(part, places)
        sets += np.split(hashes, np.cumsum(np.bincount(rows, minlength=high - low))[:-1])
    order = np.argsort([len(own) for own in sets], kind="stable")
    columns, sets = {c: v[order] for c, v in columns.items()}, [sets[k] for k in order.tolist()]
    n = np.array([len(own) for own in sets])
    raw = [np.frombuffer(parity_bits(own, len(own)), np.uint64) for own in sets]
    _, component = np.unique(columns["component"], return_inverse=True)
    two_blocks = columns["i"][0] != columns["j"][0]
    reach = np.searchsorted(n, n * 100 // percent, "right")
    links = []
    for k in range(len(n) - 1):
        others = np.arange(k + 1, reach[k])
        others = others[component[others] != component[k]]
        if two_blocks:
            others = others[columns["block"][others] != columns["block"][k]]
        if not len(others):
            continue
        table = np.stack([_folded(raw[m], len(raw[k])) for m in others.tolist()])
        others = others[_may_meet(np.bitwise_count(table ^ raw[k]).sum(axis=1), n[others], n[k], percent)]
        for m in others.tolist():
            if component[m] == component[k]:
                continue
            both = len(np.intersect1d(sets[k], sets[m], assume_unique=True))
            if 100 * both >= percent * (n[k] + n[m] - both):
                links.append((int(columns["doc"][k]), int(columns["doc"][m])))
                component[component == component[m]] = component[k]
    return links


def linked(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id of every id; the links are found exactly."""
    spark = shipped(docs.sparkSession)
    read = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    census = kept(
        read.mapInArrow(
            arrays.tidy(_census),
            "doc bigint, n bigint, one bigint, two bigint, bits binary, token bigint, texts bigint",
        ),
        "jaccard-census",
    )
    sets = census.filter(F.col("texts").isNull()).select("doc", "n", "one", "two", "bits")
    table = spark.sparkContext.broadcast(
        frequent_table(census.filter(F.col("texts").isNotNull()).select("token", "texts"))
    )
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(1, total * (100 - percent) / 100 / BUCKET_ENTRIES))))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in _chunks(batches):
            rows, hashes = shingles(data, offsets)
            counts = np.bincount(rows, minlength=len(ids))
            one, _ = _identities(hashes, counts)
            # Of equal sets in the chunk the first stands for all; the census links them.
            _, first = np.unique(one, return_index=True)
            once = np.zeros(len(ids), bool)
            once[first] = True
            stays = once[rows]
            entries = index_entries(
                ids.to_numpy(zero_copy_only=False).astype(np.int64), rows[stays], hashes[stays], table.value, percent
            )
            bucket = (arrays.mixed(entries["key"]) >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            entries, bucket = entries[order], bucket[order]
            heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
            ends = np.append(heads[1:], len(bucket)) if len(bucket) else bucket
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[heads].astype(np.int32)),
                    pa.array([pack(entries[a:b]) for a, b in zip(heads.tolist(), ends.tolist(), strict=True)], pa.binary()),
                ],
                names=["bucket", "payload"],
            )

    entries = read.filter(F.col("doc").isNotNull()).mapInArrow(arrays.tidy(packed), "bucket int, payload binary")
    stars = kept(
        entries.groupBy("bucket").applyInArrow(
            arrays.tidy_group(_stars(percent)),
            "a bigint, b bigint, key bigint, doc bigint, n bigint, role bigint, centre bigint",
        ),
        "jaccard-groups",
    )
    first_pairs = kept(stars.filter(F.col("a").isNotNull()).select("a", "b").distinct(), "jaccard-pairs")
    groups = stars.filter(F.col("key").isNotNull()).select("key", "doc", "n", "role", "centre")
    links = kept(_verified(first_pairs, read, sets, percent), "jaccard-links")

    same = sets.filter("n > 0").groupBy("one", "two").agg(F.min("doc").alias("a"))
    copies = sets.filter("n > 0").join(same, ["one", "two"]).select("a", F.col("doc").alias("b"))
    edges = kept(copies.filter("a <> b").union(links), "jaccard-edges")
    found = kept(components(edges), "jaccard-components")

    # Groups in which texts of several components remain.
    placed = groups.join(found.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", "doc", "n", "role", "centre", F.coalesce("component", "doc").alias("component")
    )
    open_keys = (
        placed.groupBy("key")
        .agg(F.count("*").alias("size"), F.sum("n").alias("held"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("key", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("held") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"))
    )
    open_rows = kept(
        placed.join(open_keys, "key").withColumn("block", F.pmod(F.xxhash64("doc"), "n_blocks").cast("int")),
        "jaccard-open",
    )
    spread = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).select(
        "key", "doc", "n", "role", "centre", "component", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
    )
    buckets = max(8, open_rows.count() // 5000)
    # Groups of one centre tend to hold the same pairs, which meet in one bucket.  A centre of many
    # rows gets several, by key, so that each group stays whole; what repeats goes afterwards.
    crowded = kept(
        spread.groupBy("centre", "i", "j")
        .count()
        .filter(F.col("count") > TOGETHER)
        .select("centre", "i", "j", F.ceil(F.col("count") / TOGETHER).alias("salts")),
        "jaccard-crowded",
    )
    near = kept(
        spread.join(crowded, ["centre", "i", "j"], "left")
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.coalesce("salts", F.lit(1))))
        .join(sets.dropDuplicates(["doc"]).select("doc", "bits"), "doc")
        .withColumn("bucket", F.pmod(F.xxhash64("centre", "i", "j", "salt"), F.lit(buckets)))
        .drop("salts")
        .groupBy("bucket")
        .applyInArrow(arrays.tidy_group(_near_rows(percent)), ", ".join(f"{c} bigint" for c in NEAR)),
        "jaccard-near",
    )
    # Whole sets are compared where the pairs were found, and only links that join components go on.
    shares = max(8, (near.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES)
    texts = read.join(near.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    more = kept(
        near.join(texts, "doc")
        .withColumn("bucket", F.pmod(F.xxhash64("centre", "i", "j", "salt"), F.lit(shares)))
        .groupBy("bucket")
        .applyInArrow(arrays.tidy_group(_near_links(percent)), "a bigint, b bigint"),
        "jaccard-links",
    )
    final = components(
        found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more)
    )
    sizes = sets.groupBy("doc").agg(F.max("n").alias("n_shingles"))
    return sizes.join(final.withColumnRenamed("node", "doc"), "doc", "left").select(
        F.col("doc").alias(doc_id), "n_shingles", F.coalesce("component", "doc").alias("component_id")
    )
