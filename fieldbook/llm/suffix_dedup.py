"""Removal of byte strings that start in an earlier document too, by sorting suffixes.

A byte goes if a `LENGTH`-byte string over it also starts in a document of a smaller id.
Candidates are met at anchors: of the `GRAM`-byte strings in each window of `LENGTH` bytes
the one of least hash, so that equal windows have equal anchors.  Consecutive windows of
one anchor are a run.

1. Every document sends (anchor, run, document), packed by anchor.  A run that equals a
   run of a smaller document is covered as a whole.  A chunk of documents settles what it
   can before anything is sent, so that a run found in many documents is sent once a chunk.
2. Where an anchor has several different runs, the least document of each sends the bytes.
   The suffixes at the runs' windows are sorted by radix: by as many bytes at once as fit
   beside their group, then those that tie by the next ones, until prefix polynomial hashes
   tell that the rest of a tie is equal.  Equal neighbours are verified byte by byte, and the
   least document of equal windows covers the others.  An anchor with very many runs is split
   by window hash.
3. Documents are read again with what was found for them, and cut.

Runs are told apart by 96 bits of hash.  Defined results: null text is empty; texts shorter
than a window lose nothing; equal ids do not cover one another; a null id counts as the
largest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import arrays
from fieldbook.llm.jaccard import pack, unpack
from fieldbook.llm.store import kept, shipped, without_names

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1  # grams in a window, and most windows of a run
CHUNK_BYTES = 1 << 22
#: Windows hashed at once: what a piece needs stays in a processor's cache.
PIECE_BYTES = 1 << 15
#: Runs that a bucket of looked-into anchors should stand for.
BUCKET_ENTRIES = 250_000
#: Beyond so many buckets (a power of 2), one of runs holds four times that: a chunk sends a row
#: to each, and each a row to every bucket of documents.
FEW_BITS = 7
#: Runs of one anchor that a part of it should hold.
SPLIT = 20_000
_LAST = (1 << 63) - 1
_MASK = np.uint64((1 << 48) - 1)
_ALL = np.uint32(0xFFFFFFFF)

_RUN = np.dtype([("key", "<u8"), ("run", "<u8"), ("doc", "<i8")])
_CUT = np.dtype([("doc", "<i8"), ("text", "<u8"), ("start", "<u4"), ("end", "<u4")])
_COVER = np.dtype([("doc", "<i8"), ("run", "<u8"), ("mask", "<u4")])
_WANT = np.dtype([("doc", "<i8"), ("run", "<u8"), ("parts", "<u2")])
#: Where the eight bytes lie that tell whether two windows are equal.
_EIGHTS = (*range(0, LENGTH - 7, 8), LENGTH - 8)
_HEAD = np.dtype([("key", "<u8"), ("run", "<u8"), ("doc", "<i8"), ("left", "u1"), ("n", "u1"), ("part", "<u2"), ("parts", "<u2")])


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, anchor place, anchor and run hash of each run."""
    found = []
    # Whether a window starts here: the row has so many bytes left.
    starts_window = np.zeros(len(data) + 1, np.int8)
    long = np.diff(offsets) >= LENGTH
    starts_window[offsets[:-1][long]] += 1
    starts_window[offsets[1:][long] - LENGTH + 1] -= 1
    starts_window = np.cumsum(starts_window, dtype=np.int8)[: len(data)].view(bool)
    total = max(len(data) - LENGTH + 1, 0)
    for low in range(0, total, PIECE_BYTES):
        # With the window before, and those that a run of this piece may go on to: how runs are
        # told apart does not depend on where pieces end.
        before = min(low, 1)
        high = min(low + PIECE_BYTES + SPAN, total)
        inside = starts_window[low - before : high]
        if not inside.any():
            continue
        part = data[low - before : high + LENGTH - 1]
        sums = arrays.prefix_hashes(part)
        n = len(part) - GRAM + 1
        _, down = arrays.powers(n)
        least = sums[GRAM:] - sums[:n]
        least *= down
        hashes = arrays.mixed(least)
        # Least hash of SPAN neighbours, with its place in the low bits: the first of equals.
        np.bitwise_and(hashes, ~np.uint64((1 << 24) - 1), out=least)
        least |= np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < SPAN:
            least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
        anchors = (least & np.uint64((1 << 24) - 1)).astype(np.int32)
        # Windows of two rows are never neighbours.
        new = inside.copy()
        new[1:] &= (anchors[1:] != anchors[:-1]) | ~inside[:-1]
        new[:before] = False
        start = np.flatnonzero(new)
        # A run ends before the next one, or where no more windows start.
        upto = np.append(0, np.cumsum(inside, dtype=np.int32))
        count = np.diff(np.append(upto[start], upto[-1])).astype(np.int64)
        own = np.searchsorted(start, PIECE_BYTES + before)  # later ones start in the next piece
        start, count = start[:own], count[:own]
        if not own:
            continue
        anchor = anchors[start].astype(np.int64)
        left = (anchor - start).astype(np.uint64)
        run = arrays.mixed(arrays.range_hashes(sums, start, start + count + LENGTH - 1) + left * np.uint64(0x9E3779B97F4A7C15))
        place = low - before
        rows = np.searchsorted(offsets, start + place, "right") - 1
        found.append((rows, start + place, count, anchor + place, hashes[anchor] & _MASK, run & _MASK))
    if not found:
        return tuple(np.zeros(0, np.uint64 if k > 3 else np.int64) for k in range(6))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = arrays.buffers(batch.column("text"))
        for low, high, part, places in arrays.blocks(data, offsets, CHUNK_BYTES):
            yield batch.slice(low, high - low), part, places


def _bucketed(entries: np.ndarray, bucket: np.ndarray) -> tuple[list[int], list[bytes]]:
    order = np.argsort(bucket, kind="stable")
    entries, bucket = entries[order], bucket[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    ends = [*list(heads[1:]), len(bucket)] if len(bucket) else []
    return [int(bucket[h]) for h in heads], [pack(entries[a:b]) for a, b in zip(heads, ends, strict=True)]


def _arranged(entries: np.ndarray) -> np.ndarray:
    """Order of entries by key, run and document."""
    # Keys and runs have 48 bits: one number holds the key and the run's highest bits.
    lead = entries["key"] << np.uint64(16) | entries["run"] >> np.uint64(32)
    order = np.argsort(lead)
    lead = lead[order]
    same = lead[1:] == lead[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    some = order[tied]
    order[tied] = some[np.lexsort((entries["doc"][some], entries["run"][some], lead[tied]))]
    return order


def _buckets(values: np.ndarray, bits: int) -> np.ndarray:
    return (arrays.mixed(values.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _rows(kinds: list[tuple[str, list[int], list[bytes]]]) -> pa.RecordBatch:
    """Columns kind, bucket and payload of packed entries."""
    kind = [k for k, buckets, _ in kinds for _ in buckets]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kind, pa.string()),
            pa.array([b for _, buckets, _ in kinds for b in buckets], pa.int32()),
            pa.array([p for _, _, payloads in kinds for p in payloads], pa.binary()),
        ],
        names=["kind", "bucket", "payload"],
    )


_PACKED = "kind string, bucket int, payload binary"


def _send(bits: int, doc_bits: int):
    """A chunk's runs once each, and the cuts that the chunk itself can tell."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _chunks(batches):
            docs = batch.column("doc").to_numpy()
            rows, first, count, _, keys, run = runs(data, offsets)
            entries = np.empty(len(rows), _RUN)
            entries["key"], entries["run"], entries["doc"] = keys, run, docs[rows]
            order = _arranged(entries)
            ordered = entries[order]
            head = np.ones(len(ordered), bool)
            head[1:] = (ordered["key"][1:] != ordered["key"][:-1]) | (ordered["run"][1:] != ordered["run"][:-1])
            least = ordered["doc"][head][np.cumsum(head) - 1] if len(ordered) else ordered["doc"]
            later = np.sort(order[ordered["doc"] > least])
            cuts = np.zeros(0, _CUT)
            if len(later):
                start = first[later] - offsets[rows[later]]
                end = start + count[later] + LENGTH - 1
                # Runs of a row come in order; those that touch are one cut.
                new = np.ones(len(later), bool)
                new[1:] = (rows[later][1:] != rows[later][:-1]) | (start[1:] > end[:-1])
                heads = np.flatnonzero(new)
                cuts = np.empty(len(heads), _CUT)
                cuts["doc"] = docs[rows[later[heads]]]
                cuts["text"] = text_identities(data, offsets)[rows[later[heads]]]
                cuts["start"] = start[heads]
                cuts["end"] = end[np.append(heads[1:], len(later)) - 1]
            sent = ordered[head]
            yield _rows(
                [
                    ("run", *_bucketed(sent, _buckets(sent["key"], bits))),
                    ("cut", *_bucketed(cuts, _buckets(cuts["doc"], doc_bits))),
                ]
            )

    return step


def text_identities(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each whole row."""
    found = np.zeros(len(offsets) - 1, np.uint64)
    for low, high, part, places in arrays.blocks(data, offsets):
        sums = arrays.prefix_hashes(part)
        found[low:high] = arrays.mixed(arrays.range_hashes(sums, places[:-1], places[1:]) + np.diff(places).astype(np.uint64))
    return found


def _settle(doc_bits: int):
    """Per bucket of anchors: runs that a smaller document has, and runs to be looked into."""

    def step(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_pylist()
        payloads = group.column("payload")
        passed = [k for k, kind in enumerate(kinds) if kind == "cut"]
        out = [("cut", [group.column("bucket")[0].as_py()] * len(passed), [payloads[k].as_py() for k in passed])]
        parts = [unpack(payloads[k].as_py(), _RUN) for k, kind in enumerate(kinds) if kind == "run"]
        if parts:
            entries = np.concatenate(parts)
            entries = entries[_arranged(entries)]
            new_key = np.append(True, entries["key"][1:] != entries["key"][:-1])
            head = new_key.copy()
            head[1:] |= entries["run"][1:] != entries["run"][:-1]
            least = entries["doc"][head][np.cumsum(head) - 1]
            later = entries[entries["doc"] > least]
            covers = np.empty(len(later), _COVER)
            covers["doc"], covers["run"], covers["mask"] = later["doc"], later["run"], _ALL
            heads = entries[head]
            key = np.cumsum(new_key[head]) - 1
            n_runs = np.bincount(key)
            begin = np.cumsum(n_runs) - n_runs
            several = (np.minimum.reduceat(heads["doc"], begin) < np.maximum.reduceat(heads["doc"], begin))[key]
            asked = heads[several]
            wants = np.empty(len(asked), _WANT)
            wants["doc"], wants["run"] = asked["doc"], asked["run"]
            wants["parts"] = np.minimum(65535, -(-n_runs[key[several]] // SPLIT))
            out.append(("cover", *_bucketed(covers, _buckets(covers["doc"], doc_bits))))
            out.append(("want", *_bucketed(wants, _buckets(wants["doc"], doc_bits))))
        return pa.Table.from_batches([_rows(out)])

    return step


def _by_document(kinds: dict[str, np.dtype]):
    """Packed entries of a bucket of documents, as one row of bytes per kind and document."""

    def step(group: pa.Table) -> pa.Table:
        names = group.column("kind").to_pylist()
        payloads = group.column("payload")
        found: dict[int, dict[str, bytes]] = {}
        for kind, shape in kinds.items():
            parts = [unpack(payloads[k].as_py(), shape) for k, name in enumerate(names) if name == kind]
            if not parts:
                continue
            entries = np.concatenate(parts)
            entries = entries[np.argsort(entries["doc"], kind="stable")]
            heads = np.flatnonzero(np.append(True, entries["doc"][1:] != entries["doc"][:-1]))
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(entries)], strict=True):
                found.setdefault(int(entries["doc"][a]), {})[kind] = entries[a:b].tobytes()
        return pa.table(
            {"doc": pa.array(list(found), pa.int64())}
            | {k: pa.array([row.get(k) for row in found.values()], pa.binary()) for k in kinds}
        )

    return step


def _answer(bits: int):
    """The bytes of the runs that are asked for, packed by anchor."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _chunks(batches):
            docs = batch.column("doc").to_numpy()
            rows, first, count, anchor, keys, run = runs(data, offsets)
            wants = [np.frombuffer(raw, _WANT) for raw in batch.column("want").to_pylist()]
            rows_of = np.repeat(np.arange(len(wants)), list(map(len, wants)))
            wants = np.concatenate(wants)
            # A batch has fewer rows than the bits that a run's hash leaves free.
            asked = wants["run"] | rows_of.astype(np.uint64) << np.uint64(48)
            by_run = np.argsort(asked)
            asked, parts = asked[by_run], wants["parts"][by_run]
            # A run that repeats in a text is one.
            found, once = np.unique(run | rows.astype(np.uint64) << np.uint64(48), return_index=True)
            at = np.minimum(np.searchsorted(asked, found), len(asked) - 1)
            hit = asked[at] == found
            at, once = at[hit], once[hit]
            if not len(once):
                continue
            heads = np.zeros(len(once), _HEAD)
            heads["key"], heads["run"], heads["doc"] = keys[once], run[once], docs[rows[once]]
            heads["left"], heads["n"], heads["parts"] = (anchor - first)[once], count[once], parts[at]
            yield from _contexts(heads, data, first[once], bits)

    return step


def _contexts(entries: np.ndarray, data: np.ndarray, first: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Runs and their bytes, which start at `first`, by bucket."""
    split = entries["parts"] > 1
    extra, extra_first = [], []
    for k in np.flatnonzero(split).tolist():
        # To each part of the anchor that one of its windows falls on.
        n = int(entries["n"][k])
        sums = arrays.prefix_hashes(data[first[k] : first[k] + n + LENGTH - 1])
        at = np.arange(n)
        falls = np.unique(arrays.mixed(arrays.range_hashes(sums, at, at + LENGTH)) % np.uint64(entries["parts"][k]))
        copy = np.repeat(entries[k : k + 1], len(falls))
        copy["part"] = falls
        extra.append(copy)
        extra_first.append(np.full(len(falls), first[k]))
    entries = np.concatenate([entries[~split], *extra])
    first = np.concatenate([first[~split], *extra_first])
    bucket = _buckets(entries["key"] + entries["part"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), bits)
    order = np.argsort(bucket, kind="stable")
    entries, first, bucket = entries[order], first[order], bucket[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts[1:], len(bucket))
    sizes = entries["n"].astype(np.int64) + LENGTH - 1
    upto = np.append(0, np.cumsum(sizes))
    texts = data[arrays.ranges(first, sizes)].tobytes()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[cuts], pa.int32()),
            pa.array([pack(entries[a:b]) for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)], pa.binary()),
            pa.array([texts[a:b] for a, b in zip(upto[cuts].tolist(), upto[ends].tolist(), strict=True)], pa.binary()),
        ],
        names=["bucket", "heads", "bytes"],
    )


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that orders as they do; zeros follow the end."""
    padded = np.append(data, np.zeros(15, np.uint8))
    found = np.empty(len(data) + 8, np.uint64)
    for k in range(8):
        own = found[k::8]
        own[:] = np.frombuffer(padded, ">u8", count=len(own), offset=k) if len(padded) >= k + 8 * len(own) else 0
    return found[: len(data)]


def suffix_order(data: np.ndarray, sums: np.ndarray, suffixes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Order of `suffixes` by group and by their first LENGTH bytes: a radix sort.

    Suffixes that tie on the bytes read so far are sorted by the next ones, as many as fit
    into a number beside the tie; a tie of which all hashes are equal is not looked at again.
    """
    order = np.arange(len(suffixes))
    eights = _eights(data)
    hashes = arrays.range_hashes(sums, suffixes, suffixes + LENGTH)
    ties = groups.astype(np.uint64)
    open_ = np.arange(len(suffixes))  # the places of `order` that are not settled
    done = 0
    while len(open_) and done < LENGTH:
        free = 64 - int(ties.max()).bit_length()
        size = min(free // 8, 8, LENGTH - done)
        mine = order[open_]
        value = eights[suffixes[mine] + done] >> np.uint64(64 - 8 * size)
        value |= ties << np.uint64(8 * size) if size < 8 else 0
        by = np.argsort(value)
        mine, value = mine[by], value[by]
        order[open_] = mine
        done += size
        new = np.append(True, value[1:] != value[:-1])
        heads = np.flatnonzero(new)
        which = np.cumsum(new) - 1
        found = hashes[mine]
        differ = np.add.reduceat(found != found[heads][which], heads, dtype=np.int64) > 0
        stays = differ[which]
        open_ = open_[stays]
        ties = (np.cumsum(differ) - 1)[which[stays]].astype(np.uint64)
    return order


def sort_suffixes(data: np.ndarray, sums: np.ndarray, suffixes: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """`suffixes` in order within each group (`groups` ascends)."""
    return suffixes[suffix_order(data, sums, suffixes, groups)]


def equal_neighbours(data: np.ndarray, sums: np.ndarray, order: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Whether each suffix (but the first) equals the one before it, verified by its bytes."""
    hashes = arrays.range_hashes(sums, order, order + LENGTH)
    same = (groups[1:] == groups[:-1]) & (hashes[1:] == hashes[:-1])
    at = np.flatnonzero(same)
    eights = _eights(data)
    for place in _EIGHTS:
        at = at[eights[order[at] + place] == eights[order[at + 1] + place]]
    same[:] = False
    same[at] = True
    return same


def _look_into(doc_bits: int):
    """Per bucket: sorts the windows of its runs, and tells which a smaller document has."""

    def step(group: pa.Table) -> pa.Table:
        heads = np.concatenate([unpack(h.as_py(), _HEAD) for h in group.column("heads")])
        data = np.frombuffer(b"".join(b.as_py() for b in group.column("bytes")), np.uint8)
        n = heads["n"].astype(np.int64)
        sizes = n + LENGTH - 1
        begin = np.cumsum(sizes) - sizes
        sums = arrays.prefix_hashes(data)
        owner = np.repeat(np.arange(len(heads)), n)
        inner = arrays.ranges(np.zeros(len(n), np.int64), n)
        suffixes = begin[owner] + inner
        parts = heads["parts"][owner]
        if (parts > 1).any():
            falls = arrays.mixed(arrays.range_hashes(sums, suffixes, suffixes + LENGTH)) % np.maximum(parts, 1).astype(np.uint64)
            here = (parts <= 1) | (falls == heads["part"][owner])
            owner, inner, suffixes = owner[here], inner[here], suffixes[here]
        # Equal windows have one anchor at one distance.
        by_anchor = np.lexsort((heads["part"], heads["key"]))
        key, part = heads["key"][by_anchor], heads["part"][by_anchor]
        anchor = np.empty(len(heads), np.int64)
        anchor[by_anchor] = np.cumsum(np.append(False, (key[1:] != key[:-1]) | (part[1:] != part[:-1])))
        groups = anchor[owner] * SPAN + heads["left"][owner] - inner
        order = suffix_order(data, sums, suffixes, groups)
        which, at = owner[order], inner[order]
        docs = heads["doc"][which]
        head = np.append(True, ~equal_neighbours(data, sums, suffixes[order], groups[order]))
        starts = np.flatnonzero(head)
        least = np.minimum.reduceat(docs, starts)[np.cumsum(head) - 1]
        covered = np.flatnonzero(docs > least)
        # Each window of a run is met once: the sum of its bits is their union.
        bits = np.bincount(which[covered], np.ldexp(1.0, at[covered].astype(np.int32)), len(heads))
        some = np.flatnonzero(bits)
        covers = np.empty(len(some), _COVER)
        covers["doc"], covers["run"], covers["mask"] = heads["doc"][some], heads["run"][some], bits[some].astype(np.uint32)
        # One entry per run of a document.
        covers = covers[np.lexsort((covers["run"], covers["doc"]))]
        if len(covers):
            firsts = np.flatnonzero(
                np.append(True, (covers["doc"][1:] != covers["doc"][:-1]) | (covers["run"][1:] != covers["run"][:-1]))
            )
            masks = np.bitwise_or.reduceat(covers["mask"], firsts)
            covers = covers[firsts]
            covers["mask"] = masks
        return pa.Table.from_batches([_rows([("cover", *_bucketed(covers, _buckets(covers["doc"], doc_bits)))])])

    return step


def _removed(
    data: np.ndarray, offsets: np.ndarray, cuts: list[bytes | None], covers: list[list[bytes | None]]
) -> np.ndarray:
    """Whether each byte of a chunk goes."""
    change = np.zeros(len(data) + 1, np.int32)
    if any(cuts):
        own = [np.frombuffer(c or b"", _CUT) for c in cuts]
        rows = np.repeat(np.arange(len(own)), list(map(len, own)))
        own = np.concatenate(own)
        same = own["text"] == text_identities(data, offsets)[rows]
        own, begin = own[same], offsets[rows[same]]
        np.add.at(change, begin + own["start"], 1)
        np.add.at(change, begin + own["end"], -1)
    parts = [(row, np.frombuffer(c, _COVER)) for known in covers for row, c in enumerate(known) if c]
    if parts:
        entries = np.concatenate([part for _, part in parts])
        # A batch has fewer rows than the bits that a run's hash leaves free.
        keys = entries["run"] | np.repeat(np.array([row for row, _ in parts], np.uint64), [len(p) for _, p in parts]) << np.uint64(48)
        order = np.argsort(keys)
        keys, masks_of = keys[order], entries["mask"][order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, masks_of = keys[heads], np.bitwise_or.reduceat(masks_of, heads)
        rows, first, count, _, _, run = runs(data, offsets)
        wanted = run | rows.astype(np.uint64) << np.uint64(48)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == wanted)
        first, count, masks = first[hit], count[hit], masks_of[at[hit]]
        whole = masks == _ALL
        np.add.at(change, first[whole], 1)
        np.add.at(change, first[whole] + count[whole] + LENGTH - 1, -1)
        first, count, masks = first[~whole], count[~whole], masks[~whole]
        for bit in range(SPAN):
            at = first[((masks >> np.uint32(bit)) & np.uint32(1)).astype(bool) & (count > bit)] + bit
            np.add.at(change, at, 1)
            np.add.at(change, at + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def deduplicated(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and kept_sha256; the text only with `keep_text`.

    A kept text is cut by whole characters: one of which a byte stays is kept.  Columns of
    `docs` that have one of these names (or are called kept_text, with `keep_text`) give way.
    """
    spark = shipped(docs.sparkSession)
    docs = without_names(docs, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else []))
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    read = docs.select(key.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    look_bits = max(3, math.ceil(math.log2(max(1, total * 2 / (SPAN + 1) / BUCKET_ENTRIES))))
    bits = max(min(look_bits, FEW_BITS), look_bits - 2)
    doc_bits = max(3, bits - 2)

    sent = read.mapInArrow(arrays.tidy(_send(bits, doc_bits)), _PACKED)
    settled = sent.groupBy("bucket").applyInArrow(arrays.tidy_group(_settle(doc_bits)), _PACKED)
    known = kept(
        settled.groupBy("bucket").applyInArrow(
            arrays.tidy_group(_by_document({"cut": _CUT, "cover": _COVER, "want": _WANT})),
            "doc bigint, cut binary, cover binary, want binary",
        ),
        "suffix-known",
    )
    # One exchange of the texts serves both joins below.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = F.struct(*[c for c in docs.columns if c != text])
    texts = docs.select(key.alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"), rest.alias("rest")).repartition(parts, "doc")
    asked = texts.join(known.filter(F.col("want").isNotNull()).select("doc", "want"), "doc")
    answers = asked.mapInArrow(arrays.tidy(_answer(look_bits)), "bucket int, heads binary, bytes binary")
    looked = (
        answers.groupBy("bucket")
        .applyInArrow(arrays.tidy_group(_look_into(doc_bits)), _PACKED)
        .groupBy("bucket")
        .applyInArrow(arrays.tidy_group(_by_document({"cover": _COVER})), "doc bigint, cover binary")
        .withColumnRenamed("cover", "more")
    )
    joined = texts.join(known.select("doc", "cut", "cover"), "doc", "left").join(looked, "doc", "left")
    carried = docs.select(rest.alias("rest")).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _chunks(batches):
            known_of = [batch.column(c).to_pylist() for c in ("cut", "cover", "more")]
            counts = np.zeros((len(offsets) - 1, 3), np.int64)
            digests, left = [], []
            removed = _removed(data, offsets, known_of[0], known_of[1:])
            for row in range(len(offsets) - 1):
                own = data[offsets[row] : offsets[row + 1]]
                gone = removed[offsets[row] : offsets[row + 1]]
                spans = int(np.count_nonzero(np.diff(np.append(False, gone).astype(np.int8)) == 1))
                counts[row] = len(own), int(gone.sum()), spans
                stays = own[~gone]
                digests.append(hashlib.sha256(stays.tobytes()).hexdigest())
                if keep_text:
                    # A character goes if all its bytes do.
                    lead = (own & 0xC0) != 0x80
                    which = np.cumsum(lead) - 1
                    alive = np.zeros(int(lead.sum()), bool)
                    alive[which[~gone]] = True
                    left.append(own[alive[which]].tobytes().decode() if len(own) else "")
            columns = [
                batch.column("rest"),
                pa.array(counts[:, 0]),
                pa.array(counts[:, 1]),
                pa.array(counts[:, 2]),
                pa.array(digests, pa.string()),
            ]
            names = ["rest", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(left, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = carried.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    if keep_text:
        schema = schema.add("kept_text", "string")
    cut = joined.mapInArrow(arrays.tidy(step), schema)
    return cut.select("rest.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept_text"] if keep_text else []))
