"""The prefix trie of conversations, built as z-fast tries of shards.

A conversation is a string of turns.  The signature of its first d turns, a chained digest of
128 bits, names the trie node at depth d, whichever task meets it.

A shard's trie is compacted: only branching nodes, ends and roots are held, each edge standing
for all the depths on it.  A hash table maps a node's handle, the signature at the 2-fattest
depth of its edge (the depth with most trailing zero bits), to the node.  Where a conversation
leaves the trie is found by fat binary search: it asks the table at the 2-fattest depth of the
interval that is left, log(depth) times, and settles the last edge by signatures.  Conversations
come in batches: all of a batch are located in the trie as it stands, and inserted by the node
where they leave it, the search going on from there.  Expanding the edges gives one row per
node with what the shard's conversations add up to; rows of one signature are then added
over shards, so a first turn that a third of all conversations share is one row a shard.

What concerns subtrees is brought into sums over conversations too.  A node belongs to its
smallest member.  The nodes of one conversation are the lower end of its path, so with the depth at
which its own part starts, every conversation adds its own tokens and its own leaf to each node
on its path, and a second run over the shards adds them up.

Texts stay on the JVM side, where they become digests and lengths; only these are
shuffled.  A conversation is cut into segments of `segment` turns while it streams by, each a
string of its own below the signature it starts from, so a task holds a bounded part of it,
however long it is.

Defined results: a null role or text is empty; turns of equal number are ordered by the digest
of role and text, a null number first; rows without a conv_id take no part; repeated turns are
turns; an empty table has no nodes.  Two prefixes are one node if their signatures agree;
that two different ones do is as likely as a collision of a 128-bit digest.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import arrays
from fieldbook.llm.store import kept, shipped

#: Turns of one conversation that are handled as one string.
SEGMENT = 1_024
#: Turns of all strings in one trie.
SHARD_TURNS = 200_000
#: Conversations of one family, whose first member lends the others its first turns.
FAMILY = 100
_HEAD = 6
_WIDTH = 16
#: conv_ids joined into one piece before the pieces of a node meet.
_PIECE = 50_000
ROOT = bytes(_WIDTH)


def borrowed(conv_id: int) -> int:
    """How many first turns a conversation takes from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % _HEAD


def chained(signature: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(signature + turn, digest_size=_WIDTH).digest()


_PATHS = (
    "conv_id long, start long, root binary, signatures binary, lengths binary, before long, last boolean, total long"
)


def paths(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rebuilt conversations as segments of signatures and token lengths.

    Each takes its first turns from the first of its family, and its own after as many.
    """
    shipped(conversations.sparkSession)
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    conv = F.col("conv_id").cast("long")
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        (conv - conv % FAMILY).alias("family"),
        conv.alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).cast("long").alias("length"),
    )
    first = F.when(F.col("conv_id") == F.col("family"), 0).otherwise(1)
    dealt = turns.repartition("family").sortWithinPartitions(
        "family", first, "conv_id", F.col("turn").asc_nulls_first(), "digest", "length"
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        family = conv = None
        head: list[tuple[bytes, int]] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("family", "conv_id", "digest", "length")]
            for group, own, digest, length in zip(*columns, strict=True):
                if own != conv:
                    if conv is not None:
                        out.append(path.segment(True))
                    if group != family:
                        family, head = group, []
                    path, skip = _Path(own, segment), 0
                    if own != group:
                        skip = borrowed(own)
                        for given in head[:skip]:
                            out.extend(path.add(*given))
                    conv = own
                if own == group and len(head) < _HEAD:
                    head.append((digest, length))
                if skip:
                    skip -= 1
                else:
                    out.extend(path.add(digest, length))
            if len(out) >= 1_000:
                yield _batch(out, _PATHS)
                out = []
        if conv is not None:
            out.append(path.segment(True))
        yield _batch(out, _PATHS)

    return dealt.mapInArrow(arrays.tidy(step), _PATHS)


class _Path:
    """A conversation that streams by, cut into segments."""

    def __init__(self, conv_id: int, segment: int):
        self.conv_id, self.size = conv_id, segment
        self.start, self.root, self.before = 0, ROOT, 0
        self.here, self.signatures, self.lengths = ROOT, [], []

    def segment(self, last: bool) -> tuple:
        after = self.before + sum(self.lengths)
        row = (
            self.conv_id, self.start, self.root, b"".join(self.signatures),
            np.array(self.lengths, np.int64).tobytes(), self.before, last, after if last else None,
        )
        self.start, self.root, self.before = self.start + len(self.signatures), self.here, after
        self.signatures, self.lengths = [], []
        return row

    def add(self, digest: bytes, length: int) -> Iterator[tuple]:
        if len(self.signatures) == self.size:
            yield self.segment(False)
        self.here = chained(self.here, digest)
        self.signatures.append(self.here)
        self.lengths.append(length)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the largest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class _String:
    """One segment: its signatures by absolute depth."""

    __slots__ = ("start", "end", "root", "signatures", "lengths", "before")

    def __init__(self, start: int, root: bytes, signatures: bytes, lengths: bytes, before: int):
        self.start, self.root, self.signatures = start, root, signatures
        self.end = start + len(signatures) // _WIDTH
        self.lengths, self.before = lengths, before

    def at(self, depth: int) -> bytes:
        if depth == self.start:
            return self.root
        k = (depth - self.start) * _WIDTH
        return self.signatures[k - _WIDTH : k]


class _Node:
    """A compacted node: its edge covers the depths (low, depth] of `string`."""

    __slots__ = ("string", "low", "depth", "parent", "children", "sums", "least")

    def __init__(self, string: _String, low: int, depth: int, parent: _Node | None):
        self.string, self.low, self.depth, self.parent = string, low, depth, parent
        self.children: dict[bytes, _Node] = {}
        self.sums, self.least = [0, 0], None


class ZFastTrie:
    """Strings of turns below one or more roots, found by the handles of their nodes."""

    def __init__(self):
        self.roots: dict[tuple[int, bytes], _Node] = {}
        self.handles: dict[tuple[int, bytes], _Node] = {}
        self.turns = 0

    def _root(self, string: _String) -> _Node:
        key = (string.start, string.root)
        if key not in self.roots:
            self.roots[key] = _Node(string, string.start, string.start, None)
        return self.roots[key]

    def _handle(self, node: _Node) -> tuple[int, bytes]:
        depth = two_fattest(node.low, node.depth)
        return depth, node.string.at(depth)

    def locate(self, string: _String, node: _Node | None = None) -> _Node:
        """The deepest node whose whole string begins this one, at or below `node`."""
        node = node or self._root(string)
        low, high = node.depth, string.end
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get((depth, string.at(depth)))
            if found is None:
                high = depth - 1
            elif found.depth <= string.end and found.string.at(found.depth) == string.at(found.depth):
                node, low = found, found.depth
            else:
                # It leaves on this node's edge, whose upper end is reached.
                return found.parent
        return node

    def insert(self, string: _String, node: _Node) -> _Node:
        """The node at which the string ends, made if it is new; `node` was located for it."""
        if node.depth == string.end:
            return node
        child = node.children.get(string.at(node.depth + 1))
        if child is None:
            return self._hang(string, node)
        same, other = node.depth + 1, min(string.end, child.depth)
        while same < other:
            middle = (same + other + 1) // 2
            if child.string.at(middle) == string.at(middle):
                same = middle
            else:
                other = middle - 1
        split = self._split(child, same)
        return split if same == string.end else self._hang(string, split)

    def _hang(self, string: _String, node: _Node) -> _Node:
        leaf = _Node(string, node.depth, string.end, node)
        node.children[string.at(node.depth + 1)] = leaf
        self.handles[self._handle(leaf)] = leaf
        return leaf

    def _split(self, child: _Node, depth: int) -> _Node:
        above = _Node(child.string, child.low, depth, child.parent)
        child.parent.children[child.string.at(child.low + 1)] = above
        del self.handles[self._handle(child)]
        child.low, child.parent = depth, above
        above.children[child.string.at(depth + 1)] = child
        self.handles[self._handle(child)] = child
        self.handles[self._handle(above)] = above
        return above

    def insert_batch(self, strings: list[tuple[_String, tuple[int, int], int]]) -> None:
        """(string, what it adds, its id), all located before any is inserted."""
        located = sorted(((self.locate(s), s, sums, key) for s, sums, key in strings), key=lambda x: id(x[0]))
        for node, group in groupby(located, key=lambda x: x[0]):
            for _, string, sums, key in group:
                end = self.insert(string, self.locate(string, node))
                end.sums[0] += sums[0]
                end.sums[1] += sums[1]
                end.least = key if end.least is None else min(end.least, key)
                self.turns += string.end - string.start

    def expanded(self) -> Iterator[tuple]:
        """A row for each depth of each edge, with what the strings through it add up to."""
        nodes = [n for root in self.roots.values() for n in _below(root)]
        for node in sorted(nodes, key=lambda n: -n.depth):
            if node.parent is not None:
                node.parent.sums[0] += node.sums[0]
                node.parent.sums[1] += node.sums[1]
                known = [x for x in (node.parent.least, node.least) if x is not None]
                node.parent.least = min(known)
        for node in nodes:
            string = node.string
            if node.depth == 0:
                yield (ROOT, None, 0, 0, 0, *node.sums, node.least)
            lengths = np.frombuffer(string.lengths, np.int64)
            until = string.before + np.cumsum(lengths)
            for depth in range(node.low + 1, node.depth + 1):
                at = depth - string.start - 1
                yield (
                    string.at(depth), string.at(depth - 1), depth, int(lengths[at]), int(until[at]),
                    *node.sums, node.least,
                )


def _below(root: _Node) -> Iterator[_Node]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(node.children.values())


_NODES = (
    "signature binary, parent binary, depth long, length long, until long, first long, second long, conv_id long"
)


def folded(strings: DataFrame, first: Column, second: Column, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Sums of `first` and `second` over the members of each node, and the smallest member."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in batches:
            names = ("start", "root", "signatures", "lengths", "before", "first", "second", "conv_id")
            columns = [batch.column(n).to_pylist() for n in names]
            trie.insert_batch(
                [(_String(*row[:5]), (row[5], row[6]), row[7]) for row in zip(*columns, strict=True)]
            )
            if trie.turns >= shard_turns:
                yield from _batches(trie.expanded())
                trie = ZFastTrie()
        yield from _batches(trie.expanded())

    def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for row in rows:
            waiting.append(row)
            if len(waiting) == 20_000:
                yield _batch(waiting, _NODES)
                waiting = []
        yield _batch(waiting, _NODES)

    sent = strings.select(
        "conv_id", "start", "root", "signatures", "lengths", "before",
        first.cast("long").alias("first"), second.cast("long").alias("second"),
    )
    return sent.mapInArrow(arrays.tidy(step), _NODES).groupBy("signature").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("length").alias("length"),
        F.first("until").alias("until"), F.sum("first").alias("first"), F.sum("second").alias("second"),
        F.min("conv_id").alias("conv_id"),
    )


def ends(strings: DataFrame) -> DataFrame:
    """For each signature at which conversations end, the digest of their ids in ascending order.

    Ids are joined into pieces where they lie in order; a digest reads the pieces of its node.
    """
    last = strings.filter("last").select(
        F.when(F.length("signatures") > 0, F.expr(f"substring(signatures, -{_WIDTH}, {_WIDTH})"))
        .otherwise(F.col("root")).alias("signature"),
        "conv_id",
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids = None, []
        for batch in batches:
            done = []
            for signature, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if signature != here or len(ids) == _PIECE:
                    if ids:
                        done.append((here, ids[0], ",".join(map(str, ids))))
                    here, ids = signature, []
                ids.append(conv)
            yield _batch(done, "signature binary, least long, ids string")
        yield _batch([(here, ids[0], ",".join(map(str, ids)))] if ids else [], "signature binary, least long, ids string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, digest = None, None
        for batch in batches:
            done = []
            for signature, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if signature != here:
                    if here is not None:
                        done.append((here, digest.hexdigest()))
                    here, digest = signature, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield _batch(done, "signature binary, ends_sha256 string")
        yield _batch([(here, digest.hexdigest())] if here is not None else [], "signature binary, ends_sha256 string")

    ordered = last.repartitionByRange("signature", "conv_id").sortWithinPartitions("signature", "conv_id")
    joined = ordered.mapInArrow(arrays.tidy(pieces), "signature binary, least long, ids string")
    met = joined.repartition("signature").sortWithinPartitions("signature", "least")
    return met.mapInArrow(arrays.tidy(digests), "signature binary, ends_sha256 string")


def nodes(conversations: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per trie node: its smallest member, depth, parent's member, and what it holds.

    Reads conv_id, turn, role and text; other columns of any name are ignored.
    """
    strings = kept(paths(conversations, segment), "conversation-paths")
    whole = F.col("last") & (F.col("start") == 0)
    totals = strings.filter(F.col("last") & (F.col("start") > 0)).select("conv_id", "total")
    summed = strings.filter(whole).unionByName(
        strings.filter(~whole).drop("total").join(totals, "conv_id").select(strings.columns)
    )
    merged = folded(summed, F.lit(1), F.col("total"), shard_turns)
    found = kept(merged.withColumnsRenamed({"first": "n_convs", "second": "tokens"}), "trie-nodes")
    children = found.filter("depth > 0").groupBy(F.col("parent").alias("signature")).agg(
        F.count("*").alias("n_children")
    )
    found = kept(
        found.join(children, "signature", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))),
        "trie-children",
    )
    # The own part of each conversation's path, its tokens, and whether it ends in a leaf.
    own = found.groupBy("conv_id").agg(
        F.min(F.col("until") - F.col("length")).alias("own_before"),
        F.max("until").alias("own_until"),
        F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf"),
    )
    own = kept(own, "trie-owners")
    weighed = strings.drop("total").join(own, "conv_id")
    below = folded(weighed, F.col("own_until") - F.col("own_before"), F.col("leaf"), shard_turns).select(
        "signature", F.col("first").alias("own_tokens"), F.col("second").alias("n_leaves")
    )
    parents = found.select(F.col("signature").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    before = F.col("until") - F.col("length")
    # Members other than the owner add their own part, which is below; the owner what is left of its path.
    distinct = F.col("own_tokens") - (F.col("own_until") - F.col("own_before")) + F.col("own_until") - before
    return (
        found.join(below, "signature")
        .join(own, "conv_id")
        .join(parents, "parent", "left")
        .join(ends(strings), "signature", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("tokens") - F.col("n_convs") * before - distinct).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
