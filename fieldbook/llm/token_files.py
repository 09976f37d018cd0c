"""Token ids in binary files: Re-Pair grammar compression per shard, with random access.

Documents are put in order of their id and cut into shards of about `SHARD_IDS` ids.  In a
shard frequent pairs of neighbouring symbols are replaced by nonterminals, in rounds: a
round takes the most frequent pairs, and of overlapping occurrences the better pair's.
A pair never reaches over the end of a document, so that every document is a slice of the
symbols.  Stored are the rules, the length of each rule's expansion, where each document's
symbols end, and the symbols, two bytes each.

Defined results: null text has no ids but the end id; documents of one id are put in order
of their text; a shard holds at least one document, however long.
"""

from __future__ import annotations

import hashlib
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldbook.llm import arrays, pretokens
from fieldbook.llm.store import shipped

END_ID = 1
SHARD_IDS = 1 << 20
#: Symbols are two bytes: ids, the end of a document, then rules.  The end is a symbol of its
#: own, as a text may hold the end id too.
CLOSE = 49408
TERMINALS = CLOSE + 1
MOST_RULES = (1 << 16) - TERMINALS
ROUNDS = 8
PAIRS_A_ROUND = 4096
LEAST_COUNT = 6

_MAGIC = b"RPR1"
_HEAD = struct.Struct("<4sIII")
FILE_SCHEMA = (
    "shard int, block int, doc_ids array<bigint>, n_ids bigint, payload binary"
)


_SLOT_BITS = 17


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(2654435769)) >> np.uint32(32 - _SLOT_BITS)


def _pair_choice(symbols: np.ndarray, closing: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to replace, best first, and where: rank of the pair chosen at each place or -1."""
    left, right = symbols[:-1], symbols[1:]
    keys = left.astype(np.uint32) << np.uint32(16) | right
    whole = ~closing[left]
    ordered = np.sort(keys[whole])
    if not len(ordered):
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    counts = np.diff(np.append(heads, len(ordered)))
    often = counts >= LEAST_COUNT
    pairs, counts = ordered[heads[often]], counts[often]
    pairs = pairs[np.lexsort((pairs, -counts))][:most]
    if not len(pairs):
        return pairs, np.zeros(0, np.int32)
    # A slot for each pair; of pairs that share a slot the worse wait for a later round.
    none = np.int32(len(pairs))
    slot_pair = np.zeros(1 << _SLOT_BITS, np.uint32)
    slot_rank = np.full(1 << _SLOT_BITS, none, np.int32)
    slots = _slot(pairs[::-1])
    slot_pair[slots] = pairs[::-1]
    slot_rank[slots] = np.arange(len(pairs) - 1, -1, -1, dtype=np.int32)
    at = _slot(keys)
    rank = slot_rank[at]
    rank[(slot_pair[at] != keys) | ~whole] = none
    chosen = np.full(len(rank), -1, np.int32)
    best = rank < none
    best[1:] &= rank[1:] < rank[:-1]
    best[:-1] &= rank[:-1] <= rank[1:]
    chosen[best] = rank[best]
    return pairs, chosen


@dataclass
class Grammar:
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    ends: np.ndarray  # per document, in symbols

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids of a run of symbols: rules are unfolded a level at a time."""
        while True:
            rules = symbols >= TERMINALS
            if not rules.any():
                return np.where(symbols == CLOSE, END_ID, symbols).astype(np.uint32)
            counts = 1 + rules
            first = np.cumsum(counts) - counts
            grown = np.empty(int(counts.sum()), np.uint16)
            grown[first[~rules]] = symbols[~rules]
            which = symbols[rules].astype(np.int64) - TERMINALS
            grown[first[rules]] = self.left[which]
            grown[first[rules] + 1] = self.right[which]
            symbols = grown

    def symbol_lengths(self, symbols: np.ndarray) -> np.ndarray:
        rules = symbols >= TERMINALS
        lengths = np.ones(len(symbols), np.int64)
        lengths[rules] = self.lengths[symbols[rules].astype(np.int64) - TERMINALS]
        return lengths

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's document `k`, without touching the others."""
        begin = int(self.ends[k - 1]) if k else 0
        return self.expand(self.symbols[begin : int(self.ends[k])])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids `start` to `stop` of the shard: only symbols that reach into them unfold."""
        ends = np.cumsum(self.symbol_lengths(self.symbols))
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(self.symbols[a:b])[start - skipped : stop - skipped]

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(_MAGIC, len(self.left), len(self.ends), len(self.symbols))
        parts = (
            self.left.astype("<u2"), self.right.astype("<u2"), self.lengths.astype("<u4"),
            self.ends.astype("<u4"), self.symbols.astype("<u2"),
        )
        return head + b"".join(part.tobytes() for part in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Grammar:
        magic, n_rules, n_docs, n_symbols = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = _HEAD.size
        parts = []
        for kind, count in (("<u2", n_rules), ("<u2", n_rules), ("<u4", n_rules), ("<u4", n_docs), ("<u2", n_symbols)):
            parts.append(np.frombuffer(data, kind, count, at))
            at += parts[-1].nbytes
        left, right, lengths, ends, symbols = parts
        return cls(left, right, lengths, symbols, ends)


def compress(ids: np.ndarray, rounds: int = ROUNDS) -> Grammar:
    """The grammar of a shard's ids, each document's followed by CLOSE."""
    symbols = ids.astype(np.uint16)
    closing = np.zeros(1 << 16, bool)  # symbols whose expansion ends a document
    lengths = np.ones(1 << 16, np.int64)
    closing[CLOSE] = True
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    n_rules = 0
    for _ in range(rounds):
        most = min(PAIRS_A_ROUND, MOST_RULES - n_rules)
        if most <= 0 or len(symbols) < 2:
            break
        pairs, chosen = _pair_choice(symbols, closing, most)
        at = np.flatnonzero(chosen >= 0)
        if len(at) * 200 < len(symbols):
            break
        one = (pairs >> np.uint32(16)).astype(np.uint16)
        two = (pairs & np.uint32(0xFFFF)).astype(np.uint16)
        names = TERMINALS + n_rules + np.arange(len(pairs))
        closing[names] = closing[two]
        lengths[names] = lengths[one] + lengths[two]
        left.append(one)
        right.append(two)
        n_rules += len(pairs)
        symbols[at] = names[chosen[at]].astype(np.uint16)
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols = symbols[stays]
    ends = np.flatnonzero(closing[symbols]) + 1
    return Grammar(
        np.concatenate(left) if left else np.zeros(0, np.uint16),
        np.concatenate(right) if right else np.zeros(0, np.uint16),
        lengths[TERMINALS : TERMINALS + n_rules],
        symbols,
        ends,
    )


_READY: dict[str, tuple[Tokenizer, pretokens.WordIds]] = {}


def _ready(file_text: str) -> tuple[Tokenizer, pretokens.WordIds]:
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _READY:
        tokenizer = Tokenizer.from_str(file_text)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        words = pretokens.WordIds(
            lambda fresh: pretokens.flat([c.ids for c in tokenizer.encode_batch_fast(fresh, add_special_tokens=False)])
        )
        _READY[key] = (tokenizer, words)
    return _READY[key]


def encode_rows(
    tokenizer: Tokenizer, words: pretokens.WordIds, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of rows as the tokenizer gives them, and their number for each row.

    Words are looked up; a row with characters whose case, class or composition the lookup
    cannot tell, or with a special token, goes to the tokenizer as a whole.
    """
    text, points, places = pretokens.code_points(data, offsets)
    lower = pretokens.lower_code_points()[points]
    unsure = (pretokens.code_point_kinds()[points] == pretokens.UNSURE) | (lower == 0)
    odd = set((np.searchsorted(places, np.flatnonzero(unsure), "right") - 1).tolist())
    if not unicodedata.is_normalized("NFC", text) or "<|" in text:
        for row, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)):
            if "<|" in text[a:b] or not unicodedata.is_normalized("NFC", text[a:b]):
                odd.add(row)
    starts, ends = pretokens.word_end_words(lower, places)
    rows = np.searchsorted(places, starts, "right") - 1
    if odd:
        plain = ~np.isin(rows, list(odd))
        starts, ends, rows = starts[plain], ends[plain], rows[plain]
    ids, counts = words.of(lower.tobytes().decode("utf-32-le"), lower, starts, ends)
    before = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=before[1:])
    limits = before[np.searchsorted(rows, np.arange(len(places)))]
    if not odd:
        return ids, np.diff(limits)
    found = []
    for row in range(len(places) - 1):
        if row in odd:
            whole = tokenizer.encode(text[places[row] : places[row + 1]], add_special_tokens=False)
            found.append(np.array(whole.ids, np.uint32))
        else:
            found.append(ids[limits[row] : limits[row + 1]])
    return np.concatenate(found), np.array([len(f) for f in found], np.int64)


def _with_ends(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each row's ids followed by CLOSE."""
    total = counts + 1
    last = np.cumsum(total) - 1
    out = np.empty(int(total.sum()), np.uint32)
    kept = np.ones(len(out), bool)
    kept[last] = False
    out[kept] = ids
    out[last] = CLOSE
    return out


def files(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows to be stored as token files: a shard's documents in order, and its grammar."""
    spark = shipped(docs.sparkSession)
    shared = spark.sparkContext.broadcast(vocabulary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, words = _ready(shared.value)
        shard, block = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, pa.Array]] = []

        def packed() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            names = pa.concat_arrays([h[1] for h in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([compress(ids).to_bytes()], pa.binary()),
                ],
                names=["shard", "block", "doc_ids", "n_ids", "payload"],
            )

        for batch in batches:
            data, offsets = arrays.buffers(batch.column("text"))
            for low, high, part, places in arrays.blocks(data, offsets):
                ids = _with_ends(*encode_rows(tokenizer, words, part, places))
                held.append((ids, batch.column("doc_id").slice(low, high - low)))
                if sum(len(h[0]) for h in held) >= SHARD_IDS:
                    yield packed()
                    held.clear()
                    block += 1
        if held:
            yield packed()

    return ordered.mapInArrow(arrays.tidy(step), FILE_SCHEMA)


def read_back(stored: DataFrame) -> DataFrame:
    """Per document of the token files: doc_id, start, n_tokens, ids_crc32."""
    shipped(stored.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                grammar = Grammar.from_bytes(batch.column("payload")[row].as_py())
                ids = grammar.expand(grammar.symbols).astype("<u4")
                ends = np.cumsum(grammar.symbol_lengths(grammar.symbols))[grammar.ends - 1]
                raw = memoryview(ids.view(np.uint8))
                begin = np.append(0, ends[:-1])
                sums = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(begin.tolist(), ends.tolist(), strict=True)
                ]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("shard").take(pa.array([row] * n)),
                        batch.column("block").take(pa.array([row] * n)),
                        batch.column("doc_ids")[row].values,
                        pa.array(begin.astype(np.int64)),
                        pa.array((ends - begin).astype(np.int64)),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    decoded = stored.mapInArrow(
        arrays.tidy(step), "shard int, block int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # Ids before a block: whole shards by one row each, then blocks within their shard.
    sizes = stored.select("shard", "block", "n_ids")
    earlier = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shards_before")
    )
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.join(shards, "shard").select(
        "shard",
        "block",
        (F.col("shards_before") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("before"),
    )
    return decoded.join(before, ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
