"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens; its paths are the correct tokenizations, of which every string
has one.  It starts as one state with an arc for each byte.  Merges are applied in their
order: for (u, v), wherever v can follow u, the state that u leads to is copied without
its arc v, u now leads to the copy, and an arc uv is laid from wherever u leaves to where v
led.  Arcs of one label always end in one state, so a state is known by the label that
leads to it, and the construction is recorded as what each label's state lost and when.

Encoding walks the automaton over a word's bytes, longest label first; it backs up where no
arc continues, and never tries a (place, label) twice.  All words that are new in a block are
walked together, a step of each at a time, after a trie of the labels has told which ones
stand at each byte.  Decoding emits the labels of a path.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from fieldbook.llm import arrays, pretokens
from fieldbook.llm.store import shipped, without_names

_ARCS = 1 << 18
_NEVER = 1 << 40
#: Words of more bytes are walked one by one, and so are the last ones of a block.
WIDE = 64
FEW = 16
#: Pairs of a state and a label that a worker remembers; beyond this it starts over.
MOST_MET = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """Compiled merges of a byte-level vocabulary file (its JSON text)."""

    def __init__(self, file_text: str) -> None:
        file = json.loads(file_text)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.special = special
        self.labels: dict[int, bytes] = {}
        for word, token in file["model"]["vocab"].items():
            self.labels[token] = word.encode() if word in special else bytes(letters[c] for c in word)
        self.labels.update({token: word.encode() for word, token in special.items()})
        hidden = set(special.values())
        self.ids = {label: t for t, label in self.labels.items() if t not in hidden}
        self.longest = max(map(len, self.ids))
        self._arcs: dict[int, bool] = {}
        # Of a merged label: its two parts and the time of its merge.
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        #: What the state behind a label lost, and when.
        self.lost: dict[int, dict[int, int]] = {}
        byte_id = {chr_: self.ids[bytes([b])] for chr_, b in letters.items()}
        names = {word: token for word, token in file["model"]["vocab"].items()}
        for time, merge in enumerate(file["model"]["merges"]):
            one, two = merge.split(" ") if isinstance(merge, str) else merge
            u = byte_id.get(one, names[one])
            v = byte_id.get(two, names[two])
            w = names[one + two]
            if w in self.born or not self._leads(u, v):
                continue  # no path holds u and v side by side
            self.lost.setdefault(u, {})[v] = time
            self.left[w], self.right[w], self.born[w] = u, v, time
        self._arcs.clear()
        size = max(self.labels) + 1
        lengths = np.array([len(self.labels.get(t, b"")) for t in range(size)], np.int64)
        self.label_ends = np.cumsum(lengths)
        self.label_lengths = lengths
        self.label_bytes = np.frombuffer(b"".join(self.labels.get(t, b"") for t in range(size)), np.uint8)
        # The same as arrays, by label; -1 where nothing made a label.
        self._left, self._right, self._born = (np.full(size, -1, np.int64) for _ in range(3))
        for array, known in ((self._left, self.left), (self._right, self.right), (self._born, self.born)):
            array[list(known)] = list(known.values())
        lost = [(u, v, time) for u, gone in self.lost.items() for v, time in gone.items()]
        self._lost = arrays.Numbers(np.array([_pair(u, v) for u, v, _ in lost], np.uint64))
        self._lost_at = np.array([*(time for _, _, time in lost), _NEVER])
        self._forget()
        self._plant()

    def _forget(self) -> None:
        """Pairs of a state and a label that have been met, and whether the arc is there."""
        self._met = arrays.Numbers()
        self._there = np.zeros(0, bool)

    def _plant(self) -> None:
        """The trie of the labels on paths: nodes by parent and byte, and the label at each."""
        nodes: dict[int, int] = {}
        label_at = [-1]
        for label, token in self.ids.items():
            if token in self.born or len(label) == 1:
                node = 0
                for byte in label:
                    node = nodes.setdefault((node + 1) << 8 | byte, len(label_at))
                    if node == len(label_at):
                        label_at.append(-1)
                label_at[node] = token
        self._trie = arrays.Numbers(np.array(list(nodes), np.uint64))  # numbered one below its node
        self._label_at = np.array(label_at)
        # Nodes of two bytes: 0 where no label starts with them.
        firsts = np.repeat(self._trie.find(np.arange(256, dtype=np.uint64) | np.uint64(256)) + 1, 256)
        self._second = self._trie.find((firsts + 1).astype(np.uint64) << np.uint64(8) | np.tile(np.arange(256, dtype=np.uint64), 256)) + 1
        self._byte_label = self._label_at[firsts[::256]]

    def _leads(self, state: int, label: int) -> bool:
        """Whether the state behind label `state` has an arc `label`."""
        limit = _NEVER
        while True:
            # A state inherits what its label's right part had lost before the merge.
            owner, before = state, _NEVER
            while True:
                time = self.lost.get(owner, {}).get(label)
                if time is not None and time < before and time <= limit:
                    return False
                if owner not in self.born:
                    break
                before = min(before, self.born[owner])
                owner = self.right[owner]
            if label not in self.born:
                return True
            # The arc was laid where the label's left part could leave at that time.
            limit = min(limit, self.born[label])
            label = self.left[label]

    def arc(self, state: int, label: int) -> bool:
        key = state << 20 | label
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) > _ARCS:
                self._arcs.clear()
            known = self._arcs[key] = self._leads(state, label)
        return known

    def _arcs_of(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """As arc, of many pairs."""
        pairs = _pair(states, labels)
        at = self._met.find(pairs)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            if self._met.count > MOST_MET:
                self._forget()
                unknown = np.arange(len(pairs))
            fresh, first = np.unique(pairs[unknown], return_index=True)
            first = unknown[first]
            self._there = np.append(self._there, self._lead(states[first], labels[first]))
            self._met.add(fresh)
            at[unknown] = self._met.find(pairs[unknown])
        return self._there[at]

    def _lead(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """As _leads, of many pairs."""
        leads = np.ones(len(states), bool)
        limits = np.full(len(states), _NEVER)
        open_ = np.arange(len(states))
        while len(open_):
            some, owners, label = open_, states[open_], labels[open_]
            before = np.full(len(some), _NEVER)
            while len(some):
                times = self._lost_at[self._lost.find(_pair(owners, label))]
                gone = (times < before) & (times <= limits[some])
                leads[some[gone]] = False
                born = self._born[owners]
                on = ~gone & (born >= 0)
                some, label = some[on], label[on]
                before = np.minimum(before[on], born[on])
                owners = self._right[owners[on]]
            born = self._born[labels[open_]]
            on = leads[open_] & (born >= 0)
            open_ = open_[on]
            limits[open_] = np.minimum(limits[open_], born[on])
            labels = labels.copy()
            labels[open_] = self._left[labels[open_]]
        return leads

    def _standing(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The labels that stand at each byte, within its word, short before long: all of them,
        and where each byte's begin (and the last one's end)."""
        # Every byte is a label.
        at = np.arange(len(data))
        found_at, found = [at], [self._byte_label[data]]
        at = np.flatnonzero(at + 1 < ends)
        node = self._second[data[at].astype(np.int64) << 8 | data[at + 1]]
        depth = 2
        while len(at):
            on = node > 0
            at, node = at[on], node[on]
            label = self._label_at[node]
            ending = label >= 0
            found_at.append(at[ending])
            found.append(label[ending])
            on = at + depth < ends[at]
            at, node = at[on], node[on]
            node = self._trie.find((node + 1).astype(np.uint64) << np.uint64(8) | data[at + depth]) + 1
            depth += 1
        found_at, found = np.concatenate(found_at), np.concatenate(found)
        sizes = self.label_lengths[found]
        order = np.argsort(found_at << 8 | sizes)
        return found[order], np.append(0, np.cumsum(np.bincount(found_at, minlength=len(data))))

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The paths of all words one after another, and the number of labels of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rest = lengths > WIDE
        rest |= lengths == 0
        walked = np.flatnonzero(~rest)
        lengths = lengths[walked]
        counts = np.zeros(len(words), np.int64)
        wide = int(lengths.max(initial=1))
        # By word and depth: the labels of its path.
        paths = np.zeros(len(walked) * wide, np.int32)
        if len(walked):
            data = np.frombuffer(b"".join(words[k] for k in walked.tolist()), np.uint8)
            ends = np.cumsum(lengths)
            found, begin = self._standing(data, np.repeat(ends, lengths))
            dead = np.zeros(len(found), bool)
            # Where each label of a path starts, the one to try there next (down to the byte's
            # first), and the one that is taken.
            place, next_, taken = (np.zeros(len(paths), np.int32) for _ in range(3))
            own = np.arange(len(walked)) * wide
            place[own] = ends - lengths
            next_[own] = begin[ends - lengths + 1] - 1
            depth = np.zeros(len(walked), np.int64)
            open_ = np.arange(len(walked))
            while len(open_) > FEW:
                deep = depth[open_]
                own = open_ * wide + deep
                at, tried = place[own], next_[own]
                # Back where nothing is left to try: what led here is dead.
                over = tried < begin[at]
                if over.any():
                    back = over & (deep > 0)
                    depth[open_[back]] -= 1
                    dead[taken[own[back] - 1]] = True
                    if not back[over].all():  # no path: as encode answers
                        open_ = open_[~over | back]
                        continue
                good = ~over & ~dead[tried]
                next_[own] = tried - 1
                check = np.flatnonzero(good & (deep > 0))
                good[check] = self._arcs_of(paths[own[check] - 1], found[tried[check]])
                own, at, tried, some = own[good], at[good], tried[good], open_[good]
                label = found[tried]
                paths[own], taken[own] = label, tried
                at = at + self.label_lengths[label]
                ended = at == ends[some]
                counts[walked[some[ended]]] = depth[some[ended]] + 1
                goes = ~ended
                own, at = own[goes] + 1, at[goes]
                depth[some[goes]] += 1
                place[own], next_[own] = at, begin[at + 1] - 1
                if ended.any():
                    open_ = open_[counts[walked[open_]] == 0]
            rest[walked[counts[walked] == 0]] = True
        alone = {k: self.encode(words[k]) for k in np.flatnonzero(rest).tolist()}
        for k, path in alone.items():
            counts[k] = len(path)
        ids = np.empty(int(counts.sum()), np.uint32)
        upto = np.cumsum(counts)
        done = ~rest[walked]
        here = counts[walked[done]]
        ids[arrays.ranges(upto[walked[done]] - here, here)] = paths.reshape(-1, wide)[done][np.arange(wide) < here[:, None]]
        for k, path in alone.items():
            ids[upto[k] - len(path) : upto[k]] = path
        return ids, counts

    def encode(self, word: bytes) -> list[int]:
        whole = self.ids.get(word)
        if whole is not None and (whole in self.born or len(word) == 1):
            return [whole]  # a label that a merge made is the path of its own bytes
        end, ids, longest = len(word), self.ids, self.longest
        path: list[int] = []
        # Per open place: where it starts, and the length of the label tried next.
        places = [(0, min(longest, end))]
        dead: set[tuple[int, int]] = set()
        while places:
            at, size = places.pop()
            while size:
                label = ids.get(word[at : at + size])
                size -= 1
                if label is None or (at, label) in dead:
                    continue
                if label not in self.born and size:
                    continue  # no merge makes it
                if path and not self.arc(path[-1], label):
                    continue
                break
            else:
                if path:
                    last = path.pop()
                    dead.add((at - len(self.labels[last]), last))
                continue
            places.append((at, size))
            path.append(label)
            at += size + 1
            if at == end:
                return path
            places.append((at, min(longest, end - at)))
        return path

    def emit(self, ids: np.ndarray) -> np.ndarray:
        """The labels of a path, byte after byte."""
        lengths = self.label_lengths[ids]
        return self.label_bytes[arrays.ranges(self.label_ends[ids] - lengths, lengths)]


def _pair(state, label):
    """One number for a state and a label: never 0."""
    if isinstance(state, np.ndarray):
        return (state + 1).astype(np.uint64) << np.uint64(32) | label.astype(np.uint64)
    return (state + 1) << 32 | label


_READY: dict[str, tuple[Automaton, pretokens.WordIds]] = {}


def ready(file_text: str) -> tuple[Automaton, pretokens.WordIds]:
    """The worker's automaton of a vocabulary file, with the words it has met."""
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _READY:
        automaton = Automaton(file_text)
        words = pretokens.WordIds(lambda fresh: automaton.encode_all([w.encode("utf-8", "surrogatepass") for w in fresh]))
        _READY[key] = (automaton, words)
    return _READY[key]


def encode_rows(
    automaton: Automaton, words: pretokens.WordIds, data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block of rows, and the number of ids of each row."""
    if any(data.tobytes().find(name.encode()) >= 0 for name in automaton.special):
        return _encode_with_special(automaton, words, data, offsets)
    text, points, places = pretokens.code_points(data, offsets)
    starts, ends = pretokens.byte_level_words(points, places)
    ids, counts = words.of(text, points, starts, ends)
    before = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=before[1:])
    return ids, np.diff(before[np.searchsorted(starts, places)])


def _encode_with_special(automaton, words, data, offsets) -> tuple[np.ndarray, np.ndarray]:
    """As encode_rows, where a special token stands in a row: it parts what is around it."""
    names = sorted(automaton.special, key=len, reverse=True)
    found, counts = [], []
    raw = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        pieces: list[bytes | int] = [raw[a:b]]
        for name in names:
            cut: list[bytes | int] = []
            for piece in pieces:
                if isinstance(piece, int):
                    cut.append(piece)
                    continue
                for k, rest in enumerate(piece.split(name.encode())):
                    if k:
                        cut.append(automaton.special[name])
                    if rest:
                        cut.append(rest)
            pieces = cut
        row = []
        for piece in pieces:
            if isinstance(piece, int):
                row.append(np.array([piece], np.uint32))
            else:
                part = np.frombuffer(piece, np.uint8)
                row.append(encode_rows(automaton, words, part, np.array([0, len(part)]))[0])
        ids = np.concatenate(row) if row else np.zeros(0, np.uint32)
        found.append(ids)
        counts.append(len(ids))
    return np.concatenate(found) if found else np.zeros(0, np.uint32), np.array(counts, np.int64)


def _digest(data: np.ndarray, ends: np.ndarray) -> list[str]:
    begin = 0
    found = []
    view = memoryview(np.ascontiguousarray(data))
    for end in ends.tolist():
        found.append(hashlib.sha256(view[begin:end]).hexdigest())
        begin = end
    return found


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = True
) -> DataFrame:
    """`docs` without the text, with n_tokens, ids_sha256, decoded_sha256 and the ids.

    `vocabulary` is the text of a byte-level BPE file.  Null text is empty: no tokens, and
    the digests of nothing.  Decoded bytes that are no UTF-8 become replacement characters.
    Repeated rows are encoded alike; columns that have one of these names give way.
    """
    spark = shipped(docs.sparkSession)
    docs = without_names(docs, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else []))
    shared = spark.sparkContext.broadcast(vocabulary)
    rest = [f for f in docs.schema.fields if f.name != text]
    added = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ] + ([StructField("ids", ArrayType(IntegerType()))] if with_ids else [])
    names = [f.name for f in rest]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, words = ready(shared.value)
        for batch in batches:
            data, offsets = arrays.buffers(batch.column(text))
            for low, high, part, places in arrays.blocks(data, offsets):
                ids, counts = encode_rows(automaton, words, part, places)
                ends = np.cumsum(counts)
                decoded = automaton.emit(ids)
                upto = np.zeros(len(ids) + 1, np.int64)
                np.cumsum(automaton.label_lengths[ids], out=upto[1:])
                sizes = upto[ends]
                try:
                    decoded.tobytes().decode()
                    digests = _digest(decoded, sizes)
                except UnicodeDecodeError:
                    digests = [
                        hashlib.sha256(decoded[a:b].tobytes().decode("utf-8", "replace").encode()).hexdigest()
                        for a, b in zip(np.append(0, sizes[:-1]).tolist(), sizes.tolist(), strict=True)
                    ]
                columns = [batch.column(c).slice(low, high - low) for c in names]
                columns += [
                    pa.array(counts, pa.int64()),
                    pa.array(_digest(ids.astype("<u4").view(np.uint8), ends * 4), pa.string()),
                    pa.array(digests, pa.string()),
                ]
                if with_ids:
                    limits = np.append(0, ends).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(limits), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f.name for f in added)])

    return docs.select(*names, text).mapInArrow(arrays.tidy(step), StructType([*rest, *added]))
