"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are lexicon entries, word beginnings that the labelled training rows tie to toxic
texts, hand-written patterns that speak for either class, and the label of a sampled row.
A voter fires or abstains.  The label model holds, for each voter, how often it fires on
toxic and on other texts, which gives its accuracy, and how far pairs of voters go together
within the classes.  All of it is estimated by expectation maximisation on the sample's votes,
where a voter counts for less the more it repeats others.  How often labels are right is
estimated too, from how they agree with what the other voters believe.  A linear classifier
over the votes, without the label's, is trained on the posterior and scores every text.

An entry is taken if the toxic share of its rows is high and too far above that of all rows to
be chance: the Chernoff bound of the chance stays below one in the number of labelled rows.
Lexicon counts cover all labelled training rows.  Only the sample passes the driver: `sample`
rows a class.  An entry that fires in no sampled row has no weight of its own, but counts
in the patterns.  Defined results: null text is empty and gets the score of a text without
words; a document with several labels has the worst; of repeated ids one text is learned from;
without labelled texts of both classes nothing is learned and every score is the same.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fieldbook.llm import arrays
from fieldbook.llm.store import kept, shipped, without_names

#: Labelled training rows per class that the label model and the classifier are fitted on.
SAMPLE = 4000
#: Least toxic share of an entry's rows, were both classes equally common.
LEAST_PRECISION = 0.9
SHORTEST, LONGEST = 3, 12
#: Word beginnings counted before a task gives their counts on.
COUNTED = 1 << 18
#: What a toxic text adds to an entry's number; a task sees fewer texts than that.
TOXIC = 1 << 32
#: Words of a text looked at at once.
SPANS = 4096
#: Slots of the filter of labelled ids: so many for an id, and this many at most.  They decide
#: how many texts without a label are shuffled in vain, never which are learned from.
SLOTS_PER_ID, MOST_SLOTS = 16, 1 << 26
#: Rounds of expectation maximisation at most; they end when no belief moves.
ROUNDS = 100
#: Belief in a sampled row's label at the start; the fit estimates how far to trust it.
FIRST_BELIEF = 0.9
#: Belief beyond which the voters are sure of a row, when labels are judged by them.
SURE = 0.95
#: Correlations nearer to zero than so many standard errors are taken to be none.
CERTAIN = 4.0

#: Patterns by name, over counts of a text: words, capitals, marks, different entries hit.
#: The last speaks for the other class.
PATTERNS = {
    "two_entries": lambda c: c["entries"] >= 2,
    "three_entries": lambda c: c["entries"] >= 3,
    "dense_entries": lambda c: c["hits"] * 20 >= np.maximum(c["words"], 1),
    "one_hit": lambda c: c["hits"] == 1,
    "shouting": lambda c: c["capitals"] * 2 > np.maximum(c["bytes"], 1),
    "exclaiming": lambda c: c["marks"] * 10 > np.maximum(c["words"], 1),
    "calm": lambda c: (c["marks"] == 0) & (c["capitals"] * 20 < np.maximum(c["bytes"], 1)),
}


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _slot(doc_id: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), doc_id.cast("string")), F.lit(slots))


def id_filter(ids: DataFrame, count: int) -> np.ndarray:
    """Bits of the slots that ids fall into: of bounded size, the driver sees no id."""
    slots = 64
    while slots < min(MOST_SLOTS, count * SLOTS_PER_ID):
        slots *= 2
    slot = ids.select(_slot(F.col("doc_id"), slots).alias("slot"))
    word = F.shiftright("slot", 6).cast("int").alias("word")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    found = slot.groupBy(word).agg(F.bit_or(bit).alias("bits")).toPandas()
    bits = np.zeros(slots // 64, np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits


def maybe_labelled(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """`docs` without rows whose id is in no slot: all that have a label, and few others."""
    shared = shipped(docs.sparkSession).sparkContext.broadcast(bits)
    names = docs.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            slots = batch.column("__slot").to_numpy(zero_copy_only=False)
            stays = (held[slots >> 6] >> (slots & 63)) & 1
            kept_rows = batch.filter(pa.array(stays.astype(bool)))
            yield kept_rows.select(names)

    known = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    slot = _slot(F.col("doc_id"), 64 * len(bits)).alias("__slot")
    return known.select("*", slot).mapInArrow(arrays.tidy(step), docs.schema)


def begin_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """entry, toxic, other: texts of each class in these batches with a word that begins so.

    An entry comes out more than once where `COUNTED` are found.  A block of text is held at a
    time: a batch holds some ten of them, and a task several batches.
    """
    found: dict[str, int] = {}  # texts of the other class, and toxic ones times TOXIC

    def counts() -> pa.RecordBatch:
        both = np.fromiter(found.values(), np.int64, len(found))
        batch = pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string(), size=len(found)), pa.array(both // TOXIC), pa.array(both % TOXIC)],
            names=["entry", "toxic", "other"],
        )
        found.clear()
        return batch

    for batch in batches:
        data, offsets = arrays.buffers(batch.column("text"))
        toxic = batch.column("toxic").to_pylist()
        for low, high, part, places in arrays.blocks(data, offsets):
            lower = arrays.LOWER[part]
            starts, ends, _, rows = arrays.words(lower, places, arrays.LETTERS)
            raw = lower.tobytes()
            first = np.searchsorted(rows, np.arange(high - low + 1)).tolist()
            for row in range(high - low):
                words = set()
                for at in range(first[row], first[row + 1], SPANS):
                    upto = min(at + SPANS, first[row + 1])
                    words.update([raw[a:b] for a, b in zip(starts[at:upto].tolist(), ends[at:upto].tolist())])
                begins = set()
                for word in words:
                    letters = word.decode("utf-8", "replace")
                    for n in range(SHORTEST, min(len(letters), LONGEST) + 1):
                        begins.add(letters[:n])
                one = TOXIC if toxic[low + row] else 1
                for begin in begins:
                    found[begin] = found.get(begin, 0) + one
                if len(found) > COUNTED:
                    yield counts()
    yield counts()


def lexicon_candidates(texts: DataFrame) -> DataFrame:
    """entry, toxic, other: texts of each class with a word that begins so."""
    counted = texts.select("text", "toxic").mapInArrow(
        arrays.tidy(begin_counts), "entry string, toxic bigint, other bigint"
    )
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def evidence(toxic: Column, other: Column, n_toxic: int, n_other: int) -> Column:
    """Nats against an entry's toxic share being chance (Chernoff); 0 where it is no higher."""
    usual = n_toxic / (n_toxic + n_other)
    share = toxic / (toxic + other)
    nats = toxic * F.log(share / usual) + F.when(other > 0, other * F.log((1 - share) / (1 - usual))).otherwise(0)
    return F.when(share > usual, nats).otherwise(0.0)


class Lexicon:
    """Word beginnings, found in whole columns of text."""

    def __init__(self, entries: list[str]) -> None:
        self.entries = entries
        self._by_length: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        lengths = defaultdict(list)
        for k, entry in enumerate(entries):
            lengths[len(entry.encode())].append(k)
        for length, which in sorted(lengths.items()):
            data = np.frombuffer(b"".join(entries[k].encode() for k in which), np.uint8)
            at = np.arange(len(which)) * length
            hashes = arrays.mixed(arrays.range_hashes(arrays.prefix_hashes(data), at, at + length))
            order = np.argsort(hashes)
            slots = np.zeros(1 << 16, bool)
            slots[(hashes >> np.uint64(48)).astype(np.int64)] = True
            self._by_length.append((length, hashes[order], np.array(which)[order], slots))

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Counts of each row, and the (row, entry) pairs found, each once."""
        n = len(offsets) - 1
        lower = arrays.LOWER[data]
        starts, ends, _, rows = arrays.words(lower, offsets, arrays.LETTERS)
        found_rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        done = 0
        for low, high in arrays._pieces(arrays.LETTERS[lower], offsets, arrays.BLOCK_BYTES):
            upto = int(np.searchsorted(starts, high))
            sums = arrays.prefix_hashes(lower[low:high])
            begin, size = starts[done:upto] - low, ends[done:upto] - starts[done:upto]
            for length, hashes, which, slots in self._by_length:
                long = np.flatnonzero(size >= length)
                h = arrays.mixed(arrays.range_hashes(sums, begin[long], begin[long] + length))
                near = np.flatnonzero(slots[(h >> np.uint64(48)).astype(np.int64)])
                at = np.minimum(np.searchsorted(hashes, h[near]), len(hashes) - 1)
                hit = near[hashes[at] == h[near]]
                found_rows.append(rows[done:upto][long[hit]])
                found.append(which[at[hashes[at] == h[near]]])
            done = upto
        hit_rows, hit = np.concatenate(found_rows), np.concatenate(found)
        pairs = np.unique(hit_rows * np.int64(len(self.entries) + 1) + hit)
        rows_once, once = pairs // (len(self.entries) + 1), pairs % (len(self.entries) + 1)
        capital = (data >= 65) & (data <= 90)
        marks = data == ord("!")
        sizes = np.diff(offsets)
        counts = {
            "words": np.bincount(rows, minlength=n),
            "bytes": sizes,
            "hits": np.bincount(hit_rows, minlength=n),
            "entries": np.bincount(rows_once, minlength=n),
            "capitals": np.diff(np.append(0, np.cumsum(capital))[offsets]),
            "marks": np.diff(np.append(0, np.cumsum(marks))[offsets]),
        }
        return counts, rows_once, once


@dataclass
class LabelModel:
    """Rates at which voters fire, given the class, and how pairs of them go together."""

    on_toxic: np.ndarray
    on_other: np.ndarray
    together: np.ndarray  # correlations within the classes, where they are certain
    prior: float
    label_on_toxic: float = 0.5
    label_on_other: float = 0.5

    @property
    def worth(self) -> np.ndarray:
        """What a voter's vote counts: one, divided among those that repeat it."""
        return 1 / np.maximum(self.together, 0).sum(axis=1)

    @property
    def accuracy(self) -> np.ndarray:
        """How often a voter that fires speaks for the right class."""
        toxic, other = self.prior * self.on_toxic, (1 - self.prior) * self.on_other
        right = np.where(self.on_toxic >= self.on_other, toxic, other)
        return right / (toxic + other)

    def posterior(self, votes: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
        """Belief that a row is toxic, from its votes and, where given, its label (0 or 1)."""
        fire = np.log(self.on_toxic / self.on_other) * self.worth
        rest = np.log((1 - self.on_toxic) / (1 - self.on_other)) * self.worth
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (fire - rest) + rest.sum()
        if labels is not None:
            yes = np.log(self.label_on_toxic / self.label_on_other)
            no = np.log((1 - self.label_on_toxic) / (1 - self.label_on_other))
            odds = odds + np.where(labels > 0, yes, no)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _rates(belief: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often voters fire on toxic and on other rows, by these beliefs."""
    other = 1 - belief
    return tuple(np.clip((b @ votes + 1) / (b.sum() + 2), 1e-4, 1 - 1e-4) for b in (belief, other))


def _label_rates(belief: np.ndarray, labels: np.ndarray, first: float) -> tuple[float, float]:
    """How often a label says toxic on toxic and on other rows, where the voters are sure.

    Doubtful rows tell little of labels.  Ten rows more stand for what was believed at first.
    """
    toxic, other = labels[belief > SURE], labels[belief < 1 - SURE]
    return (
        (toxic.sum() + 10 * first) / (len(toxic) + 10),
        (other.sum() + 10 * (1 - first)) / (len(other) + 10),
    )


def fit_label_model(votes: np.ndarray, told: np.ndarray, prior: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation; votes is rows by voters, 0 or 1.

    `told` has the log odds that labels give a row at the start.  After that a label is a voter of
    estimated rates, counted against what the other voters believe without it: a label that
    were to confirm itself would always come out right.
    """
    labels = (told > 0).astype(float)
    belief = 1 / (1 + np.exp(-told))
    first = float(np.abs(belief - 0.5).mean() + 0.5)
    n = len(votes)
    both_fire = votes.T @ votes / n
    model = None
    for _ in range(rounds):
        # Covariance within the classes: what is left once the class rates are taken off.
        left = both_fire
        for share in (belief, 1 - belief):
            rate = share @ votes / max(share.sum(), 1e-9)
            left = left - share.sum() / n * np.outer(rate, rate)
        scale = np.sqrt(np.maximum(np.diag(left), 1e-9))
        together = np.clip(left / np.outer(scale, scale), -1, 1)
        together[np.abs(together) < CERTAIN / np.sqrt(n)] = 0
        np.fill_diagonal(together, 1)
        model = LabelModel(*_rates(belief, votes), together, prior)
        model.label_on_toxic, model.label_on_other = _label_rates(
            model.posterior(votes), labels, first
        )
        after = model.posterior(votes, labels)
        moved = float(np.abs(after - belief).max())
        belief = after
        if moved < 1e-4:
            break
    return model


def fit_linear(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the intercept is last."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + ridge * beta
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Classifier:
    lexicon: list[str]
    weights: np.ndarray  # of lexicon entries, then of patterns
    intercept: float


def votes_of(lexicon: Lexicon, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    counts, rows, entries = lexicon.hits(data, offsets)
    votes = np.zeros((len(offsets) - 1, len(lexicon.entries) + len(PATTERNS)))
    votes[rows, entries] = 1
    for k, pattern in enumerate(PATTERNS.values()):
        votes[:, len(lexicon.entries) + k] = pattern(counts)
    return votes


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Learns from labelled rows that are not held out: doc_id, text; doc_id, toxic."""
    spark = shipped(docs.sparkSession)
    told_of = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Labelled training rows that have a text.
    allowed = kept(
        labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(told_of.select("doc_id"), "doc_id", "left_semi"),
        "toxicity-labels",
    )
    sizes = {row["toxic"]: row["count"] for row in allowed.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    prior = (n_toxic + 1) / (n_toxic + n_other + 2)
    if not n_toxic or not n_other:
        return Classifier([], np.zeros(len(PATTERNS)), float(np.log(prior / (1 - prior))))
    chosen = None
    for kind in (0, 1):
        part = allowed.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    texts = kept(
        told_of.join(kept(chosen, "toxicity-chosen"), "doc_id").dropDuplicates(["doc_id"]),
        "toxicity-sample",
    )
    # Only texts that can have a label are shuffled, however many have none.
    likely_told = maybe_labelled(told_of, id_filter(allowed, n_toxic + n_other))
    every = likely_told.join(allowed, "doc_id").dropDuplicates(["doc_id"])
    balance = n_toxic / n_other
    precision = F.col("toxic") / (F.col("toxic") + balance * F.col("other") + 1)
    likely = kept(
        lexicon_candidates(every).filter(
            (precision >= LEAST_PRECISION)
            & (evidence(F.col("toxic"), F.col("other"), n_toxic, n_other) >= np.log(n_toxic + n_other))
        ),
        "toxicity-entries",
    )
    # A longer beginning that rules nothing out only repeats the shorter one.
    shorter = likely.select(
        F.col("entry").alias("parent"), F.col("toxic").alias("of_toxic"), F.col("other").alias("of_other")
    )
    parent = F.substring("entry", F.lit(1), F.length("entry") - 1)
    same = (F.col("of_toxic") * 0.95 <= F.col("toxic")) & (F.col("of_other") <= F.col("other") + 1)
    entries = (
        likely.withColumn("parent", parent)
        .join(shorter, "parent", "left")
        .filter(~F.coalesce(same, F.lit(False)))
        .select("entry")
        .orderBy("entry")
        .collect()
    )
    lexicon = [row["entry"] for row in entries]
    shared = spark.sparkContext.broadcast(lexicon)
    width = len(lexicon) + len(PATTERNS)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(shared.value)
        for batch in batches:
            data, offsets = arrays.buffers(batch.column("text"))
            for low, high, part, places in arrays.blocks(data, offsets):
                votes = votes_of(own, part, places)
                packed = np.packbits(votes.astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic").slice(low, high - low).cast(pa.int64()),
                        pa.array([row.tobytes() for row in packed], pa.binary()),
                    ],
                    names=["toxic", "votes"],
                )

    rows = texts.mapInArrow(arrays.tidy(step), "toxic bigint, votes binary").collect()
    toxic = np.array([row["toxic"] for row in rows], float)
    packed = np.stack([np.frombuffer(row["votes"], np.uint8) for row in rows])
    votes = np.unpackbits(packed, axis=1)[:, :width].astype(np.float32)
    order = np.lexsort((*packed.T, toxic))  # the same sums whatever order rows came in
    toxic, votes = toxic[order], votes[order]
    fires = votes.any(axis=0)
    fires[len(lexicon) :] = True
    told = np.where(toxic == 1, 1, -1) * np.log(FIRST_BELIEF / (1 - FIRST_BELIEF))
    held = {kind: float((toxic == kind).sum()) for kind in (0, 1)}
    model = fit_label_model(votes[:, fires], told, held[1] / len(rows))
    belief = model.posterior(votes[:, fires], toxic)
    # As common as in all training rows, not as in the sample.
    weights = np.where(toxic == 1, n_toxic / held[1], n_other / held[0])
    weights = weights * len(rows) / weights.sum()
    beta = fit_linear(votes[:, fires], belief, weights)
    own = np.zeros(width)
    own[fires] = beta[:-1]
    return Classifier(lexicon, own, float(beta[-1]))


def score(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """`docs` with the column score, 0 to 1, of every whole text; a column so named gives way."""
    spark = shipped(docs.sparkSession)
    docs = without_names(docs, "score")
    shared = spark.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        lexicon = Lexicon(own.lexicon)
        n = len(own.lexicon)
        for batch in batches:
            data, offsets = arrays.buffers(batch.column(text))
            odds = np.full(batch.num_rows, own.intercept)
            for low, high, part, places in arrays.blocks(data, offsets):
                counts, rows, entries = lexicon.hits(part, places)
                np.add.at(odds[low:high], rows, own.weights[entries])
                for k, pattern in enumerate(PATTERNS.values()):
                    odds[low:high] += own.weights[n + k] * pattern(counts)
            scores = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores)], names=[*batch.schema.names, "score"]
            )

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(arrays.tidy(step), schema)
