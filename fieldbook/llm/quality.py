"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Each signal of a text (shares per thousand) has a fixed list of cutoffs, loosest first.
Per stratum, labelled documents tell how many good ones a cutoff would reject.  A cutoff
is certified if an exact binomial test refutes, at the corrected level, that it rejects
more than its part of the allowed risk; cutoffs of a signal are tested in their fixed order
until one fails, and the level is divided over all signals and strata (Bonferroni over the
sequences), so that with probability `confidence` no stratum loses more than `risk` of its
good documents.  Of the certified cutoffs the one that gains most is used.  A stratum with
too few labels has no certified cutoff and keeps what the base rules keep.

Defined results: null text has no words and fails the base rules; a null stratum is a
stratum of its own; a document labelled more than once counts once, as its worst label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.store import without_names

_BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 5

# Cutoffs in thousandths, loosest first; a text is rejected at a share of at least this.
CUTOFFS = {
    "symbols": [500, 400, 300, 200, 150, 100, 70, 50, 30, 20, 10, 5],
    "duplicate_lines": [950, 900, 800, 700, 600, 500, 400, 300, 200, 100],
    "repeated_windows": [950, 900, 800, 700, 600, 500, 400, 300, 200, 150, 100],
    "repeated_words": [950, 900, 850, 800, 750, 700, 650, 600, 550, 500, 450, 400],
    "capitals": [900, 800, 700, 600, 500, 400, 300, 200, 150, 100],
}
RISK = 0.05
CONFIDENCE = 0.95
#: So many bad documents must be caught for each good one that is lost.
PRICE = 10.0


#: What is counted, and the columns that hold it on the way.
COUNTS = (
    "n_words word_chars n_symbols n_capitals n_seen_words n_lines n_dup_lines n_repeat_words "
    "_words _lines _windows _ordered"
).split()


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without the text, with its counts: words, symbols, repeats and the like.

    Columns of `docs` that are named like one of these counts give way.
    """
    docs = without_names(docs, *COUNTS)
    carried = [c for c in docs.columns if c != text]
    given = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(
        *carried,
        F.array_remove(F.split(given, _BLANK), "").alias("_words"),
        F.filter(F.split(given, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))).alias("_lines"),
        F.length(F.regexp_replace(given, _BLANK, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(given, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(given, r"\P{Lu}+", "")).cast("long").alias("n_capitals"),
    )
    words = F.col("_words")
    counted = read.select(
        *carried,
        "word_chars",
        "n_symbols",
        "n_capitals",
        F.size(words).cast("long").alias("n_words"),
        (F.size(words) - F.size(F.array_distinct(words))).cast("long").alias("n_seen_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(words) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - WINDOW),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_windows"),
    )
    windows = F.col("_windows")
    ordered = counted.withColumn(
        "_ordered",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.array_sort(
                F.transform(windows, lambda w, i: F.struct(w.alias("window"), i.alias("start")))
            ),
        ),
    ).drop("_windows")
    ordered_windows = F.col("_ordered")

    def repeated(x: Column, i: Column) -> Column:
        before, after = F.get(ordered_windows, i - 1), F.get(ordered_windows, i + 1)
        return F.coalesce(x["window"] == before["window"], F.lit(False)) | F.coalesce(
            x["window"] == after["window"], F.lit(False)
        )

    starts = ordered.withColumn(
        "_starts",
        F.array_sort(
            F.transform(F.filter(ordered_windows, repeated), lambda x: x["start"])
        ),
    ).drop("_ordered")
    covered = F.transform(
        F.col("_starts"),
        lambda start, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), i + 1) - start, F.lit(WINDOW))
        ),
    )
    return starts.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long"),
    ).drop("_starts")


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < 10) | (100 * F.col(n_repeat_words) > 20 * F.col(n_words))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.floor(1000 * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0))


def signals() -> dict[str, Column]:
    """The signals of measured rows, in thousandths."""
    return {
        "symbols": _share("n_symbols", "word_chars"),
        "duplicate_lines": _share("n_dup_lines", "n_lines"),
        "repeated_windows": _share("n_repeat_words", "n_words"),
        "repeated_words": _share("n_seen_words", "n_words"),
        "capitals": _share("n_capitals", "word_chars"),
    }


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of X ~ Bin(n, p), summed exactly term by term in logarithms."""
    first = n * F.log1p(F.lit(-p))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        return F.struct(term.alias("term"), (state["total"] + F.exp(term)).alias("total"))

    start = F.struct(first.alias("term"), F.exp(first).alias("total"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.aggregate(steps, start, add, lambda state: state["total"])


def certified_cutoffs(
    labelled: DataFrame, stratum: str, good: str, risk: float = RISK,
    confidence: float = CONFIDENCE, price: float = PRICE,
) -> DataFrame:
    """stratum, cutoffs (signal to cutoff) learned from measured rows with a label.

    `good` is 1 for documents to be kept.  Strata without a certified cutoff are missing.
    """
    each = labelled.select(
        F.col(stratum).alias("stratum"),
        F.col(good).alias("good"),
        F.explode(
            F.create_map(*[x for name, c in signals().items() for x in (F.lit(name), c)])
        ).alias("signal", "share"),
    )
    lists = F.create_map(
        *[x for name, cuts in CUTOFFS.items() for x in (F.lit(name), F.array(*map(F.lit, cuts)))]
    )
    # The loosest cutoff that rejects a row stands for all stricter ones.
    placed = each.withColumn("step", F.size(F.filter(lists[F.col("signal")], lambda c: c > F.col("share"))))
    counts = placed.groupBy("stratum", "signal", "step").agg(
        F.sum(F.when(F.col("good") == 1, 1).otherwise(0)).alias("lost"),
        F.sum(F.when(F.col("good") == 1, 0).otherwise(1)).alias("caught"),
    )
    strata = labelled.groupBy(F.col(stratum).alias("stratum")).agg(
        F.sum(F.when(F.col(good) == 1, 1).otherwise(0)).alias("n")
    )
    n_strata = F.col("n_strata")
    listed = (
        # One row per stratum meets here.
        strata.withColumn("n_strata", F.count("*").over(Window.partitionBy(F.lit(1))))
        .select("*", F.explode(lists).alias("signal", "cuts"))
        .select("stratum", "n", "n_strata", "signal", F.posexplode("cuts").alias("step", "cutoff"))
        .join(counts, ["stratum", "signal", "step"], "left")
    )
    order = Window.partitionBy("stratum", "signal").orderBy("step")
    running = listed.select(
        "stratum", "signal", "step", "cutoff", "n", "n_strata",
        F.coalesce(F.sum("lost").over(order), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("caught").over(order), F.lit(0)).alias("caught"),
    )
    part = risk / len(CUTOFFS)
    level = (1 - confidence) / (len(CUTOFFS) * n_strata)
    # Beyond the expected number the test cannot refute, and nothing needs to be summed.
    passes = F.when(
        F.col("lost") <= part * F.col("n"),
        binomial_tail(F.col("lost"), F.col("n"), part) <= level,
    ).otherwise(False)
    tested = running.withColumn("certified", F.min(passes).over(order))
    gain = F.col("caught") - price * F.col("lost")
    chosen = (
        tested.filter("certified")
        .groupBy("stratum", "signal")
        .agg(F.max_by("cutoff", F.struct(gain, -F.col("step"))).alias("cutoff"))
    )
    return chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", "cutoff"))).alias("cutoffs")
    )


def judge(rows: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Measured rows with base_failed, rejected_by (signals beyond their cutoff) and kept."""
    joined = rows.join(cutoffs.withColumnRenamed("stratum", stratum), stratum, "left")
    beyond = F.array_compact(
        F.array(
            *[
                F.when(share >= F.col("cutoffs")[name], F.lit(name))
                for name, share in signals().items()
            ]
        )
    )
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("rejected_by", beyond)
        .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
        .drop("cutoffs")
    )
