"""Grouped quantiles: mergeable sketches by default, exact order statistics on request."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions import ordered_bits

from .small import holding, local_frame, settled

DEFAULT_ACCURACY = 10_000
#: Bits of a double that one round of a selection settles, so 4096 buckets at most.
RADIX_BITS = 12


def quantiles(
    frame: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """One row per group, one column per named probability.

    Both forms return observed values (no interpolation): the smallest value whose
    cumulative share reaches the probability.  Nulls and NaN are ignored, and a group
    with no other values has no row.
    """
    if exact:
        return exact_quantiles(frame, value, probs, by, accuracy)
    return approx_quantiles(frame, value, probs, by, accuracy)


def approx_quantiles(
    frame: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Rank error at most ``1 / accuracy`` of the group, in one pass.

    Sketches are merged map-side, so the cost of a group does not depend on its size.
    """
    sketch = _values(frame, value, by).groupBy(*by).agg(
        _sketch(list(probs.values()), accuracy).alias("__q")
    )
    return sketch.select(
        *by, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)]
    )


def exact_quantiles(
    frame: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Exact order statistics without gathering a group in one place.

    1. a sketch proposes a few cut points around each wanted rank;
    2. counting the rows below and up to each cut tells exactly where the rank lies,
       whether or not the sketch was accurate; a rank among the ties of a cut is
       answered by it;
    3. for the other ranks, only the rows strictly between two cuts (about
       ``2 / accuracy`` of a group) are looked at, by :func:`_selected`.

    All passes keep counts of fixed number per group and combine map-side; no rows are
    ordered.  The input is scanned up to three times: hand in a narrow or stored frame when
    it is costly.  Cuts of groups are kept and joined as their measured size suggests.
    """
    if not by:
        row = exact_column_quantiles(frame, [value], probs, accuracy)
        return row.select(*probs).filter(F.col(next(iter(probs))).isNotNull())
    values = _values(frame, value, by)
    grid = _grid(probs, accuracy)
    names = [f"__cut_{i}" for i in range(len(grid))]
    sketch = values.groupBy(*by).agg(_sketch(grid, accuracy).alias("__q"))
    cuts = settled(
        sketch.select(*by, *[F.col("__q")[i].alias(c) for i, c in enumerate(names)])
    )

    counted = (
        _beside(values, cuts, by)
        .groupBy(*by)
        .agg(
            F.count("*").alias("__n"),
            *[F.max(c).alias(c) for c in names],
            *[F.count_if(F.col("__v") < F.col(c)).alias(f"{c}_below") for c in names],
            *[F.count_if(F.col("__v") <= F.col(c)).alias(f"{c}_upto") for c in names],
        )
    )
    located = settled(
        counted.select(
            *by,
            *[_locate(p, names).alias(f"__at_{i}") for i, p in enumerate(probs.values())],
        )
    )
    open_ranks = [F.col(f"__at_{i}.answer").isNull() for i in range(len(probs))]
    unsettled = located.filter(reduce(lambda a, b: a | b, open_ranks))

    tagged = _beside(values, unsettled, by)
    hits = [_hit(F.col("__v"), F.col(f"__at_{i}"), name) for i, name in enumerate(probs)]
    near = tagged.select(*by, F.explode(F.array_compact(F.array(*hits))).alias("h"))
    found = _selected(near, by)
    reached = found.groupBy(*by).agg(
        *[F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in probs]
    )
    return _beside(located, reached, by, how="left").select(
        *by, *[F.coalesce(f"__at_{i}.answer", name).alias(name) for i, name in enumerate(probs)]
    )


def exact_column_quantiles(
    frame: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """``(variable, *probs)``: the same three passes for whole columns side by side.

    Cut points and counts are a few scalars per column on the driver, so they enter the
    next pass as literals: no join, and range filters that reach the scan.  The last
    pass is skipped when ties settle every rank.
    """
    answers = _column_statistics(
        frame, columns, probs, {name: _rank_of(prob) for name, prob in probs.items()}, accuracy
    )
    rows = [(name, *[answers.get((name, p)) for p in probs]) for name in columns]
    schema = "variable string, " + ", ".join(f"`{p}` double" for p in probs)
    return local_frame(frame.sparkSession, rows, schema)


def interpolated_quantile(
    frame: DataFrame, value: str, prob: float, accuracy: int = DEFAULT_ACCURACY
) -> float | None:
    """The quantile between its two neighbouring values, in proportion; None without values.

    Of n values it stands at ``prob * (n - 1)``, counted from 0.  Both neighbours are exact
    order statistics, so no group of values is held anywhere.
    """
    share = Fraction(str(prob))
    ranks = {
        "lower": lambda n: (share * (n - 1)).__floor__() + 1,
        "upper": lambda n: min(n, (share * (n - 1)).__floor__() + 2),
    }
    found = _column_statistics(frame, [value], dict.fromkeys(ranks, prob), ranks, accuracy)
    if not found:
        return None
    place = share * (found[value, ""] - 1)
    weight = float(place - place.__floor__())
    return found[value, "lower"] * (1.0 - weight) + found[value, "upper"] * weight


def _rank_of(prob: float) -> Callable[[int], int]:
    return lambda total: max(1, ceil(Fraction(str(prob)) * total))


def _column_statistics(
    frame: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float],
    ranks: Mapping[str, Callable[[int], int]],
    accuracy: int,
) -> dict[tuple[str, str], float]:
    """The value at each rank of each column by (column, name), and its count by (column, "").

    `probs` says where each rank is expected, `ranks` what it is, given the count.
    """
    numbers = frame.select(*[_number(name).alias(name) for name in columns])
    grid = _grid(probs, accuracy)
    sketches = numbers.agg(*[_sketch(grid, accuracy, name).alias(name) for name in columns])
    cuts = {name: sorted(set(values or ())) for name, values in sketches.first().asDict().items()}

    counts = numbers.agg(
        *[F.count(name).alias(f"{name}__n") for name in columns],
        *[
            F.count_if(test).alias(f"{name}__{i}_{part}")
            for name in columns
            for i, cut in enumerate(cuts[name])
            for part, test in (("below", F.col(name) < cut), ("upto", F.col(name) <= cut))
        ],
    ).first()

    answers: dict[tuple[str, str], float] = {}
    hits, bounds = [], []
    for name in columns:
        total = counts[f"{name}__n"]
        if not total:
            continue
        answers[name, ""] = total
        for prob_name in probs:
            rank = ranks[prob_name](total)
            low, high, skipped = None, None, 0
            for i, cut in enumerate(cuts[name]):
                if counts[f"{name}__{i}_upto"] < rank:
                    low, skipped = cut, counts[f"{name}__{i}_upto"]
                    continue
                if counts[f"{name}__{i}_below"] < rank:
                    answers[name, prob_name] = cut
                else:
                    high = cut
                break
            if (name, prob_name) not in answers:
                at = F.struct(
                    F.lit(low).cast("double").alias("low"),
                    F.lit(high).cast("double").alias("high"),
                    F.lit(rank - skipped).cast("long").alias("rank"),
                    F.lit(None).cast("double").alias("answer"),
                )
                hits.append(_hit(F.col(name), at, f"{name}\t{prob_name}"))
                bounds.append(_between(F.col(name), at))
    if hits:
        near = numbers.filter(reduce(lambda a, b: a | b, bounds))
        with holding():
            found = _selected(near.select(F.explode(F.array_compact(F.array(*hits))).alias("h")), [])
            for row in found.collect():
                answers[tuple(row["__name"].split("\t"))] = row["__v"]
    return answers


def _number(name: str) -> Column:
    """The column as double, NaN turned into null."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _values(frame: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return frame.select(*by, _number(value).alias("__v")).filter(F.col("__v").isNotNull())


def _sketch(probs: Sequence[float], accuracy: int, value: str = "__v") -> Column:
    return F.percentile_approx(value, F.array(*[F.lit(p) for p in probs]), F.lit(accuracy))


def _grid(probs: Mapping[str, float], accuracy: int) -> list[float]:
    """Each probability and a step to either side of it, inside [0, 1]."""
    step = 1.5 / accuracy
    return sorted({min(1.0, max(0.0, p + d)) for p in probs.values() for d in (-step, 0.0, step)})


def _beside(
    left: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Put per-group statistics beside rows of the group; null is a group."""
    renamed = stats.select(
        *[F.col(name).alias(f"__by_{i}") for i, name in enumerate(by)],
        *[name for name in stats.columns if name not in by],
    )
    same_group = [F.col(name).eqNullSafe(F.col(f"__by_{i}")) for i, name in enumerate(by)]
    return left.join(renamed, same_group, how).drop(*[f"__by_{i}" for i in range(len(by))])


def _locate(prob: float, cuts: Sequence[str]) -> Column:
    """Where a rank lies: an answer, or an open interval and the rank inside it.

    The rank is ``ceil(prob * n)`` in integer arithmetic, at least 1.  A null bound is
    open.
    """
    share = Fraction(str(prob))
    rank = F.greatest(
        F.lit(1).cast("long"),
        F.call_function(
            "div",
            # A count times a numerator of many digits is beyond a long.
            F.col("__n").cast("decimal(19,0)") * F.lit(Decimal(share.numerator))
            + F.lit(Decimal(share.denominator - 1)),
            F.lit(Decimal(share.denominator)),
        ),
    )
    nothing, zero = F.lit(None).cast("double"), F.lit(0).cast("long")

    def place(low: Column, high: Column, skipped: Column, answer: Column) -> Column:
        return F.struct(
            low.alias("low"),
            high.alias("high"),
            (rank - skipped).alias("rank"),
            answer.alias("answer"),
        )

    at = place(F.col(cuts[-1]), nothing, F.col(f"{cuts[-1]}_upto"), nothing)
    for i in reversed(range(len(cuts))):
        cut = F.col(cuts[i])
        low = F.col(cuts[i - 1]) if i else nothing
        skipped = F.col(f"{cuts[i - 1]}_upto") if i else zero
        here = F.when(
            F.col(f"{cuts[i]}_below") >= rank, place(low, cut, skipped, nothing)
        ).otherwise(place(cut, cut, skipped, cut))
        at = F.when(F.col(f"{cuts[i]}_upto") >= rank, here).otherwise(at)
    return at


def _between(value: Column, at: Column) -> Column:
    low, high = at["low"], at["high"]
    return (low.isNull() | (value > low)) & (high.isNull() | (value < high))


def _hit(value: Column, at: Column, name: str) -> Column:
    """A row's contribution to one unsettled rank, or null."""
    return F.when(
        at["answer"].isNull() & value.isNotNull() & _between(value, at),
        F.struct(F.lit(name).alias("name"), at["rank"].alias("rank"), value.alias("v")),
    )


def _selected(hits: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, __name, __v)``: the value at each wanted rank, by radix refinement.

    The values that may hold a rank are counted in at most 4096 buckets, by the leading bits
    in which the least and the greatest of them differ.  The bucket that holds the rank is
    all that the next round looks at; six rounds settle every bit, a bucket of one value sooner.
    Rows are only counted; what is put in order are the buckets of a rank.
    """
    names = [*by, "__name"]
    near = settled(
        hits.groupBy(
            *by,
            F.col("h.name").alias("__name"),
            F.col("h.rank").alias("__rank"),
            F.col("h.v").alias("__v"),
        ).agg(F.count("*").alias("__c"))
    )
    within = settled(
        near.groupBy(*names).agg(
            F.max("__rank").alias("__rank"), F.min("__v").alias("__low"), F.max("__v").alias("__high")
        )
    )
    settled_bits = ordered_bits("__low").bitwiseXOR(ordered_bits("__high"))
    shift = F.greatest(F.lit(0), F.length(F.bin(settled_bits)) - RADIX_BITS)
    upto = (
        Window.partitionBy(*names)
        .orderBy("__bucket")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = within.filter("__low = __high").select(*names, F.col("__low").alias("__v"))
    todo = within.filter("__low < __high")
    while not todo.isEmpty():
        inside = _beside(near.drop("__rank"), todo, names).filter(
            (F.col("__v") >= F.col("__low")) & (F.col("__v") <= F.col("__high"))
        )
        buckets = (
            inside.withColumn(
                "__bucket", F.call_function("shiftright", ordered_bits("__v"), shift)
            )
            .groupBy(*names, "__bucket")
            .agg(
                F.sum("__c").alias("__c"),
                F.max("__rank").alias("__rank"),
                F.min("__v").alias("__low"),
                F.max("__v").alias("__high"),
            )
            .withColumn("__upto", F.sum("__c").over(upto))
        )
        before = F.col("__upto") - F.col("__c")
        within = settled(
            buckets.filter((F.col("__upto") >= F.col("__rank")) & (before < F.col("__rank"))).select(
                *names, (F.col("__rank") - before).alias("__rank"), "__low", "__high"
            )
        )
        answers = answers.unionByName(
            within.filter("__low = __high").select(*names, F.col("__low").alias("__v"))
        )
        todo = within.filter("__low < __high")
    return answers
