"""Exact quantiles without gathering a group in one task."""

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stalewatch.staging import stage as staged

DEFAULT_ACCURACY = 100_000
#: Distinct values of a bracket that one task may rank, and parts a larger bracket is cut into by each round.
FEW_VALUES = 50_000
PARTS = 256

Stage = Callable[[DataFrame], DataFrame]


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    groups: Sequence[str] = (),
    accuracy: int = DEFAULT_ACCURACY,
    stage: Stage = staged,
) -> DataFrame:
    """Linearly interpolated quantiles by group: ``groups``, ``probabilidade``, ``quantil``.

    A mergeable sketch brackets every quantile between two values. Of the values inside a bracket only the distinct ones are
    kept, with their counts; all below it meet as one partial count per task. A bracket that misses its
    quantile, as a sketch may, is opened on that side and counted again. While a bracket holds many distinct values, rounds of
    partial counts over its parts narrow it; the few that are left are ranked. Nulls and NaN are left out.

    Runs jobs when called: ``stage`` keeps the counted values between the rounds. Only the state of the worst bracket comes
    to the driver.
    """
    groups = list(groups)
    number = F.col(value).cast("double")
    rows = df.select(*groups, number.alias("__v"), F.lit(1).cast("long").alias("__c"))
    rows = rows.filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    brackets = stage(_sketched(rows, groups, [float(p) for p in probabilities], accuracy))
    marks = stage(_marks(rows, brackets, groups))
    targets = brackets.count()
    while (state := _state(marks, groups))["missed"] or state["targets"] < targets:
        brackets = stage(_opened(marks, brackets, groups))
        marks = stage(_marks(rows, brackets, groups))
    while state["values"] > FEW_VALUES:
        marks = stage(_marked_again(marks, stage(_narrowed(marks, groups)), groups))
        state = _state(marks, groups)
    return _picked(marks, groups)


_TARGET = ("p", "k", "f", "n")


def _sketched(rows: DataFrame, groups: list[str], probabilities: list[float], accuracy: int) -> DataFrame:
    """One row per group and probability: rank ``k`` from 0, fraction ``f``, rows ``n``, and a bracket ``lo`` to ``hi``."""
    margin = 4.0 / accuracy
    bounds = [max(p - margin, 0.0) for p in probabilities] + [min(p + margin, 1.0) for p in probabilities]
    sketch = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("__v", bounds, accuracy).alias("b"))

    def target(i: int, p: float) -> Column:
        position = F.lit(p) * (F.col("n") - 1)
        rank = F.floor(position)
        ends = (F.col("b")[i].alias("lo"), F.col("b")[i + len(probabilities)].alias("hi"))
        return F.struct(F.lit(p).alias("p"), rank.alias("k"), (position - rank).alias("f"), F.col("n").alias("n"), *ends)

    targets = F.array(*[target(i, p) for i, p in enumerate(probabilities)])
    return sketch.filter("n > 0").select(*groups, F.inline(targets))


def _by_group(left: DataFrame, right: DataFrame, keys: Sequence[str], add: Sequence[str]) -> DataFrame:
    """``left`` with columns of a small right side, joined null-safe; equal to a left join as every key has a partner."""
    other = right.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], *add)
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    return left.join(other, reduce(lambda a, b: a & b, same)).select(*left.columns, *add)


def _inside(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Counts of the values in the bracket of their row; null stands for all values below it."""
    mark = F.when(F.col("__v") >= F.col("lo"), F.col("__v"))
    kept = rows.filter(F.col("__v").isNull() | (F.col("__v") <= F.col("hi")))
    return kept.groupBy(*groups, *_TARGET, mark.alias("__v")).agg(F.sum("__c").alias("__c"))


def _marks(rows: DataFrame, brackets: DataFrame, groups: list[str]) -> DataFrame:
    targets = F.collect_list(F.struct(*_TARGET, "lo", "hi")).alias("__targets")
    packed = brackets.groupBy(*groups).agg(targets)  # a few per group
    if groups:
        joined = _by_group(rows, packed, groups, ["__targets"])
    else:
        joined = rows.withColumn("__targets", packed.scalar())
    return _inside(joined.select(*groups, "__v", "__c", F.inline("__targets")), groups)


def _state(marks: DataFrame, groups: list[str]) -> dict[str, object]:
    """Whether a bracket misses its quantile, the targets that have marks, and the most distinct values in a bracket."""
    missed = F.coalesce(F.bool_or(F.col("low") | F.col("high")), F.lit(False))
    most = F.coalesce(F.max("values"), F.lit(0))
    measured = _measured(marks, groups)
    return measured.agg(missed.alias("missed"), F.count(F.lit(1)).alias("targets"), most.alias("values")).first().asDict()


def _measured(marks: DataFrame, groups: list[str]) -> DataFrame:
    """By target: whether the quantile lies below the bracket (``low``) or above it (``high``), and its distinct values."""
    below = F.coalesce(F.sum(F.when(F.col("__v").isNull(), F.col("__c"))), F.lit(0))
    upto, last = F.sum("__c"), F.least(F.col("k") + 1, F.col("n") - 1)
    return marks.groupBy(*groups, *_TARGET).agg(
        (below > F.col("k")).alias("low"), (upto <= last).alias("high"), F.count("__v").alias("values")
    )


def _opened(marks: DataFrame, brackets: DataFrame, groups: list[str]) -> DataFrame:
    """The brackets, those that miss their quantile without an end on that side."""
    keys = [*groups, "p"]
    # A bracket below all values has no marks.
    measured = _measured(marks, groups).select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)], "low", "high")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    ends = {
        "lo": F.when(F.col("low"), F.lit(float("-inf"))).otherwise(F.col("lo")),
        "hi": F.when(F.coalesce("high", F.lit(True)), F.lit(float("inf"))).otherwise(F.col("hi")),
    }
    return brackets.join(measured, same, "left").withColumns(ends).select(*brackets.columns)


def _narrowed(marks: DataFrame, groups: list[str]) -> DataFrame:
    """Smaller brackets: each is cut into parts of about equally many distinct values, and counts tell which part is wanted."""
    keys = [*groups, *_TARGET]
    inside = marks.filter(F.col("__v").isNotNull())
    cuts = inside.groupBy(*keys).agg(F.percentile_approx("__v", [i / PARTS for i in range(1, PARTS)]).alias("__cuts"))
    parted = _by_group(inside, cuts, [*groups, "p"], ["__cuts"])
    part = F.size(F.filter("__cuts", lambda c: c < F.col("__v")))
    counted = parted.groupBy(*keys, part.alias("__part")).agg(
        F.sum("__c").alias("__c"), F.min("__v").alias("__min"), F.max("__v").alias("__max")
    )
    below = marks.filter(F.col("__v").isNull()).select(*keys, F.lit(-1).alias("__part"), "__c", F.col("__v").alias("__min"), F.col("__v").alias("__max"))
    running = Window.partitionBy(*groups, "p").orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)  # PARTS rows
    summed = counted.unionByName(below).withColumn("__upto", F.sum("__c").over(running)).filter("__part >= 0")
    last = F.least(F.col("k") + 1, F.col("n") - 1)
    return summed.groupBy(*keys).agg(
        F.min(F.when(F.col("__upto") > F.col("k"), F.col("__min"))).alias("lo"),
        F.min(F.when(F.col("__upto") > last, F.col("__max"))).alias("hi"),
    )


def _marked_again(marks: DataFrame, brackets: DataFrame, groups: list[str]) -> DataFrame:
    return _inside(_by_group(marks, brackets, [*groups, "p"], ["lo", "hi"]), groups)


def _picked(marks: DataFrame, groups: list[str]) -> DataFrame:
    running = Window.partitionBy(*groups, "p").orderBy(F.col("__v").asc_nulls_first())  # FEW_VALUES rows
    ranked = marks.withColumn("__upto", F.sum("__c").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.least(F.col("k") + 1, F.col("n") - 1)
    ends = ranked.filter(F.col("__v").isNotNull()).groupBy(*groups, *_TARGET).agg(
        F.min(F.when(F.col("__upto") > F.col("k"), F.col("__v"))).alias("__low"),
        F.min(F.when(F.col("__upto") > last, F.col("__v"))).alias("__high"),
    )
    between = F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("f")
    # An infinity less itself, or times zero, is no number.
    exact = (F.col("f") == 0) | (F.col("__low") == F.col("__high"))
    quantile = F.when(exact, F.col("__low")).otherwise(between)
    return ends.select(*groups, F.col("p").alias("probabilidade"), quantile.alias("quantil"))
