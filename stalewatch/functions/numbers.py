"""Number parsing and rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(c: Column, nan_policy: str = "null", strip: bool = True) -> Column:
    """Double from text with a decimal comma; unparsable text gives null.

    ``nan_policy="null"`` reads the text 'nan' as missing, ``"keep"`` as NaN.
    """
    if nan_policy not in ("null", "keep"):
        raise ValueError(f"unknown nan_policy: {nan_policy}")
    text = c.cast("string")
    number = F.replace(F.trim(text) if strip else text, F.lit(","), F.lit(".")).try_cast("double")
    return number if nan_policy == "keep" else F.when(~F.isnan(number), number)


def round_half_up(c: Column, digits: int = 2) -> Column:
    """HALF_UP rounding, once, of the shortest decimal text of the number; see :func:`exact_mean` for ties."""
    return F.round(c, digits)


#: Scales of the exact sums: short decimals, and decimals with digits far behind the point.
_SHORT, _FINE = "decimal(38,12)", "decimal(38,25)"
_FINE_LIMIT = 1e6


def _divided(total: Column, count: Column) -> Column:
    """Quotient of an exact sum as a double, rounded once: the fewer digits the sum has, the more follow the point."""
    n = count.cast("decimal(20,0)")
    quotients = [(total.try_cast(f"decimal({digits},12)") / n).cast("double") for digits in (20, 28, 38)]
    return F.coalesce(*quotients)


def _by_digits(c: Column) -> tuple[Column, Column, Column, Column, Column]:
    """The number as a double, as a short and as a fine decimal, and which of the two holds it."""
    x = c.cast("double")
    short, fine = x.try_cast(_SHORT), x.try_cast(_FINE)
    is_short = F.coalesce(short.cast("double") == x, F.lit(False))
    is_fine = ~is_short & (F.abs(x) < _FINE_LIMIT) & F.coalesce(fine.cast("double") == x, F.lit(False))
    return x, short, fine, is_short, is_fine


def decimal_mean(c: Column) -> Column:
    """Average as a decimal of 20 places, for sums of averages that must keep their ties.

    Null where :func:`exact_mean` has more to add than decimals of up to twelve places. Every sum is one of that mean's, so
    that an aggregation with both computes it once.
    """
    x, short, _, is_short, is_fine = _by_digits(c)
    count = F.nullif(F.count(x), F.lit(0))
    mean = F.try_sum(F.when(is_short, short)).try_cast("decimal(30,12)") / count.try_cast("decimal(12,0)")
    others = F.coalesce(F.sum(F.when(is_fine, x)), F.sum(F.when(~is_short & ~is_fine, x)))
    return F.when(others.isNull(), mean)


def exact_mean(c: Column) -> Column:
    """Average without summation noise, whatever the order in which partial sums meet on a cluster.

    Numbers of at most twelve decimals and 26 digits before the point add up as decimals, and their quotient is a
    decimal too, so an exact tie stays one. Numbers with digits further behind the point have a decimal sum of their
    own; what no decimal holds (very large or very small numbers, NaN, infinities), and sums that outgrow their
    decimal, are added as doubles. Every number counts; nulls do not, and a group without numbers gives null.
    """
    x, short, fine, is_short, is_fine = _by_digits(c)
    count = F.nullif(F.count(x), F.lit(0))

    def part(condition: Column, exact: Column, divide) -> Column:
        """Mean of the numbers that meet the condition, over all numbers; null if there are none."""
        return F.coalesce(divide(F.try_sum(F.when(condition, exact))), F.sum(F.when(condition, x)) / count)

    means = [
        part(is_short, short, lambda total: _divided(total, count)),
        part(is_fine, fine, lambda total: (total / count.cast("decimal(13,0)")).cast("double")),
        F.sum(F.when(~is_short & ~is_fine, x)) / count,
    ]
    some = F.coalesce(*means)
    return F.when(some.isNotNull(), sum((F.coalesce(m, F.lit(0.0)) for m in means), F.lit(0.0)))
