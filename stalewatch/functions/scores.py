"""Weighted scores, threshold classes and traffic lights."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stalewatch import rules


def sigla_score(high, critical, index, production, weights=rules.SiglaWeights(), null_as_zero=False) -> Column:
    """Risk score of a sigla; null as soon as one input is null unless ``null_as_zero``."""
    terms = [
        (high, weights.high),
        (critical, weights.critical),
        (index, weights.index),
        (production, weights.production),
    ]
    return _weighted(terms, null_as_zero)


def server_score(index, criticality, high, critical, weights=rules.ServerWeights()) -> Column:
    """Risk score of a server; missing inputs count as zero."""
    terms = [
        (index, weights.index),
        (criticality, weights.criticality),
        (high, weights.high),
        (critical, weights.critical),
    ]
    return _weighted(terms, True)


#: Decimals that are weighted and added without loss; what does not fit is null.
_TERM = "decimal(28,18)"


def weight_decimal(weight: float) -> Decimal:
    """The number a weight is written as."""
    return Decimal(format(Decimal(repr(float(weight))), "f"))


def remediation_score(
    servers, high, critical, index, criticality, weights=rules.RemediationWeights(), exact=False
) -> Column:
    """Priority of a software version; missing averages count as zero.

    ``exact`` adds decimals, of which a tie stays one, and gives null for a number that is too large for them.
    """
    terms = [
        (servers, weights.servers),
        (high, weights.high),
        (critical, weights.critical),
        (index, weights.index),
        (criticality, weights.criticality),
    ]
    if exact:
        return _decimal_sum([(F.coalesce(v, F.lit(0)).try_cast(_TERM), w) for v, w in terms])
    return _weighted(terms, True)


def _decimal_sum(terms) -> Column:
    return sum((value * F.lit(weight_decimal(weight)) for value, weight in terms), F.lit(Decimal(0)))


def _as_written(value: Column) -> Column:
    """The number as a decimal; null if it has more digits than the decimals hold."""
    decimal = value.try_cast(_TERM)
    return F.when(decimal.cast("double") == value.cast("double"), decimal)


def _weighted(terms, null_as_zero: bool) -> Column:
    """Weighted sum, rounded once to a double; added in doubles only where decimals do not hold the numbers."""
    terms = [(F.coalesce(v, F.lit(0)) if null_as_zero else v, w) for v, w in terms]
    total = F.lit(0.0)
    for value, weight in terms:
        total = total + value * F.lit(float(weight))
    return F.coalesce(_decimal_sum([(_as_written(v), w) for v, w in terms]).cast("double"), total)


def risk_class(score: Column, limits: rules.ClassLimits) -> Column:
    """Alto / Médio / Baixo by inclusive lower limits; a null score is Baixo."""
    return (
        F.when(score >= limits.high, rules.CLASS_HIGH)
        .when(score >= limits.medium, rules.CLASS_MEDIUM)
        .otherwise(rules.CLASS_LOW)
    )


def light_by_percent(percent: Column, limits=rules.LightLimits()) -> Column:
    """Three-class light over a percentage; a null percentage is red."""
    return (
        F.when(percent <= limits.green, rules.GREEN)
        .when(percent < limits.yellow, rules.YELLOW)
        .otherwise(rules.RED)
    )


def light_by_flag(flag: Column) -> Column:
    """Two-class light over a 0/1 flag."""
    return F.when(flag == 0, rules.GREEN).otherwise(rules.RED)


def light_position(light: Column) -> Column:
    """Sort position of a light, green first."""
    return F.array_position(F.array(*[F.lit(x) for x in rules.LIGHT_ORDER]), light)
