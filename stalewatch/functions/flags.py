"""Predicates and 0/1 flags on ratings, impacts and indexes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stalewatch.rules import NONCONFORM_RATINGS, UP_TO_DATE


def as_flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def in_words(c: Column, words, fold: str | None = "lower") -> Column:
    """Membership test; ``fold`` is 'lower', 'upper' or None for a case-sensitive test."""
    folded = {"lower": F.lower, "upper": F.upper, None: lambda x: x}[fold](c)
    return folded.isin(*words)


def has_fragment(c: Column, fragment: str) -> Column:
    """Case-insensitive test for a literal fragment anywhere in the text."""
    return F.lower(c).contains(fragment)


def is_nonconform(index: Column, rating: Column, ratings=NONCONFORM_RATINGS) -> Column:
    """True for a positive obsolescence index or a rating that names a risk (null when unknown)."""
    return (index > 0) | in_words(rating, ratings)


def needs_remediation(index: Column, rating: Column) -> Column:
    """Positive index, or any rating other than up to date; a missing rating counts as other."""
    return (index > 0) | (F.lower(F.coalesce(rating, F.lit(""))) != UP_TO_DATE)


def count_true(condition: Column) -> Column:
    """Number of rows for which the condition holds, 0 for none."""
    return F.count(F.when(condition, 1))
