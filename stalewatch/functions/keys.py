"""Text keys: cleaning, normalisation and containment tests."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stalewatch.rules import BLANK_WORDS, MIN_NEEDLE_CHARS


def basic_key(c: Column) -> Column:
    """Lower-cased text without outer spaces."""
    return F.lower(F.trim(c))


def strong_key(c: Column) -> Column:
    """Like :func:`basic_key`, with every run of ASCII white space squeezed to one space first."""
    return basic_key(F.regexp_replace(c.cast("string"), r"\s+", " "))


def blank_to_null(c: Column, blanks=BLANK_WORDS) -> Column:
    """Trimmed text, or null where it is one of the ``blanks`` (compared lower-cased)."""
    text = F.trim(c.cast("string"))
    return F.when(~F.lower(text).isin(*blanks), text)


def joined_key(*parts: Column) -> Column:
    """Strong key over the non-null parts joined by a space ('' when every part is null)."""
    return strong_key(F.concat_ws(" ", *parts))


def contains_term(text: Column, term: Column, min_chars: int = MIN_NEEDLE_CHARS) -> Column:
    """True where ``term`` has at least ``min_chars`` characters and occurs in ``text``; never null."""
    return F.coalesce((F.char_length(term) >= min_chars) & F.contains(text, term), F.lit(False))
