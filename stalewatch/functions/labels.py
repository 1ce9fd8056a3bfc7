"""Header texts, fallback chains and audit columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = " | "


def labelled_header(parts: dict[str, Column]) -> Column:
    """``name=value`` parts joined by the separator; parts with a null value are left out."""
    return F.concat_ws(SEPARATOR, *[F.concat(F.lit(f"{name}="), value) for name, value in parts.items()])


def positional_header(*parts: Column) -> Column:
    """Values joined by the separator; a null value leaves its place empty."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def tier_label(tier: Column, labels: dict[int, str]) -> Column:
    """Label of a match tier."""
    chain = F
    for number, label in labels.items():
        chain = chain.when(tier == number, F.lit(label))
    return chain
