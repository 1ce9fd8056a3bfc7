"""Column-name cleaning (driver-side metadata, no data involved)."""

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

UNNAMED = "coluna_sem_nome"


def normalize_name(name: object) -> str:
    """Lower-case name made of word characters and single inner underscores; accents stay."""
    words = [w for w in re.split(r"[\W_]+", str(name).strip().lower()) if w]
    return "_".join(words) or UNNAMED


def unique_names(names: Iterable[str]) -> list[str]:
    """Repeat occurrences get ``_1``, ``_2`` ...; numbers already in use are skipped."""
    names = list(names)
    taken: set[str] = set()
    counters: dict[str, int] = {}
    result = []
    for name in names:
        candidate = name
        while candidate in taken:
            counters[name] = counters.get(name, 0) + 1
            candidate = f"{name}_{counters[name]}"
        taken.add(candidate)
        result.append(candidate)
    return result


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(normalize_name(c) for c in df.columns))
