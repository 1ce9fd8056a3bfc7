"""Left outer joins that stay balanced when a key is hot."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OTHER = "__other_"


def _all_equal(keys: Sequence[str], null_safe: bool) -> Column:
    tests = [
        F.col(k).eqNullSafe(F.col(_OTHER + k)) if null_safe else F.col(k) == F.col(_OTHER + k) for k in keys
    ]
    return reduce(lambda a, b: a & b, tests)


def left_lookup(left: DataFrame, lookup: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join to a lookup with at most one row per key; the other column names must differ.

    All volume is on the left, the side of a left outer join Spark can split when a key is hot.
    """
    other = lookup.withColumnsRenamed({k: _OTHER + k for k in keys})
    joined = left.join(other, _all_equal(keys, null_safe), "left")
    return joined.select(*left.columns, *[c for c in lookup.columns if c not in keys])


def join_many(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Inner join, of which Spark can split either side when a key is hot; the other column names must differ."""
    other = right.withColumnsRenamed({k: _OTHER + k for k in keys})
    joined = left.join(other, _all_equal(keys, null_safe))
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def left_join_many(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Left join to a side that may hold many rows per key; the other column names must differ.

    Spark never splits the right side of a left outer join, so a hot key there would end in one task. The
    join is written as the inner join, of which Spark can split either side, and the left rows without a
    partner, for which the right side is reduced to its distinct keys. The left side is read twice.
    """
    condition = _all_equal(keys, null_safe)
    other = right.withColumnsRenamed({k: _OTHER + k for k in keys})
    added = [c for c in right.columns if c not in keys]
    matched = join_many(left, right, keys, null_safe)
    alone = left.join(other.select(*[_OTHER + k for k in keys]).distinct(), condition, "left_anti")
    kinds = {f.name: f.dataType for f in right.schema.fields}
    return matched.unionByName(alone.withColumns({c: F.lit(None).cast(kinds[c]) for c in added}) if added else alone)
