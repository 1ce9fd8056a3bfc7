"""Rendezvous hashing of record keys over weighted shards, with gapless places inside each shard."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The leading hexadecimal digits of a digest that a double holds exactly.
DIGITS = 13
#: Hexadecimal digits of the digest that deals the rows of a shard to 16 ** 2 parts.
BUCKET_DIGITS = 2
#: Places given out by one row of the last step; more equal rows are several such rows.
BLOCK = 1 << 16


def _cost(key: Column, shard: int, weight: float) -> Column:
    """``-ln(u) / weight`` and the shard, ``u`` being a digest of key and shard in (0, 1)."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}")))
    u = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)
    return F.struct((-F.log(u) / float(weight)).alias("cost"), F.lit(shard).alias("shard"))


def cheapest(key: Column, weights: Sequence[float]) -> Column:
    """Struct of cost and shard: the shard with the least ``-ln(u) / weight``.

    A shard of double weight gets double the keys. Another shard or a larger weight takes keys only into
    that shard; a removed or lighter one gives up only its own. A null key counts as an empty text; equal
    costs go to the smaller shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("shards need positive weights")
    return F.array_min(F.array(*[_cost(key, s, w) for s, w in enumerate(weights)]))


def with_slots(rows: DataFrame, shard: str, slot: str = "slot", block: int = BLOCK) -> DataFrame:
    """Numbers the rows of every shard from 0 without a gap.

    The order is bucket, then columns, nulls first; a bucket is a part of a shard by the digest of the whole
    row, so no task holds a whole shard. Equal rows are counted before the shuffle and spread out again at
    the end, in blocks dealt to all tasks, so a third of all rows may be equal or share a key. All columns
    must be orderable and have a text form; keep them narrow.
    """
    columns = rows.columns
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    bucket = F.substring(F.md5(F.concat_ws(":", *texts)), 1, BUCKET_DIGITS)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__bucket", bucket)
    inside = Window.partitionBy(shard, "__bucket").orderBy(*columns)
    before = F.sum("__rows").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__rows")
    placed = counted.withColumn("__before", before)
    # One row per shard and bucket, whatever the input.
    sizes = counted.groupBy(shard, "__bucket").agg(F.sum("__rows").alias("__size"))
    earlier = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select(
        F.col(shard).alias("__shard"),
        F.col("__bucket").alias("__in"),
        (F.sum("__size").over(earlier) - F.col("__size")).alias("__start"),
    )
    # Null-safe, as a test for nulls in one branch would compute the shards twice and keep the branches from sharing the counted rows.
    same = F.col(shard).eqNullSafe(F.col("__shard")) & F.col("__bucket").eqNullSafe(F.col("__in"))
    found = placed.join(starts, same)
    first = F.col("__start") + F.col("__before")
    blocks = found.select(
        *columns,
        (first + F.col("__rows")).alias("__end"),
        F.explode(F.sequence(first, first + F.col("__rows") - 1, F.lit(block).cast("long"))).alias("__from"),
    ).repartition(shard, "__from")
    last = F.least(F.col("__from") + block, F.col("__end")) - 1
    return blocks.select(*columns, F.explode(F.sequence(F.col("__from"), last)).alias(slot))


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard_rows(rows: DataFrame, key: str, weights: Sequence[float], extra_weight: float | None = None) -> DataFrame:
    """Adds ``shard``, ``grown_shard`` (with one more shard of ``extra_weight``, else null) and ``slot``.

    The key alone decides, so rows of one key share a shard; a null key is a key of its own. An empty table
    gives no rows; columns with the new names are replaced. ``rows`` should hold the key and narrow columns.
    """
    clean = rows.drop("shard", "grown_shard", "slot").withColumn("__best", cheapest(F.col(key), weights))
    grown = F.lit(None).cast("int")
    if extra_weight is not None:
        if extra_weight <= 0:
            raise ValueError("shards need positive weights")
        grown = F.least(F.col("__best"), _cost(F.col(key), len(weights), extra_weight))["shard"]
    placed = clean.withColumns({"shard": F.col("__best")["shard"], "grown_shard": grown}).drop("__best")
    return with_slots(placed, "shard")
