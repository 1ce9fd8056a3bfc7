"""Which terms occur inside which texts, as equality joins.

``contains(text, term)`` offers no join key, so Spark would compare every text with every term. Here
every term gets a block prefix whose length is the largest power of two that fits in the term. A text
offers a hash of its substrings of those block lengths, as far as some term has such a block; an equality join with
the hashes of the prefixes leaves the few positions where a term can start, and gives the lengths such a term can have. The
substrings of exactly those lengths are then looked up among the terms.

Until then a position is a few numbers and the digest of its text. The texts themselves meet, once each, the
positions that are left, and once more the terms that were found in them. The work follows the result and not the
product of both tables, also when many terms begin alike.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a text whose positions are cut out together; finding a character takes a pass over those before it.
CHUNK = 256


def _power_of_two(exponent: str) -> str:
    return f"cast(pow(2, {exponent}) AS int)"


def _positions(texts: DataFrame, blocks: Column) -> DataFrame:
    """``__id, __size, __block, __at, __hash``: every position of a text, for each block length that fits."""
    sized = texts.select("__id", "__text", F.char_length("__text").alias("__size"))
    blocked = sized.withColumn("__blocks", blocks).selectExpr(
        "*", "explode(filter(__blocks, b -> b <= __size)) AS __block"
    )
    chunks = blocked.selectExpr(
        "__id", "__size", "__block", "__text", f"explode(sequence(0, (__size - __block) div {CHUNK})) AS __chunk"
    ).selectExpr(
        "__id", "__size", "__block", f"cast(__chunk * {CHUNK} AS int) AS __before",
        f"substring(__text, cast(__chunk * {CHUNK} AS int) + 1, {CHUNK} + __block - 1) AS __part",
    )
    return chunks.selectExpr(
        "__id", "__size", "__block", "__before", "__part", "explode(sequence(1, char_length(__part) - __block + 1)) AS __in"
    ).selectExpr(
        "__id", "__size", "__block", "__before + __in AS __at", "xxhash64(substring(__part, __in, __block)) AS __hash"
    )


def contained_terms(texts: DataFrame, terms: DataFrame, text: str, term: str, min_chars: int = 4) -> DataFrame:
    """All pairs of a distinct ``text`` and a ``term`` of at least ``min_chars`` that occurs in it.

    ``texts`` supplies the column ``text``; every row of ``terms`` holds a distinct ``term`` and any
    further columns, which are carried along.
    """
    shortest = max(min_chars, 1)
    usable = terms.filter(F.char_length(term) >= shortest)
    # The place of the highest set bit of a length gives the largest power of two that fits in it.
    sized = usable.selectExpr(f"`{term}` AS __term", f"char_length(`{term}`) AS __length").selectExpr(
        "__term", "__length", f"{_power_of_two('length(bin(__length)) - 1')} AS __block"
    )
    # One row per prefix; a block of b characters belongs to lengths b .. 2b-1, so the list is short.
    hashed = sized.selectExpr("__block", "xxhash64(substring(__term, 1, __block)) AS __hash", "__length")
    prefixes = hashed.groupBy("__block", "__hash").agg(F.collect_set("__length").alias("__lengths"))
    # As many block lengths as a term length has bits.
    blocks = F.coalesce(sized.agg(F.collect_set("__block")).scalar(), F.array().cast("array<int>"))

    own = texts.select(F.col(text).alias("__text")).filter(F.char_length(text) >= shortest).distinct()
    own = own.withColumn("__id", F.unhex(F.md5("__text")))
    starts = (
        _positions(own, blocks)
        .join(prefixes, ["__block", "__hash"])
        .selectExpr("__id", "__size", "__at", "explode(__lengths) AS __length")
        .filter("__at + __length - 1 <= __size")
    )
    packed = starts.groupBy("__id").agg(F.collect_list(F.struct("__at", "__length")).alias("__starts"))
    needles = (
        own.join(packed, "__id")
        .selectExpr("__id", "__text", "explode(__starts) AS __start")
        .selectExpr("__id", f"substring(__text, __start.__at, __start.__length) AS `{term}`")
        .distinct()
    )
    found = needles.join(usable, term).join(own, "__id")
    # Hashes have only narrowed the search; what comes out is compared as text.
    return found.filter(F.contains("__text", F.col(term))).select(F.col("__text").alias(text), *usable.columns)
