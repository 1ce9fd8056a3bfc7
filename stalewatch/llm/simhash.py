"""SimHash fingerprints of word shingles, and near-duplicate groups by deletion-variant signatures.

Two fingerprints are linked when at most four bits differ. A fingerprint is cut into three segments: four
differing bits cannot put two into each of three segments, so one segment differs by one bit at most. Every
segment is indexed once for each of its bits with that bit struck out; two segments that differ by at most
one bit share such a variant. Equal variants are joined and the pair is verified on all 64 bits inside the
join. The test also lets a pair pass only at its first shared variant, so it comes out once.

Equal fingerprints are reduced to one before. Dense groups of fingerprints that are all near each
other would give all pairs, so fingerprints that agree outside one block of four bits (linked whatever the
block holds, and sixteen at most) are first chained to the least of them; after that, only pairs that are
not yet in one component leave the join.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.llm.components import components
from stalewatch.llm.tables import pieces, with_columns
from stalewatch.staging import stage

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: First bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MASK = (1 << 64) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; 0 for a text without words."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "simhash", shingle: int = SHINGLE) -> DataFrame:
    """Adds the fingerprint of every whole text as a long; null, empty and blank texts get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())
            yield with_columns(batch, drop=(out,), **{out: found})

    kept = [f for f in docs.schema.fields if f.name != out]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.LongType())]))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _variants(simhash: Column) -> Column:
    """One key for each bit: the segment of the bit without it, and the number of the bit."""
    keys = []
    for first, width in SEGMENTS:
        part = F.shiftrightunsigned(simhash, first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            struck = part.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            keys.append(struck.bitwiseOR(F.lit((first + bit) << 32)))
    return F.array(*keys)


def _first_shared(differing: Column) -> Column:
    """The bit at whose variant a linked pair is let through."""
    choice = F.lit(None).cast("int")
    for first, width in reversed(SEGMENTS):
        part = F.shiftrightunsigned(differing, first).bitwiseAND(F.lit((1 << width) - 1))
        # A single set bit: its position is the number of bits below it.
        position = F.when(part == 0, F.lit(first)).otherwise(F.bit_count(part - 1) + first)
        choice = F.when(F.bit_count(part) <= 1, position).otherwise(choice)
    return choice


def chains(prints: DataFrame) -> DataFrame:
    """Edges (a, b) from each fingerprint to the least of those that differ from it in one block of four bits only."""
    blocks = [F.col("simhash").bitwiseAND(F.lit(_signed(_MASK & ~(15 << (4 * i))))) for i in range(16)]
    keyed = prints.select("simhash", F.posexplode(F.array(*blocks)).alias("block", "rest"))
    least = F.min("simhash").over(Window.partitionBy("block", "rest"))
    return keyed.select(F.col("simhash").alias("a"), least.alias("b")).filter("a <> b").distinct()


def near_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of components that hold linked fingerprints; ``prints`` has ``node`` and ``component``.

    Spark takes the 64 variants of a fingerprint for one row and would broadcast millions of them as a small
    table; the hint has both sides shuffled whatever their estimate, and a hot key can still be split.
    """
    keyed = prints.select("node", "component", F.explode(_variants(F.col("node"))).alias("key"))
    other = keyed.select(F.col("node").alias("b"), F.col("component").alias("other"), F.col("key").alias("b_key"))
    differing = F.col("node").bitwiseXOR(F.col("b"))
    near = (
        (F.col("key") == F.col("b_key"))
        & (F.col("node") < F.col("b"))
        & (F.col("component") != F.col("other"))
        & (F.bit_count(differing) <= MAX_BITS)
        & (F.shiftright("key", 32) == _first_shared(differing))
    )
    return keyed.join(other.hint("merge"), near).select(F.col("component").alias("a"), F.col("other").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``simhash`` and ``component_id``, the smallest doc_id reachable over links.

    One row for each input row. Rows with a null doc_id keep their fingerprint, take part in linking and
    get the component of what they link to (null if that has no doc_id). Texts without words all have
    fingerprint 0. The working tables hold one row per distinct fingerprint and are written to the shared folder.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stage(fingerprints(narrow).drop("text"), "simhash")
    prints = stage(marked.groupBy("simhash").agg(F.min("doc_id").alias("first")), "prints")
    chained = components(prints.select(F.col("simhash").alias("node")), chains(prints))
    contracted = stage(near_pairs(chained), "pairs")
    roots = chained.select(F.col("component").alias("node")).distinct()
    merged = components(roots, contracted)
    whole = chained.join(merged.select(F.col("node").alias("component"), F.col("component").alias("root")), "component")
    whole = whole.join(prints.select(F.col("simhash").alias("node"), "first"), "node")
    least = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = whole.join(least, "root").select(F.col("node").alias("simhash"), "component_id")
    return marked.join(labelled, "simhash").select("doc_id", "simhash", "component_id")
