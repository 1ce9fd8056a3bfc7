"""Removal of lines that repeat an earlier line, exactly or up to one edited character.

Lines are compared lower-cased, with runs of white space as one space. Equal lines are reduced to their
earliest occurrence first. What is left goes through a deletion-neighbourhood join:

* two lines of equal length are one substitution apart if they are equal without the character at one place;
* a line is one insertion away from another if it equals that one without one of its characters.

Every line emits itself and all its variants with one character deleted, as hashed keys; equal keys meet.
Members of one key differ in one character (or one inserted character) only, so a key holds no more lines
than there are characters, times the places for an insertion, however often the lines occur. The earliest
member of a key witnesses the others; every witness is verified by edit distance.

Only lines that can have a neighbour emit variants. Of two lines one edit apart, the part before or the part
after the edit is at least half of the line, so they share a half-length prefix or suffix. Halves are counted
by hash, and lines without a shared half, nearly all, are settled by that.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stalewatch.llm.tables import pieces
from stalewatch.staging import stage

#: Lines shorter than this many characters only match exactly: one edit would be a different word.
FUZZY_CHARS = 20
#: Bytes of lines whose variants are held at once.
VARIANT_BYTES = 1 << 18
_KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def _halves(line: Column, n: Column) -> Column:
    """Hashes of the prefixes and suffixes that a line shares with a neighbour, as longer and as shorter one."""
    short, long_ = F.floor(n / 2).cast("int"), F.floor((n + 1) / 2).cast("int")

    def part(kind: str, size: Column) -> Column:
        text = F.substring(line, F.lit(1), size) if kind == "p" else F.substring(line, n - size + 1, size)
        return F.xxhash64(F.lit(kind), size, text)

    return F.array_distinct(F.array(*[part(k, s) for k in "ps" for s in (short, long_)]))


def occurrences(docs: DataFrame, doc_id: str, text: str, fuzzy_chars: int = FUZZY_CHARS) -> DataFrame:
    """One row for each line that is not blank: where it is, its length, two hashes, and those of its halves."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    lines = rows.select("doc_id", "digest", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", normalised(F.col("line"))).filter("line <> ''")
    size = F.char_length("line")
    return lines.select(
        "doc_id",
        "digest",
        "line_no",
        size.alias("size"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64("line", F.lit(1)).alias("h2"),
        F.when(size >= fuzzy_chars, _halves(F.col("line"), size)).alias("halves"),
    )


def variant_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a line for substitutions (one per place), for insertions as the longer line, and its own.

    Hashes are polynomials over the characters; without character ``i`` the later powers move down by one.
    The keys of substitutions also carry place and length.
    """
    n = len(codes)
    mixed = []
    for base in _KEYS:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, base)])
        total = np.r_[np.uint64(0), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[:n])]
        mixed.append((total[:n] + (total[n] - total[1:]) * inverse, total[n:]))
    deleted, own = ((a ^ (b >> np.uint64(7))) * _KEYS[1] for a, b in zip(*mixed, strict=True))
    place = np.arange(1, n + 1, dtype=np.uint64) * _KEYS[0] + np.uint64(n)
    return deleted * _KEYS[0] ^ place, np.unique(deleted), own


def _variants(lines: DataFrame) -> DataFrame:
    """``key``, ``role`` (0 substitution, 1 the longer, 2 the shorter of an insertion), ``h1``, ``h2``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "line", VARIANT_BYTES):
            keys, roles, sizes = [], [], []
            for line in batch.column(2).to_pylist():
                found = variant_keys(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32))
                keys += found
                roles += [np.full(len(f), role, dtype=np.int8) for role, f in enumerate(found)]
                sizes.append(sum(len(f) for f in found))
            at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            columns = [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(roles))]
            columns += [batch.column(i).take(at) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "role", "h1", "h2"])

    return lines.select("h1", "h2", "line").mapInArrow(run, "key long, role byte, h1 long, h2 long")


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, removed or changed character at most makes the lines equal; linear in their length."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long_ = sorted((a, b), key=len)
    low, high = 0, len(short)
    while low < high:  # the length of the common prefix
        middle = (low + high + 1) // 2
        low, high = (middle, high) if short[low:middle] == long_[low:middle] else (low, middle - 1)
    return short[low + (len(a) == len(b)) :] == long_[low + 1 :]


def _one_edit_apart(pairs: DataFrame) -> DataFrame:
    """``h1`` and ``h2`` of the pairs of lines that are one edit apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "line"):
            lines = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            yield batch.select(["h1", "h2"]).filter(pa.array([one_edit(a, b) for a, b in lines], pa.bool_()))

    return pairs.mapInArrow(run, "h1 long, h2 long")


def _near(first: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``h1``, ``h2`` of the lines that have an earlier line one edit away; ``first`` has the earliest places."""
    halves = first.filter("halves IS NOT NULL").select("h1", "h2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    open_lines = halves.join(shared, "half", "left_semi").select("h1", "h2").distinct()
    places = first.join(open_lines, ["h1", "h2"], "left_semi").select("h1", "h2", "at.*")
    wanted = places.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("line_no", "h1", "h2")).alias("wanted"))
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("digest"))
    found = texts.join(wanted, same).select("doc_id", "digest", F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
    line = normalised(F.get("lines", F.col("w.line_no")))
    at = F.struct("doc_id", "digest", "w.line_no")
    lines = found.select("w.h1", "w.h2", at.alias("at"), line.alias("line")).dropDuplicates(["h1", "h2"])
    lines = stage(lines, "lines")
    met = _variants(lines).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    placed = met.join(lines.select("h1", "h2", "at"), ["h1", "h2"])
    entry = F.struct("at", "h1", "h2")

    def earliest(*roles: int) -> Column:
        return F.min(F.when(F.col("role").isin(*roles), entry)).over(Window.partitionBy("key"))

    witness = F.when(F.col("role") == 0, earliest(0)).when(F.col("role") == 1, earliest(2)).otherwise(earliest(1))
    later = placed.withColumn("witness", witness).filter(F.col("witness.at") < F.col("at"))
    pairs = later.select("h1", "h2", F.col("witness.h1").alias("w1"), F.col("witness.h2").alias("w2")).distinct()
    other = lines.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("line").alias("other"))
    checked = pairs.join(lines.select("h1", "h2", "line"), ["h1", "h2"]).join(other, ["w1", "w2"])
    return _one_edit_apart(checked.select("h1", "h2", "line", "other")).distinct()


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fuzzy_chars: int = FUZZY_CHARS) -> DataFrame:
    """``doc_id``, ``digest`` (hash of the text) and ``removed``, the sorted numbers of the lines to remove.

    The order of lines is doc_id (null first), hash of the text, line number. Rows that repeat doc_id and
    text are one document. A line goes if an earlier line is equal or one edit away, whether that one stays or not.
    """
    found = stage(occurrences(docs, doc_id, text, fuzzy_chars), "occurrences")
    at = F.struct("doc_id", "digest", "line_no").alias("at")
    first = found.groupBy("h1", "h2").agg(F.min(F.struct(at, "halves")).alias("first"))
    first = stage(first.select("h1", "h2", "first.at", "first.halves"), "first")
    near = _near(first, docs, doc_id, text).select("h1", "h2", F.lit(True).alias("near"))
    settled = stage(first.select("h1", "h2", "at").join(near, ["h1", "h2"], "left"), "settled")
    gone = found.join(settled, ["h1", "h2"]).filter(F.col("near") | (F.struct("doc_id", "digest", "line_no") != F.col("at")))
    return gone.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fuzzy_chars: int = FUZZY_CHARS) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` and ``n_removed``.

    Lines of fewer than ``fuzzy_chars`` characters go only when an earlier line is equal, longer ones also when one is an edit away.
    Blank lines stay. A null text stays null and has no lines; an empty one has one. A document that loses
    all its lines keeps an empty text or its blank lines. Columns named like the new ones are replaced, all
    others stay.
    """
    gone = removed_lines(docs, doc_id, text, fuzzy_chars).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("removed").alias("__removed")
    )
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__digest"))
    joined = docs.drop("n_lines", "n_removed").join(gone, same, "left")
    lines = F.split(F.col(text), "\n")
    places = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__removed"))
    kept = F.array_join(F.transform(places, lambda i: F.get("__lines", i)), "\n")
    counted = joined.withColumn("__lines", lines).withColumns(
        {
            text: F.when(F.col("__removed").isNull(), F.col(text)).otherwise(kept),
            "n_lines": F.coalesce(F.size("__lines"), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size("__removed"), F.lit(0)).cast("long"),
        }
    )
    return counted.drop("__id", "__digest", "__removed", "__lines")
