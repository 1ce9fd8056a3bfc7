"""How the sources of a language differ in their terms, by row accumulation over a term-major index.

Every group (language and source) gives each term that its language keeps a smoothed chance p, a whole number of
billionths. A group is compared with every other source of its language by the sum of floor((p - q)^2 / q) over
all kept terms, and lists the terms it uses more than its language does.

Gustavson's product computes one row of a sparse product at a time: the terms of a group are looked up in the
term-major index and what they find is scattered into a dense accumulator with one place for each peer. Here blocks
of terms are index parts of bounded size, and every task accumulates the rows of the groups in its block; no pair
of postings leaves the task. A term that only one of two groups uses, or neither, still counts, with
the chance of a zero count. These baselines are exact too: equal counts give equal chances, so the histogram of a
group's counts is enough, and the accumulated rows correct them where both groups use a term.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stalewatch.llm.tables import pieces
from stalewatch.staging import StageArea, stage

LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
PIECE_BYTES = 4 << 20
#: Postings in a block of the index, entries of the histograms in a block of peers, and values computed at once.
BLOCK_POSTINGS = 200_000
BLOCK_ENTRIES = 100_000
STEP = 1 << 20
#: ASCII letters in lower case and all beyond ASCII; the rest separates.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "group long, peer long, value long"


def _empty_for_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def term_counts(docs: DataFrame) -> DataFrame:
    """``n`` occurrences and ``docs`` documents of each (lang, source, term); pieces are counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE_BYTES):
            uses: dict[tuple[str, str], Counter[bytes]] = {}
            holds: dict[tuple[str, str], Counter[bytes]] = {}
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                words = text.as_py().translate(_TERMS).split()
                uses.setdefault((lang, source), Counter()).update(words)
                holds.setdefault((lang, source), Counter()).update(set(words))
            for (lang, source), found in uses.items():
                terms = list(found)
                size = len(terms)
                seen = holds[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * size, pa.string()),
                        pa.array([source] * size, pa.string()),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(found.values(), pa.int64()),
                        pa.array([seen[t] for t in terms], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )

    rows = docs.select("lang", "source", _empty_for_null("text")).mapInArrow(run, _COUNTS)
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def chance(n: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / whole), exact."""
    product = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.call_function("div", product, whole.cast("decimal(19,0)")) + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def accumulate(table: pa.Table) -> pa.Table:
    """Corrections of one block of terms for all pairs of groups that use a term of it together."""
    term, group = np.unique(table["term"].to_pylist(), return_inverse=True)[1], table["group"].to_numpy()
    order = np.lexsort((group, term))
    peers, place = np.unique(group[order], return_inverse=True)
    term = term[order]
    p, zero = table["p"].to_numpy()[order], table["zero"].to_numpy()[order]
    starts = np.searchsorted(term, np.arange(term[-1] + 2))
    sizes = np.diff(starts)
    found = []
    rows = np.split(np.argsort(place, kind="stable"), np.cumsum(np.bincount(place))[:-1])
    for row, mine in enumerate(rows):
        sums, seen = np.zeros(len(peers), np.int64), np.zeros(len(peers), bool)
        reach = np.cumsum(sizes[term[mine]])
        for part in np.split(mine, np.searchsorted(reach, np.arange(STEP, int(reach[-1]), STEP))):
            if not len(part):
                continue
            lengths = sizes[term[part]]
            before = np.cumsum(lengths) - lengths
            other = np.repeat(starts[term[part]] - before, lengths) + np.arange(int(lengths.sum()))
            own_p, own_zero = np.repeat(p[part], lengths), np.repeat(zero[part], lengths)
            both = distance(own_p, p[other]) - distance(own_p, zero[other]) - distance(own_zero, p[other]) + distance(own_zero, zero[other])
            np.add.at(sums, place[other], both)
            seen[place[other]] = True
        seen[row] = False
        found.append((np.full(int(seen.sum()), peers[row]), peers[seen], sums[seen]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    return pa.table(columns, names=["group", "peer", "value"])


def baseline(own: dict, block: list[dict], kept: int) -> tuple[list[int], np.ndarray]:
    """What a group and each peer of a block would differ by if they used no term together."""
    peers = [peer["group"] for peer in block]
    zeros = np.array([peer["zero"] for peer in block], np.int64)
    lengths = np.array([len(peer["counted"]) for peer in block])
    nothing = distance(np.int64(own["zero"]), zeros)
    sums = kept * nothing
    for at in range(0, len(own["counted"]), 256):
        part = own["counted"][at : at + 256]
        p = np.array([c["p"] for c in part], np.int64)[:, None]
        terms = np.array([c["terms"] for c in part], np.int64)[:, None]
        sums = sums + (terms * (distance(p, zeros[None, :]) - nothing[None, :])).sum(axis=0)
    place = np.repeat(np.arange(len(block)), lengths)
    p = np.array([c["p"] for peer in block for c in peer["counted"]], np.int64)
    terms = np.array([c["terms"] for peer in block for c in peer["counted"]], np.int64)
    np.add.at(sums, place, terms * (distance(np.int64(own["zero"]), p) - nothing[place]))
    return peers, sums


def _baselines(histograms: DataFrame) -> DataFrame:
    """The baseline of each group against all peers of its language, read in blocks of peers."""
    entries = F.greatest(F.size("counted"), F.lit(1))
    sizes = histograms.groupBy("lang").agg(F.ceil(F.sum(entries) / BLOCK_ENTRIES).alias("blocks"))
    row = F.struct("group", "zero", "counted").alias("peer")
    placed = histograms.join(sizes, "lang").select("lang", F.expr("pmod(xxhash64(group), blocks)").alias("block"), row)
    blocks = placed.groupBy("lang", "block").agg(F.collect_list("peer").alias("peers"))
    own = histograms.select("lang", "kept", F.struct("group", "zero", "counted").alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1).to_pylist()[0]
                peers, sums = baseline(one["own"], one["peers"], one["kept"])
                me = one["own"]["group"]
                others = [(p, s) for p, s in zip(peers, sums.tolist(), strict=True) if p != me]
                rows = ([me] * len(others), [p for p, _ in others], [s for _, s in others])
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["group", "peer", "value"])

    return own.join(blocks.select("lang", "peers"), "lang").select("own", "peers", "kept").mapInArrow(run, _PAIRS)


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if most is None else ranked.filter(F.col("rank") <= most)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has all other sources of the language, part ``term`` the 200 most telling terms.

    Null texts, languages and sources count as empty ones; other columns are not read. Each row is a document, also when it is
    repeated. A language keeps the terms that at least three of its documents hold; one that keeps none gives every pair
    the value 0 and no terms. Equal values are ranked by the bytes of the item. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    docs = docs.select(_empty_for_null("lang"), _empty_for_null("source"), "text")
    with StageArea(spark) as area:
        counts = area(term_counts(docs), "counts")
        by_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        kept = area(by_term.filter(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")
        used = area(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "used")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_sum"))
        totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = docs.select("lang", "source").distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        number = {c: F.coalesce(c, F.lit(0)) for c in ("kept", "lang_sum", "total")}
        whole = number["total"] + number["kept"]
        zero = F.when(whole > 0, chance(F.lit(0), whole)).otherwise(F.lit(1).cast("long"))
        groups = groups.select(
            F.monotonically_increasing_id().alias("group"), "lang", "source", number["kept"].alias("kept"), whole.alias("whole"),
            (number["lang_sum"] + number["kept"]).alias("lang_whole"), zero.alias("zero"),
        )
        groups = area(groups, "groups")
        postings = used.join(groups, ["lang", "source"]).withColumn("p", chance(F.col("n"), F.col("whole")))
        postings = area(postings.select("lang", "source", "group", "term", "p", "zero", "lang_n", "lang_whole"), "postings")
        blocks = max(1, math.ceil(postings.count() / BLOCK_POSTINGS))
        indexed = postings.select("lang", F.expr(f"pmod(xxhash64(term), {blocks})").alias("block"), "term", "group", "p", "zero")
        together = indexed.groupBy("lang", "block").applyInArrow(accumulate, _PAIRS)
        same_p = postings.groupBy("group", "p").agg(F.count(F.lit(1)).alias("terms"))
        packed = same_p.groupBy("group").agg(F.collect_list(F.struct("p", "terms")).alias("counted"))
        nothing = F.array().cast("array<struct<p:bigint,terms:bigint>>")
        histograms = groups.join(packed, "group", "left").withColumn("counted", F.coalesce("counted", nothing))
        histograms = area(histograms.select("lang", "group", "zero", "kept", "counted"), "histograms")
        summed = together.union(_baselines(histograms)).groupBy("group", "peer").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
        named = groups.select("group", "lang", "source")
        pairs = summed.join(named, "group").join(groups.select(F.col("group").alias("peer"), F.col("source").alias("item")), "peer")
        pairs = _ranked(pairs.select("lang", "source", "item", "value"))
        q = chance(F.col("lang_n"), F.col("lang_whole"))
        terms = postings.withColumn("q", q).filter("p > q")
        terms = terms.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
        parts = [("pair", pairs), ("term", _ranked(terms, TOP_TERMS))]
        columns = ("lang", "source", "part", "item", "value", "rank")
        whole_result = [rows.withColumn("part", F.lit(name)).select(*columns) for name, rows in parts]
        return stage(whole_result[0].union(whole_result[1]), "audit")
