"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Words are runs of ASCII letters, digits and all characters beyond ASCII, lower-cased A-Z. Every window of
ten consecutive words of an item (an item of fewer words is one window) is a pattern over word numbers.
The automaton reads the words of a text once; the words inside any occurrence are hit. Only texts with
hits are looked at again, to map word numbers to offsets of the original text.

Every task holds the automaton, so the benchmark is measured first and must have at most
``benchmark_bytes`` of text (some 200 bytes of memory for each byte); a larger one raises ``ValueError``
and is to be passed in parts.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.llm.tables import pieces, with_columns
from stalewatch.staging import stage

WINDOW = 10
BENCHMARK_BYTES = 4 << 20
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Fixed value: a word of lower-cased text.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Normalised words as UTF-8."""
    return text.encode().translate(_BYTES).split()


@dataclass
class Patterns:
    """The items; the automaton is built where it is used and not sent."""

    items: list[tuple[int, str]]
    window: int
    automaton: ahocorasick.Automaton | None = None
    numbers: dict[bytes, int] | None = None

    def __getstate__(self) -> dict:
        return {"items": self.items, "window": self.window, "automaton": None, "numbers": None}

    def build(self) -> None:
        numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for item, text in self.items:
            row = tuple(numbers.setdefault(w, len(numbers) + 1) for w in words_of(text))
            size = min(self.window, len(row))
            for start in range(len(row) - size + 1 if row else 0):
                owners.setdefault(row[start : start + size], set()).add(item)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for pattern, who in owners.items():
            automaton.add_word(pattern, (len(pattern), tuple(sorted(who))))
        if owners:
            automaton.make_automaton()
        self.numbers, self.automaton = numbers, automaton if owners else None

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """First and last word of each occurrence, with its items."""
        if self.numbers is None:
            self.build()
        if self.automaton is None or not words:
            return
        get = self.numbers.get
        for end, (size, who) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            yield end - size + 1, end, who


def _parts(benchmark: DataFrame, item: str, text: str, window: int, limit: int) -> Iterator[Patterns]:
    """The items in parts of about ``limit`` bytes of text at most, each collected when it is its turn; one if all fit."""
    items = benchmark.select(F.col(item).cast("long").alias("item"), F.col(text).alias("text")).dropna()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Twice as many as needed, as a hash does not deal them out evenly.
    parts = 1 if size <= limit else 2 * math.ceil(size / limit)
    number = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for part in range(parts):
        yield Patterns([tuple(row) for row in items.filter(number == part).collect()], window)


def _find(patterns: Patterns, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """First and last word of the occurrences, and the items."""
    found, items = [], set()
    for first, last, who in patterns.scan(words):
        found.append((first, last))
        items.update(who)
    return found, items


def _hit(occurrences: list[tuple[int, int]], words: int) -> np.ndarray:
    """Mask of the hit words; empty if none is hit."""
    if not occurrences:
        return np.empty(0, dtype=bool)
    starts, ends = np.array(occurrences).T
    change = np.bincount(starts, minlength=words + 1) - np.bincount(ends + 1, minlength=words + 1)
    return np.cumsum(change)[:-1] > 0


def spans_of(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Code-point spans of the maximal runs of hit words in the original text."""
    if not len(hit):
        return []
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))).reshape(-1, 2)
    at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in edges.tolist()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    benchmark_bytes: int = BENCHMARK_BYTES,
) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``hit_spans`` to every document.

    A null text or one without words has no words and no hit. Items whose id or text is null, or whose text has no words, match
    nothing; items that share a window are all reported. An empty benchmark hits nothing. Columns of the
    documents that have one of the new names are replaced, all others stay.

    One scan, no shuffle, with one automaton in every task, some 120 times the size of its items (470 MB for 4 MB). A
    benchmark of more than ``benchmark_bytes`` of text is worked off in parts, one scan after another: the documents are
    written with what was found so far, and hits and items are united.
    """
    names = ("n_words", "n_hit", "items", "hit_spans")
    kept = [f for f in docs.schema.fields if f.name not in names]
    docs = docs.select(*[f.name for f in kept])
    parts = _parts(benchmark, item, item_text, window, benchmark_bytes)
    patterns, before = next(parts), False
    for following in parts:
        docs, patterns, before = stage(_scan(docs, patterns, text, before, False), "leaks"), following, True
    return _scan(docs, patterns, text, before, True)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_FOUND = "__runs array<struct<first:int,last:int>>, __items array<long>"
_RESULT = "n_words long, n_hit long, items array<long>, hit_spans array<struct<start:int,end:int>>"


def _scan(docs: DataFrame, patterns: Patterns, text: str, before: bool, last: bool) -> DataFrame:
    """Occurrences of one part of the benchmark, united with those of the parts ``before``; the result after the ``last``."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    found_names, names = ("__runs", "__items"), ("n_words", "n_hit", "items", "hit_spans")

    def one(content: str, runs: list[dict[str, int]], items: list[int]) -> tuple:
        words = words_of(content)
        found, who = _find(shared.value, words)
        hit = _hit(found + [(r["first"], r["last"]) for r in runs], len(words))
        who = sorted(who.union(items))
        if last:
            return len(words), int(hit.sum()), who, spans_of(content, hit)
        edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))).reshape(-1, 2).tolist()
        return [{"first": a, "last": b - 1} for a, b in edges], who

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            known = [batch.column(batch.schema.get_field_index(n)).to_pylist() if before else [[]] * len(texts) for n in found_names]
            rows = [one(content or "", *rest) for content, *rest in zip(texts, *known, strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), _SPANS) if last else (_RUNS, pa.list_(pa.int64()))
            columns = {n: pa.array([r[i] for r in rows], kinds[i]) for i, n in enumerate(names if last else found_names)}
            yield with_columns(batch, drop=found_names, **columns)

    kept = [f for f in docs.schema.fields if f.name not in found_names]
    return docs.mapInArrow(run, T.StructType([*kept, *T.StructType.fromDDL(_RESULT if last else _FOUND).fields]))
