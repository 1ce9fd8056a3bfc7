"""Alignment of two tokenizers' tokens over the bytes of each text, by pointer jumping.

The tokens of both vocabularies are intervals over one string of bytes. Every token points to the farthest-right token
of the other vocabulary that it overlaps; a piece token that ends where a byte token ends points to itself.
Replacing each pointer by the pointer of its target, for all tokens at once, doubles the distance
until nothing moves; each token then points to the last token of its group, which labels the group. The
documents of a piece lie one after the other in one string, as both vocabularies end a token where a document ends.

Two tokens of different vocabularies are linked when they end together. Then the bytes of the shorter one end those of the
longer one, so a token has at most as many partners that are shorter as it has bytes: the different linked pairs are
fewer than the bytes of both vocabularies together, whatever the corpus. Their corpus-wide counts start with one count for each
piece of megabytes, so a pair that is in every document is no hot key, and the table of counts goes to every task.
"""

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.llm.tables import pieces
from stalewatch.staging import stage

PIECE_BYTES = 2 << 20
#: Characters given to a tokenizer at once.
STEP_CHARS = 1 << 18
LONG_RUN = 5_000
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_RUN)
SPACE = "▁"
#: Between a letter and a space with a letter behind it neither vocabulary joins anything.
_CUT = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_STAGED = ("__a_ids", "__b_ids", "__a_sizes", "__b_sizes", "__pairs", "__times")
_RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _byte_letters() -> dict[str, int]:
    """The letters a byte-level vocabulary writes for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _strict_encoder(path: str) -> Callable[[str], list[int]]:
    """The library of the vocabulary file itself; slower, but with no bound on runs of white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    return lambda text: model.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def byte_vocabulary(path: str) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """Encoder of a byte-level vocabulary without special tokens, and the bytes of each id.

    Ids rise in the order of the merges, so they are the ranks a faster library asks for; its pattern of words cannot
    read very long runs of white space, which go to the library of the file.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    letters = _byte_letters()
    entries = content["model"]["vocab"]
    table = [b""] * (1 + max([*entries.values(), *(t["id"] for t in content["added_tokens"])]))
    for entry, number in entries.items():
        table[number] = bytes(letters[c] for c in entry)
    ranks = {b: i for i, b in enumerate(table) if b}
    model = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if len(text) > LONG_RUN and _LONG_SPACE.search(text):
            return np.array(_strict_encoder(path)(text), np.int32)
        return model.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    return encode, table


@lru_cache(maxsize=2)
def piece_vocabulary(path: str) -> tuple[Callable[[str], np.ndarray], list[bytes]]:
    """Encoder of a SentencePiece vocabulary, and the bytes of each id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        code = _BYTE_PIECE.fullmatch(piece) if model.is_byte(number) else None
        table.append(bytes([int(code[1], 16)]) if code else piece.replace(SPACE, " ").encode())
    return lambda text: np.array(model.encode(text), np.int32), table


def parts(text: str) -> list[str]:
    """The text in parts of about ``STEP_CHARS`` that tokenize on their own; each but the first begins with a space."""
    found, start = [], 0
    while len(text) - start > STEP_CHARS:
        cut = _CUT.search(text, start + STEP_CHARS)
        if cut is None:
            break
        found.append(text[start : cut.start()])
        start = cut.start()
    return [*found, text[start:]]


def _gives_back(ids: np.ndarray, table: list[bytes], whole: bytes) -> bool:
    return b"".join(map(table.__getitem__, ids.tolist())) == whole


def encode_both(text: str | None, byte_model: str, piece_model: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a text by both vocabularies; none where the bytes of the tokens are not the space and the text."""
    nothing = np.zeros(0, np.int32)
    if not text:
        return nothing, nothing
    (a_encode, a_table), (b_encode, b_table) = byte_vocabulary(byte_model), piece_vocabulary(piece_model)
    a_ids, b_ids = [], []
    for k, part in enumerate(parts(text)):
        # The piece vocabulary puts its own space before what it is given.
        a, b = a_encode(part if k else " " + part), b_encode(part[1:] if k else part)
        whole = (part if k else " " + part).encode()
        if not (_gives_back(a, a_table, whole) and _gives_back(b, b_table, whole)):
            return nothing, nothing
        a_ids.append(a)
        b_ids.append(b)
    return np.concatenate(a_ids), np.concatenate(b_ids)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of every token, by pointer jumping; both lists of ends rise to the same last byte."""
    n_a = len(a_ends)
    a_points = n_a + np.searchsorted(b_ends, a_ends)
    last_a = np.searchsorted(a_ends, b_ends)
    is_last = a_ends[np.minimum(last_a, max(n_a - 1, 0))] == b_ends if n_a else np.zeros(0, bool)
    points = np.concatenate([a_points, np.where(is_last, n_a + np.arange(len(b_ends)), last_a)])
    while True:
        farther = points[points]
        if np.array_equal(farther, points):
            break
        points = farther
    number = np.cumsum(is_last) - 1
    label = number[points - n_a]
    return label[:n_a], label[n_a:]


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _joined(ids: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(ids).astype(np.int64), np.array([len(x) for x in ids], np.int64)


def _aligned(docs: DataFrame, byte_model: str, piece_model: str, text: str) -> DataFrame:
    """Ids and group sizes of each text, and on the first row of each piece the count of every linked pair."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        (a, a_count), (b, b_count) = map(_joined, zip(*[encode_both(t, byte_model, piece_model) for t in texts], strict=True))
        size_of = [np.array([len(x) for x in table], np.int64) for _, table in (byte_vocabulary(byte_model), piece_vocabulary(piece_model))]
        a_label, b_label = group_labels(np.cumsum(size_of[0][a]), np.cumsum(size_of[1][b]))
        groups = int(b_label[-1]) + 1 if len(b_label) else 0
        a_sizes, b_sizes = np.bincount(a_label, minlength=groups), np.bincount(b_label, minlength=groups)
        a_last, b_last = a[np.cumsum(a_sizes) - 1], b[np.cumsum(b_sizes) - 1]
        pairs, times = np.unique(b_last << 32 | a_last, return_counts=True)
        # Groups of a document: those whose last token is among its tokens.
        ends = np.searchsorted(np.cumsum(b_sizes), np.cumsum(b_count), side="right")
        n_groups = np.diff(ends, prepend=0)
        first = np.zeros(batch.num_rows, np.int64)
        first[0] = len(pairs)
        columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
        columns += [
            _lists(a, a_count, pa.int32()), _lists(b, b_count, pa.int32()),
            _lists(a_sizes, n_groups, pa.int32()), _lists(b_sizes, n_groups, pa.int32()),
            _lists(pairs, first, pa.int64()), _lists(times, first, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), *_STAGED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PIECE_BYTES):
            yield one(batch)

    kinds = ["array<int>"] * 4 + ["array<long>"] * 2
    added = T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in zip(_STAGED, kinds, strict=True)))
    return docs.mapInArrow(run, T.StructType([*kept, *added.fields]))


@lru_cache(maxsize=1)
def _written(a_size: int, b_size: int) -> tuple[list[str], int]:
    """Ids as text with what follows them: inside a group, and at the end of its half."""
    table = [f"{i}{mark}" for i in range(a_size) for mark in ",|"] + [f"{i}{mark}" for i in range(b_size) for mark in ",;"]
    return table, 2 * a_size


def notation(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, vocabularies: tuple[int, int]) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, byte tokens first."""
    table, half = _written(*vocabularies)
    before_b, before_a = np.cumsum(b_sizes) - b_sizes, np.cumsum(a_sizes)
    codes = np.empty(len(a) + len(b), np.int64)
    a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_last[np.cumsum(a_sizes) - 1] = b_last[np.cumsum(b_sizes) - 1] = 1
    codes[np.arange(len(a)) + np.repeat(before_b, a_sizes)] = 2 * a + a_last
    codes[np.arange(len(b)) + np.repeat(before_a, b_sizes)] = half + 2 * b + b_last
    return "".join(map(table.__getitem__, codes.tolist()))[:-1]


def _pair_counts(aligned: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every linked pair in order, its corpus-wide count, and whether no pair of its piece id has more."""
    linked = aligned.select(F.explode(F.arrays_zip(F.col("__pairs").alias("pair"), F.col("__times").alias("times"))).alias("link"))
    totals = stage(linked.groupBy("link.pair").agg(F.sum("link.times").alias("total")), "totals")
    by_piece_id = totals.groupBy(F.shiftright("pair", 32).alias("b_id")).agg(F.max("total").alias("most"))
    known = totals.withColumn("b_id", F.shiftright("pair", 32)).join(by_piece_id, "b_id")
    # Bounded by the bytes of the vocabularies.
    table = known.select("pair", "total", (F.col("total") == F.col("most")).alias("best")).toArrow().sort_by("pair")
    return tuple(table[name].to_numpy() for name in ("pair", "total", "best"))


def align(docs: DataFrame, byte_model: str, piece_model: str, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the groups of its tokens in both vocabularies and the counts of their links.

    New columns, which replace those of the same name: ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair is as frequent in the corpus as any pair of its piece id), ``count_sum`` (corpus-wide counts, summed over the
    links) and ``groups`` (see :func:`notation`). Null and empty texts, and those whose tokens do not give back the
    space and the text, have no tokens: zeros and an empty string. One row for each input row, repeated rows count each.
    """
    names = tuple(T.StructType.fromDDL(_RESULT).names)
    docs = docs.drop(*[c for c in docs.columns if c in (*names, *_STAGED) and c != text])
    aligned = stage(_aligned(docs, byte_model, piece_model, text), "aligned")
    pair, total, best = _pair_counts(aligned)
    kept = [f for f in aligned.schema.fields if f.name not in _STAGED]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = len(byte_vocabulary(byte_model)[1]), len(piece_vocabulary(piece_model)[1])
        kinds = [*[pa.int64()] * 6, pa.string()]
        for batch in batches:
            tokens = [batch.column(batch.schema.get_field_index(n)) for n in _STAGED[:4]]
            out: list[tuple] = []
            for row in range(batch.num_rows):
                a, b, a_sizes, b_sizes = (np.asarray(t[row].values, np.int64) for t in tokens)
                if not len(b):
                    out.append((0, 0, 0, 0, 0, 0, ""))
                    continue
                place = np.searchsorted(pair, b[np.cumsum(b_sizes) - 1] << 32 | a[np.cumsum(a_sizes) - 1])
                counts = (len(a), len(b), len(a_sizes), len(place), int(best[place].sum()), int(total[place].sum()))
                out.append((*counts, notation(a, b, a_sizes, b_sizes, sizes)))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), *names])

    schema = T.StructType([*kept, *T.StructType.fromDDL(_RESULT).fields])
    return aligned.drop("__pairs", "__times").mapInArrow(finish, schema)
