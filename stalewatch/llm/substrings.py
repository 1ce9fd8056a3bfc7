"""Repeated word windows by Rabin-Karp hashes, and what stays of every text without them.

A window is a number of consecutive words of one document. Its hash is a polynomial over the digests of its words
modulo 2^64, taken for all windows of a piece of documents at once as a difference of running sums, and 32 bits
of a second polynomial. Pieces of a few megabytes send each of their different windows once, with the least doc_id
that holds it, to buckets by ranges of the hash; Spark shuffles the buckets and every bucket is counted on its own.
What comes back is one bit for each window a piece has sent: whether a smaller doc_id holds it in another piece.
With that bit and its own windows a piece knows all its repeated windows, and merges those that touch or
overlap into maximal intervals.

A window of a third of all documents is sent once by each piece, so no bucket grows with the documents that share it.
The buckets are worked off in rounds over ranges of the hash, which divides the disk of the shuffle. Windows are
equal when 96 bits agree: among 10^13 different windows the chance that any two do is under one in a thousand.
"""

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stalewatch.llm.piecewise import PIECE, bounds, bytes_of, ids_of, numbered_pieces, whole_pieces
from stalewatch.staging import stage

WINDOW = 13
PIECE_BYTES = 4 << 20
#: Text that is split into words at once.
CHUNK_BYTES = 1 << 20
ROUNDS = 2
#: Windows a bucket holds on average, and bytes of text a window stands for when the buckets are numbered.
BUCKET_WINDOWS = 1 << 20
BYTES_A_WINDOW = 6
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SENT = "bucket long, piece long, docs array<long>, runs array<int>, hashes binary, checks binary"
_MASKS = "piece long, bucket long, mask binary"


def word_digests(text: bytes) -> bytes:
    """16 bytes for each word; long texts are split in chunks."""
    digest = xxhash.xxh3_128_digest
    if len(text) <= CHUNK_BYTES:
        return b"".join(map(digest, text.split()))
    found, start = [], 0
    while start < len(text):
        space = _SPACE.search(text, start + CHUNK_BYTES)
        end = space.start() if space else len(text)
        found.append(b"".join(map(digest, text[start:end].split())))
        start = end
    return b"".join(found)


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def rolling(words: np.ndarray, window: int, base: int) -> np.ndarray:
    """Sum of word * base^(place from the end) over every window, modulo 2^64.

    With running sums of word * base^-place, a window is the difference of two sums, shifted back to its place.
    """
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(pow(base, -1, 1 << 64), len(words)), dtype=np.uint64, out=sums[1:])
    return (sums[window:] - sums[:-window]) * _powers(base, len(words))[window - 1 :]


class Windows:
    """All windows of a list of texts: the first word, the document, the hash and the check of each one."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        digests = [word_digests(t) for t in texts]
        self.n_words = np.array([len(d) // 16 for d in digests], np.int64)
        words = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        if len(words) < window:
            self.first = self.owner = np.zeros(0, np.int64)
            self.hash, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
            return
        owner = np.repeat(np.arange(len(texts)), self.n_words)
        self.first = np.flatnonzero(owner[window - 1 :] == owner[: len(owner) - window + 1])
        self.owner = owner[self.first]
        self.hash = rolling(words[:, 0], window, BASES[0])[self.first]
        self.check = (rolling(words[:, 1], window, BASES[1])[self.first] >> np.uint64(32)).astype(np.uint32)


def different(ids: np.ndarray, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place of each window among the different ones, and of those the hash, the check and the least id, by hash and check."""
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    if np.any(~new[1:] & (checks[order[1:]] != checks[order[:-1]])):
        order = np.lexsort((checks, hashes))
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
    starts = np.flatnonzero(new)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
    return place, hashes[order[starts]], checks[order[starts]], least


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _sending_order(hashes: np.ndarray, least: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows by bucket, least id and hash, and the bucket of each; the same whatever the order of the documents."""
    bucket = _bucket(hashes, buckets)
    order = np.lexsort((least, bucket))
    return order, bucket[order]


def _sent(numbered: DataFrame, buckets: int, low: int, high: int, window: int, doc_id: str, text: str) -> DataFrame:
    """The different windows of each piece in the buckets from ``low`` to ``high``, packed by bucket."""

    def one(piece: int, ids: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        found = Windows(texts, window)
        bucket = _bucket(found.hash, buckets)
        mine = (bucket >= low) & (bucket < high)
        _, hashes, checks, least = different(ids[found.owner[mine]], found.hash[mine], found.check[mine])
        order, bucket = _sending_order(hashes, least, buckets)
        hashes, checks, least = hashes[order], checks[order], least[order]
        rows = []
        limits = bounds(bucket)
        for start, end in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            runs = bounds(least[start:end])
            rows.append((int(bucket[start]), piece, least[start:end][runs[:-1]], np.diff(runs), hashes[start:end].tobytes(), checks[start:end].tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
        names = ("bucket", "piece", "docs", "runs", "hashes", "checks")
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, texts in whole_pieces(batches, doc_id, text):
            yield one(number, ids, texts)

    return numbered.select(PIECE, doc_id, text).mapInArrow(run, _SENT)


def count_bucket(table: pa.Table) -> pa.Table:
    """One row for each piece that has sent a window to the bucket which a smaller id holds elsewhere."""
    sizes = np.array([len(h) // 8 for h in table["hashes"].to_pylist()], np.int64)
    hashes = np.frombuffer(b"".join(table["hashes"].to_pylist()), "<u8")
    checks = np.frombuffer(b"".join(table["checks"].to_pylist()), "<u4")
    docs, runs = (np.concatenate([np.asarray(x.values) for x in table[name]]) for name in ("docs", "runs"))
    ids = np.repeat(docs, runs)
    place, _, _, least = different(ids, hashes, checks)
    repeated = ids > least[place]
    rows = []
    starts = np.cumsum(sizes) - sizes
    for piece, bucket, start, size in zip(table["piece"].to_pylist(), table["bucket"].to_pylist(), starts.tolist(), sizes.tolist(), strict=True):
        bits = repeated[start : start + size]
        if bits.any():
            rows.append((piece, bucket, np.packbits(bits).tobytes()))
    kinds = {"piece": pa.int64(), "bucket": pa.int64(), "mask": pa.binary()}
    return pa.table({n: pa.array([r[i] for r in rows], k) for i, (n, k) in enumerate(kinds.items())})


def removed_words(ids: np.ndarray, found: Windows, masks: list[tuple[int, bytes]], buckets: int, window: int) -> np.ndarray:
    """Whether each word of a piece lies in a window that a smaller id holds."""
    place, hashes, _, least = different(ids[found.owner], found.hash, found.check)
    order, bucket = _sending_order(hashes, least, buckets)
    elsewhere = np.zeros(len(order), bool)
    for number, mask in masks:
        start, end = np.searchsorted(bucket, [number, number + 1])
        elsewhere[order[start:end]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=end - start).astype(bool)
    repeated = found.first[elsewhere[place] | (least[place] < ids[found.owner])]
    ends = np.zeros(int(found.n_words.sum()) + 1, np.int64)
    np.add.at(ends, repeated, 1)
    np.add.at(ends, repeated + window, -1)
    return np.cumsum(ends[:-1]) > 0


_RESULT = "n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the intervals of repeated words and the text that stays.

    New columns: ``n_words``, ``n_removed``, ``spans`` (maximal removed runs as word numbers, end exclusive) and ``kept`` (the
    other words, joined by one space); columns of these names are replaced. A word goes when it lies in a window
    that also starts in a document of a smaller doc_id; rows with one doc_id, also repeated ones, take nothing from
    each other. A null doc_id counts as the largest long, a null text has no words. Texts of fewer words than a
    window stay whole. One row for each input row. A piece is held by one task: a few megabytes, or one longer text.
    """
    names = ("n_words", "n_removed", "spans", "kept")
    docs = docs.drop(*[c for c in docs.columns if c in names and c not in (doc_id, text)])
    numbered = numbered_pieces(docs, text, PIECE_BYTES)
    count = numbered.select(PIECE).distinct().count()
    per_round = max(1, round(count * PIECE_BYTES / BYTES_A_WINDOW / BUCKET_WINDOWS / ROUNDS))
    buckets = per_round * ROUNDS
    masks = None
    for r in range(ROUNDS):
        sent = _sent(numbered, buckets, r * per_round, (r + 1) * per_round, window, doc_id, text)
        counted = stage(sent.groupBy("bucket").applyInArrow(count_bucket, _MASKS), "masks")
        masks = counted if masks is None else masks.union(counted)
    kept_fields = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*kept_fields, *T.StructType.fromDDL(_RESULT).fields])
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids, texts = ids_of(rows[doc_id]), bytes_of(rows[text])
        windows = Windows(texts, window)
        sent = list(zip(found["bucket"].to_pylist(), found["mask"].to_pylist(), strict=True))
        gone = removed_words(ids, windows, sent, buckets, window)
        out = {"n_words": windows.n_words.tolist(), "n_removed": [], "spans": [], "kept": []}
        start = 0
        for t, size in zip(texts, out["n_words"], strict=True):
            flags = gone[start : start + size]
            start += size
            edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
            out["n_removed"].append(int(flags.sum()))
            out["spans"].append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            out["kept"].append(b" ".join(compress(t.split(), ~flags)).decode())
        columns = [rows[f.name] for f in kept_fields]
        columns += [pa.array(out[n], kinds.get(n, spans)) for n in names]
        return pa.table(columns, names=[*(f.name for f in kept_fields), *names])

    both = numbered.groupBy(PIECE).cogroup(masks.groupBy("piece"))
    return both.applyInArrow(finish, schema)
