"""Removal of bytes covered by a 50-byte string that also starts in a document of a smaller id, by sorted suffixes.

A full suffix array holds every suffix; here it is sparse. In each 50-byte string the 20 bytes of least hash are its
lead, a choice that depends on the string alone: equal strings have their lead at the same place, so only suffixes that
start at a lead are sorted, one in sixteen. A suffix is compared over the strings it was chosen in: 50 bytes from the
lead on, and as many of the 30 before it.

1. Splitters from a sample range-partition the suffixes by their leading bytes. Equal leads always fall in one
   bucket, so a boundary never lies between two suffixes that have to be compared.
2. Pieces of a few megabytes send each of their different suffixes once, with the least id that holds it. A suffix
   of a third of all documents is sent once by each piece, so no bucket grows with the documents that share it.
3. A bucket is sorted by multikey sorting, word after word among those still equal. Equal neighbours become one with
   their least id; of a lead with several different suffixes, the strings are compared byte by byte, each place of the
   lead in the string by itself.
4. What comes back is a mask for each suffix a piece has sent: which of its strings a smaller id holds. With that and
   its own least ids a piece knows all its bytes that go.

Hashes choose leads and speed up comparisons; every equality is decided on the bytes. The buckets are worked off in
rounds, which divides the disk of the shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.llm.piecewise import LAST, PIECE, bounds, bytes_of, ids_of, numbered_pieces, whole_pieces
from stalewatch.staging import stage

LENGTH = 50
LEAD = 20
#: Places a lead can have in a string.
PLACES = LENGTH - LEAD + 1
#: A suffix as it is sent: 50 bytes from the lead on, padded; 30 bytes before it; least and greatest place of the lead.
RIGHT, BEFORE = 56, PLACES - 1
WORDS = (RIGHT + BEFORE + 2) // 8
PIECE_BYTES = 2 << 20
ROUNDS = 3
BUCKET_SUFFIXES = 1 << 17
#: Documents, expected, and leads of each that give the splitters; they only balance the buckets.
SAMPLED_DOCS = 1000
SAMPLED_LEADS = 32
#: Suffixes whose strings are compared at once.
STEP = 1 << 16
#: Strings, and rows, that are worked on at once, so that their words stay in the processor's cache.
BLOCK, BLOCK_ROWS = 1 << 14, 1 << 11
#: Low bits of a hash that give way to a place in a block of strings.
_LOW = np.uint64((1 << 16) - 1)
BATCH_BYTES = 64 << 20
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SENT = "bucket long, piece long, ids array<long>, runs array<int>, suffixes binary"
_MASKS = "piece long, bucket long, masks binary"


def _kept_bytes() -> np.ndarray:
    """For least and greatest place of a lead, which bytes of a row belong to its strings, as words of set bits."""
    at, places = np.arange(BEFORE + LENGTH), np.arange(PLACES)
    kept = (at >= BEFORE - places[:, None]) & (at < BEFORE + LENGTH - places[:, None, None])
    rows = np.zeros((PLACES, PLACES, 8 * WORDS), np.uint8)
    rows[:, :, :LENGTH], rows[:, :, RIGHT:-2] = kept[:, :, BEFORE:] * 255, kept[:, :, :BEFORE] * 255
    return rows.reshape(PLACES * PLACES, -1).view(np.uint64)


_KEPT = _kept_bytes()


def _lead_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``LEAD`` bytes at every place, from three words that cover them. Its high bits are the best ones."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    n = len(data) - LEAD + 1
    value = words[:n] * np.uint64(_BASE)
    value += words[8 : 8 + n] * _MIX
    value += words[12 : 12 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    value ^= value >> np.uint64(32)
    value *= _MIX
    return value


class Leads:
    """The leads of all 50-byte strings of some texts: place, first string, number of strings (consecutive), document."""

    def __init__(self, texts: list[bytes]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.place = self.first = self.count = self.owner = np.zeros(0, np.int64)
        strings = len(self.data) - LENGTH + 1
        if strings < 1:
            return
        ends = np.cumsum(self.sizes)
        starts = ends - self.sizes
        # A text's strings begin at its start and end with the last one that lies in it.
        cuts = np.unique(np.concatenate([starts, np.maximum(ends - LENGTH + 1, starts)]))
        firsts, places, last = [], [], -1
        for begin in range(0, strings, BLOCK):
            best = self._best(begin, min(begin + BLOCK, strings))
            new = np.empty(len(best), bool)
            new[0] = int(best[0] & _LOW) + begin != last
            np.not_equal(best[1:], best[:-1], out=new[1:])
            new[cuts[slice(*np.searchsorted(cuts, [begin, begin + len(best)]))] - begin] = True
            first = np.flatnonzero(new)
            firsts.append(first + begin)
            places.append((best[first] & _LOW).astype(np.int64) + begin)
            last = int(best[-1] & _LOW) + begin
        first, place = np.concatenate(firsts), np.concatenate(places)
        owner = np.searchsorted(ends, first, side="right")
        inside = np.flatnonzero(first + LENGTH <= ends[owner])
        self.count = np.diff(first, append=strings)[inside]
        self.first, self.place, self.owner = first[inside], place[inside], owner[inside]

    def _best(self, begin: int, end: int) -> np.ndarray:
        """Of each string from ``begin`` to ``end`` the least hash, with its place in the low bits: of equal ones the first.

        The same bits of a hash count in every block, so that the choice depends on the string alone.
        """
        best = _lead_hashes(self.data[begin : end + LENGTH - 1])
        best &= ~_LOW
        best |= np.arange(len(best), dtype=np.uint64)
        width = 1
        while width < PLACES:
            step = min(width, PLACES - width)
            best, width = np.minimum(best[: len(best) - step], best[step:]), width + step
        return best

    def keys(self) -> np.ndarray:
        """The eight leading bytes of each suffix as one number."""
        if not len(self.place):
            return np.zeros(0, np.uint64)
        return np.ndarray((len(self.data) - 7,), "V8", self.data, strides=(1,))[self.place].view(">u8").astype(np.uint64)

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest place of each lead in its strings."""
        most = self.place - self.first
        return most - self.count + 1, most

    def suffixes(self, some: np.ndarray) -> np.ndarray:
        """The chosen suffixes as they are sent, one row of ``8 * WORDS`` bytes each; bytes beyond their strings are zero."""
        least, most = (places[some] for places in self.ends())
        kinds, place = least * PLACES + most, self.place[some]
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(RIGHT, np.uint8)])
        before = np.ndarray((len(self.data),), f"V{8 * WORDS - RIGHT}", padded, strides=(1,))
        after = np.ndarray((len(self.data),), f"V{RIGHT}", padded, offset=BEFORE, strides=(1,))
        rows = np.empty((len(place), WORDS), np.uint64)
        for start in range(0, len(place), BLOCK_ROWS):
            part = slice(start, start + BLOCK_ROWS)
            rows[part, : RIGHT // 8] = after[place[part]].view(np.uint64).reshape(-1, RIGHT // 8)
            rows[part, RIGHT // 8 :] = before[place[part]].view(np.uint64).reshape(-1, WORDS - RIGHT // 8)
            rows[part] &= _KEPT[kinds[part]]
        rows = rows.view(np.uint8)
        rows[:, -2], rows[:, -1] = least, most
        return rows


def _row_hashes(words: np.ndarray) -> np.ndarray:
    value = np.full(len(words), _BASE, np.uint64)
    for start in range(0, len(words), BLOCK_ROWS):
        part = value[start : start + BLOCK_ROWS]
        for column in words[start : start + BLOCK_ROWS].T:
            part ^= column
            part *= _MIX
            part ^= part >> np.uint64(32)
    return value


def multikey_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and which in that order begins a run of equal rows.

    Sorted by the first word, then those still equal by the next one, until none is left.
    """
    column = np.ascontiguousarray(words[:, 0])
    order = np.argsort(column)
    column = column[order]
    new = np.r_[True, column[1:] != column[:-1]][: len(order)]
    for k in range(1, words.shape[1]):
        # Places of rows with an equal neighbour, and the run of each.
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            break
        fresh = new[tied]
        run = np.cumsum(fresh)
        values = words[order[tied], k]
        differ = ~fresh[1:] & (values[1:] != values[:-1])
        mixed = np.zeros(int(run[-1]) + 1, bool)
        mixed[run[1:][differ]] = True
        unsorted = np.flatnonzero(mixed[run])
        if len(unsorted):
            inner = unsorted[np.lexsort((values[unsorted], run[unsorted]))]
            order[tied[unsorted]], values[unsorted] = order[tied[inner]], values[inner]
            new[tied[1:]] |= values[1:] != values[:-1]
    return order, new


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows: sorted by the first word, then runs of equal rows by the next one, until none is left."""
    return multikey_runs(words)[0]


def _distinct(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows by hash: place of each row among them, a row of each, and its least id."""
    words = rows.view(np.uint64)
    hashes = _row_hashes(words)
    order = np.argsort(hashes)
    sorted_hashes = hashes[order]
    same = np.r_[False, sorted_hashes[1:] == sorted_hashes[:-1]][: len(order)]
    equal = np.zeros(len(order), bool)
    at = np.flatnonzero(same)
    equal[at] = (words[order[at]] == words[order[at - 1]]).all(axis=1)
    if (same & ~equal).any():  # different rows of one hash
        order = np.lexsort((*words.T, hashes))
        equal = np.r_[False, (words[order[1:]] == words[order[:-1]]).all(axis=1)]
    starts = np.flatnonzero(~equal)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(~equal) - 1
    return place, order[starts], np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on; where key and place fit into one number, that is sorted."""
    n = len(keys)
    if n and int(keys.max()) >= (1 << 63) // n - 1:
        return np.argsort(keys, kind="stable")
    packed = keys * n + np.arange(n)
    packed.sort()
    return packed % max(n, 1)


class Sent:
    """The different suffixes of a piece in some buckets, in the order in which they are sent."""

    def __init__(self, leads: Leads, ids: np.ndarray, splitters: np.ndarray, low: int, high: int) -> None:
        keys = leads.keys()
        chosen = np.ones(len(keys), bool)
        if low:
            chosen = keys >= splitters[low - 1] if low <= len(splitters) else ~chosen
        if high <= len(splitters):
            chosen &= keys < splitters[high - 1]
        self.chosen = np.flatnonzero(chosen)
        self._rows = leads.suffixes(self.chosen)
        known, rank = np.unique(ids, return_inverse=True)
        place, some, least = _distinct(self._rows, rank[leads.owner[self.chosen]])
        bucket = np.searchsorted(splitters, keys[self.chosen[some]], side="right")
        # By bucket, least id and hash: the same whatever the order of the documents.
        order = stable_order(bucket * len(known) + least)
        self._some, self.least, self.bucket = some[order], known[least[order]], bucket[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        #: Of each chosen lead, the place of its suffix among those sent.
        self.place = back[place]

    @property
    def rows(self) -> np.ndarray:
        return self._rows.view(np.uint64).take(self._some, axis=0).view(np.uint8)


def _binary(values: np.ndarray, limits: np.ndarray) -> pa.Array:
    """Byte strings that lie one after the other, between neighbouring limits."""
    offsets = pa.array(limits - limits[0], pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(limits) - 1, [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def _lists(values: pa.Array, limits: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), values)


def _batches(sent: Sent, piece: int) -> Iterator[pa.RecordBatch]:
    """The suffixes of a piece, one row for each bucket; batches of up to ``BATCH_BYTES``, or one bucket."""
    rows, limits = sent.rows, bounds(sent.bucket)
    start = 0
    while start < len(limits) - 1:
        end = max(start + 1, int(np.searchsorted(limits, limits[start] + BATCH_BYTES // (8 * WORDS), side="right")) - 1)
        part, a, b = limits[start : end + 1], limits[start], limits[end]
        bucket, least = sent.bucket[a:b], sent.least[a:b]
        runs = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (least[1:] != least[:-1])])
        of = np.searchsorted(runs, part - a)
        columns = {
            "bucket": pa.array(sent.bucket[part[:-1]], pa.int64()),
            "piece": pa.array(np.full(len(part) - 1, piece), pa.int64()),
            "ids": _lists(pa.array(least[runs], pa.int64()), of),
            "runs": _lists(pa.array(np.diff(runs, append=b - a), pa.int32()), of),
            "suffixes": _binary(rows[a:b], part * (8 * WORDS)),
        }
        yield pa.RecordBatch.from_pydict(columns)
        start = end


def _send(numbered: DataFrame, splitters: np.ndarray, low: int, high: int, doc_id: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, ids, texts in whole_pieces(batches, doc_id, text):
            yield from _batches(Sent(Leads(texts), ids, splitters, low, high), piece)

    return numbered.select(PIECE, doc_id, text).mapInArrow(run, _SENT)


def string_ids(rows: np.ndarray, group: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Least id of every string of each row, by the place of the lead: strings are equal within a group of one lead only."""
    found = np.full((len(rows), PLACES), LAST, np.int64)
    around = np.concatenate([rows[:, RIGHT:-2], rows[:, :LENGTH]], axis=1)
    for place in range(PLACES):
        mine = np.flatnonzero((rows[:, -2] <= place) & (place <= rows[:, -1]))
        if not len(mine):
            continue
        strings = np.zeros((len(mine), RIGHT + 8), np.uint8)
        strings[:, :LENGTH] = around[mine, BEFORE - place : BEFORE - place + LENGTH]
        strings[:, RIGHT:] = group[mine].astype(">i8").view(np.uint8).reshape(-1, 8)
        at, _, least = _distinct(strings, ids[mine])
        found[mine, place] = least[at]
    return found


def _bits(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Mask of the places from ``least`` to ``most``."""
    return ((2 << most.astype(np.int64)) - (1 << least.astype(np.int64))).astype(np.uint32)


def count_bucket(table: pa.Table) -> pa.Table:
    """Masks of the suffixes each piece has sent to the bucket: the strings that a smaller id holds."""
    parts = table["suffixes"].to_pylist()
    sizes = np.array([len(p) // (8 * WORDS) for p in parts], np.int64)
    rows = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 8 * WORDS)
    ids = np.repeat(*(pc.list_flatten(table[name]).to_numpy() for name in ("ids", "runs")))
    order, new = multikey_runs(rows.view(">u8").astype(np.uint64))
    starts = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    some, least = order[starts], np.minimum.reduceat(ids[order], starts)
    # Neighbours of one lead.
    lead = np.ascontiguousarray(rows[some, :LEAD]).view("<u4")
    group = np.cumsum(np.r_[True, (lead[1:] != lead[:-1]).any(axis=1)])
    several = np.flatnonzero((np.bincount(group) > 1)[group])
    masks = np.where(ids > least[which], _bits(rows[:, -2], rows[:, -1]), np.uint32(0))
    place = np.arange(PLACES)
    limits = group[several]
    start = 0
    while start < len(several):
        # Whole groups, ``STEP`` suffixes or one group at a time.
        end = int(np.searchsorted(limits, limits[min(start + STEP, len(several)) - 1], side="right"))
        part = several[start:end]
        start = end
        strings = string_ids(rows[some[part]], group[part], least[part])
        at = np.full(len(some), -1, np.int64)
        at[part] = np.arange(len(part))
        mine = np.flatnonzero(at[which] >= 0)
        smaller = strings[at[which[mine]]] < ids[mine][:, None]
        masks[mine] |= (smaller @ (np.uint32(1) << place.astype(np.uint32))).astype(np.uint32)
    first = np.cumsum(sizes) - sizes
    told = np.flatnonzero(np.add.reduceat(masks != 0, first, dtype=np.int64))
    answers = [masks[a : a + n].tobytes() for a, n in zip(first[told].tolist(), sizes[told].tolist(), strict=True)]
    return pa.table({**{n: table[n].take(pa.array(told)) for n in ("piece", "bucket")}, "masks": pa.array(answers, pa.binary())})


def removed_bytes(texts: list[bytes], ids: np.ndarray, masks: list[tuple[int, bytes]], splitters: np.ndarray) -> np.ndarray:
    """Whether each byte of a piece lies in a string that a smaller id holds."""
    leads = Leads(texts)
    # ``chosen`` are all leads here.
    sent = Sent(leads, ids, splitters, 0, len(splitters) + 1)
    told = np.zeros(len(sent.least), np.uint32)
    buckets, sizes = np.array([b for b, _ in masks], np.int64), np.array([len(m) // 4 for _, m in masks], np.int64)
    start, end = (np.searchsorted(sent.bucket, buckets, side=side) for side in ("left", "right"))
    if (end - start != sizes).any():
        raise ValueError("an answer to a bucket is not of the size that was sent")
    told[np.repeat(start - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())] = np.frombuffer(b"".join(m for _, m in masks), "<u4")
    whole = _bits(*leads.ends())
    gone = np.where(ids[leads.owner] > sent.least[sent.place], whole, told[sent.place] & whole)
    # Strings begin and end at different bytes, and so do the strings of different leads. No byte lies in more than 50.
    change = np.zeros(len(leads.data) + 1, np.int8)
    all_gone = np.flatnonzero((gone == whole) & (whole != 0))
    change[leads.first[all_gone]] += 1
    change[(leads.first + leads.count - 1 + LENGTH)[all_gone]] -= 1
    some_gone = np.flatnonzero((gone != whole) & (gone != 0))
    gone, at = gone[some_gone], leads.place[some_gone]
    for place in range(PLACES):
        starts = at[(gone >> np.uint32(place)) & np.uint32(1) != 0] - place
        change[starts] += 1
        change[starts + LENGTH] -= 1
    return np.cumsum(change[:-1], dtype=np.int8) > 0


def _runs(gone: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs, which end with their text, and where each text's runs begin and the last end."""
    ends = np.cumsum(sizes)
    begins, some = ends - sizes, sizes > 0
    before, after = np.r_[False, gone[:-1]][: len(gone)], np.r_[gone[1:], False][: len(gone)]
    before[begins[some]] = False
    after[ends[some] - 1] = False
    starts = np.flatnonzero(gone & ~before)
    return starts, np.flatnonzero(gone & ~after) + 1, np.searchsorted(starts, np.r_[begins, len(gone)])


def sampled_splitters(numbered: DataFrame, buckets: int, text: str) -> np.ndarray:
    """Bounds of ``buckets`` ranges of the leading bytes, from a bounded sample of documents."""
    share = SAMPLED_DOCS / max(numbered.count(), 1)
    wanted = F.pmod(F.xxhash64(text, PIECE), F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in bytes_of(batch.column(0)):
                keys = np.unique(Leads([data]).keys())
                some = keys[np.argsort(_row_hashes(keys[:, None]))[:SAMPLED_LEADS]]
                yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64))], names=["key"])

    rows = numbered.filter(wanted).select(text).mapInArrow(run, "key long").toArrow()
    keys = np.sort(rows["key"].to_numpy().view(np.uint64))
    return np.unique(keys[np.arange(1, buckets) * len(keys) // buckets]) if len(keys) else keys


_RESULT = "n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with the removed runs and the bytes that stay.

    New columns, which replace those of the same name: ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (maximal removed runs, end
    exclusive) and ``kept``. Null and empty texts have no bytes. Texts under 50 bytes lose none. Rows that share a doc_id
    are not earlier than each other; a null doc_id counts as the largest long. Strings are judged on the input. One row
    for each input row. A piece is held by one task: a few megabytes, or one longer text.
    """
    names = tuple(T.StructType.fromDDL(_RESULT).names)
    docs = docs.drop(*[c for c in docs.columns if c in names and c not in (doc_id, text)])
    numbered = numbered_pieces(docs, text, PIECE_BYTES)
    count = numbered.select(PIECE).distinct().count()
    per_round = max(1, round(count * PIECE_BYTES / (PLACES // 2 + 1) / BUCKET_SUFFIXES / ROUNDS))
    splitters = sampled_splitters(numbered, per_round * ROUNDS, text)
    masks = None
    for r in range(ROUNDS):
        sent = _send(numbered, splitters, r * per_round, (r + 1) * per_round, doc_id, text)
        counted = stage(sent.groupBy("bucket").applyInArrow(count_bucket, _MASKS), "masks")
        masks = counted if masks is None else masks.union(counted)
    kept_fields = [f for f in docs.schema.fields if f.name != text]

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        ids, texts = ids_of(rows[doc_id]), bytes_of(rows[text])
        told = list(zip(found["bucket"].to_pylist(), found["masks"].to_pylist(), strict=True))
        gone = removed_bytes(texts, ids, told, splitters)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts, ends, of = _runs(gone, sizes)
        total = np.r_[0, np.cumsum(ends - starts)]
        removed, begins = np.diff(total[of]), np.repeat(np.cumsum(sizes) - sizes, np.diff(of))
        kept = np.frombuffer(b"".join(texts), np.uint8)[~gone]
        spans = pa.StructArray.from_arrays([pa.array(x - begins, pa.int32()) for x in (starts, ends)], names=["start", "end"])
        values = [pa.array(x, pa.int64()) for x in (sizes, removed, np.diff(of))]
        values += [_lists(spans, of), _binary(kept, np.r_[0, np.cumsum(sizes - removed)])]
        columns = [rows[f.name] for f in kept_fields] + values
        return pa.table(columns, names=[*(f.name for f in kept_fields), *names])

    schema = T.StructType([*kept_fields, *T.StructType.fromDDL(_RESULT).fields])
    both = numbered.groupBy(PIECE).cogroup(masks.groupBy("piece"))
    return both.applyInArrow(finish, schema)
