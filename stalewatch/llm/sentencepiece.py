"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

A text becomes words (a run of spaces with what follows it up to the next space). No piece of the
vocabulary has a space after another character, so no merge crosses a word and equal words are encoded
once. All new words of a batch lie in one flat symbol array. In each round the rank of every adjacent
pair is looked up, the least rank of each word is found by a segmented minimum, its occurrences are
merged from the left, and the array is compacted; words without a pair leave. The library merges one
pair at a time. Merging all of a word at once gives the same unless a merge makes a neighbouring pair of
equal or lower rank; such words (runs of three spaces, above all) go through the one-by-one agenda.
"""

import codecs
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stalewatch.llm.tables import pieces, with_columns

SPACE = "▁"
NO_PAIR = np.int64(1) << 40
SLOT_BITS = 19
PIECE_BYTES = 1 << 20
#: Words and characters kept from one batch to the next, and characters that are merged at once.
CACHED_WORDS = 60_000
CACHED_CHARS = 1 << 20
GROUP_CHARS = 1 << 17
_BAD_BYTE = "stalewatch-one-per-byte"
codecs.register_error(_BAD_BYTE, lambda e: ("�", e.start + 1))


@dataclass
class Pieces:
    """A BPE vocabulary as arrays; its size is that of the model file, whatever the corpus."""

    texts: list[str]
    single: dict[str, int]
    table: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_ids: np.ndarray
    symbols: int
    byte_ids: list[int]
    surface: list[bytes]
    end_id: int
    strip_first_space: bool
    store: "WordStore | None" = None


def load_pieces(model_file: str) -> Pieces:
    """Reads a BPE model with identity normalisation and byte fallback; others raise ``ValueError``."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    if model.normalize("ﬁ Ａ") != f"{SPACE}ﬁ{SPACE}Ａ" or not model.is_byte(model.piece_to_id("<0x00>")):
        raise ValueError("a model without normalisation rules, with a dummy prefix and byte fallback is needed")
    texts = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
    normal = {texts[i]: i for i in range(size) if not special[i] and not model.is_unused(i)}
    scores = np.array([model.get_score(i) for i in range(size)])
    rank = np.searchsorted(np.unique(-scores), -scores)
    if any(SPACE in text.lstrip(SPACE) for text in normal):
        raise ValueError("pieces must not have a space after another character")
    single = {text: i for text, i in normal.items() if len(text) == 1}
    # Characters that occur in pieces but are none themselves still take part in merges.
    for char in sorted({c for text in normal for c in text} - single.keys()):
        single[char] = size + len(single)
    known = single | {t: i for t, i in normal.items() if len(t) > 1}
    symbols = max(known.values()) + 2
    pairs = {}
    for text, i in normal.items():
        for cut in range(1, len(text)):
            left, right = known.get(text[:cut]), known.get(text[cut:])
            if left is not None and right is not None:
                pairs[left * symbols + right] = i
    keys = np.array(sorted(pairs), dtype=np.int64)
    ids = np.array([pairs[k] for k in keys.tolist()], dtype=np.int64)
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    surface = [b"" if special[i] else texts[i].replace(SPACE, " ").encode() for i in range(size)]
    surface[model.unk_id()] = " ⁇ ".encode()
    for byte, i in enumerate(byte_ids):
        surface[i] = bytes([byte])
    # Position -1, the last, stands for no pair.
    ranks, made = np.r_[rank[ids].astype(np.int64), NO_PAIR], np.r_[ids, -1]
    return Pieces(texts, single, _hashed(keys), np.r_[keys, -1], ranks, made, symbols, byte_ids, surface, model.eos_id(), True)


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _hashed(keys: np.ndarray) -> np.ndarray:
    """Open addressing over ``SLOT_BITS`` bits: the slot holds the key's position, or -1."""
    table = np.full((1 << SLOT_BITS) + 64, -1, dtype=np.int64)
    for at, slot in enumerate(_slots(keys).tolist()):
        while table[slot] >= 0:
            slot += 1
        table[slot] = at
    return table


def _lookup(p: Pieces, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and piece of each pair; ``NO_PAIR`` and -1 where the vocabulary has none."""
    wanted = left * p.symbols + right
    slot = _slots(wanted)
    at = p.table[slot]
    open_ = np.flatnonzero((at >= 0) & (p.pair_keys[at] != wanted))
    while len(open_):
        slot[open_] += 1
        at[open_] = p.table[slot[open_]]
        open_ = open_[(at[open_] >= 0) & (p.pair_keys[at[open_]] != wanted[open_])]
    return p.pair_ranks[at], p.pair_ids[at]


def _agenda(p: Pieces, symbols: list[int]) -> list[int]:
    """One word by single merges: the best rank first, the leftmost of equal ones."""
    after = [*range(1, len(symbols)), -1]
    before = [*range(-1, len(symbols) - 1)]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(spots: list[tuple[int, int]]) -> None:
        spots = [(a, b) for a, b in spots if a >= 0 and b >= 0]
        if spots:
            pair = np.array([(symbols[a], symbols[b]) for a, b in spots], dtype=np.int64)
            ranks, made = _lookup(p, pair[:, 0], pair[:, 1])
            for (a, b), (x, y), r, m in zip(spots, pair.tolist(), ranks.tolist(), made.tolist(), strict=True):
                if m >= 0:
                    heapq.heappush(heap, (r, a, x, y, m))

    offer([(i, i + 1) for i in range(len(symbols) - 1)])
    while heap:
        _, a, x, y, made = heapq.heappop(heap)
        b = after[a]
        if symbols[a] != x or b < 0 or symbols[b] != y:
            continue
        symbols[a], symbols[b] = made, -1
        after[a] = after[b]
        if after[b] >= 0:
            before[after[b]] = a
        offer([(before[a], a), (a, after[a])])
    return [s for s in symbols if s >= 0]


def _first_of_runs(chosen: np.ndarray) -> np.ndarray:
    """Every other one of adjacent chosen pairs, starting with the leftmost."""
    spots = np.flatnonzero(chosen)
    new_run = np.ones(len(spots), dtype=bool)
    new_run[1:] = np.diff(spots) > 1
    start = np.maximum.accumulate(np.where(new_run, np.arange(len(spots)), 0))
    return spots[(np.arange(len(spots)) - start) % 2 == 0]


def merge_words(p: Pieces, words: list[str]) -> list[np.ndarray]:
    """Piece ids of each non-empty word by merge rounds."""
    chars = "".join(words)
    unknown = p.symbols - 1
    codes = np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32)
    distinct, where = np.unique(codes, return_inverse=True)
    symbol = np.array([p.single.get(chr(c), unknown) for c in distinct.tolist()], dtype=np.int64)[where]
    origin = codes.astype(np.int64)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alone: dict[int, list[int]] = {}
    rank, made = _pairs(p, symbol, word)
    while len(symbol):
        best = np.full(len(words), NO_PAIR)
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best[word[starts]] = np.minimum.reduceat(rank, starts)
        still = best[word] < NO_PAIR
        if not still.all():
            done.append((word[~still], symbol[~still], origin[~still]))
            symbol, origin, word, rank, made = (x[still] for x in (symbol, origin, word, rank, made))
            if not len(symbol):
                break
        spots = _first_of_runs((rank < NO_PAIR) & (rank == best[word]))
        # What the merge would put beside its neighbours, before and after their own merges.
        merged = symbol.copy()
        merged[spots] = made[spots]
        gone = np.zeros(len(symbol), dtype=bool)
        gone[spots + 1] = True
        level = best[word[spots]]
        risky = np.zeros(len(spots), dtype=bool)
        right = np.minimum(spots + 2, len(symbol) - 1)
        has_right = (spots + 2 < len(symbol)) & (word[right] == word[spots])
        for after in (symbol[right], merged[right]):
            risky |= has_right & (_lookup(p, merged[spots], after)[0] <= level)
        left = np.maximum(spots - 1, 0)
        has_left = (spots > 0) & (word[left] == word[spots])
        left_symbol = np.where(gone[left], merged[np.maximum(left - 1, 0)], merged[left])
        risky |= has_left & (_lookup(p, left_symbol, merged[spots])[0] <= level)
        stay = ~gone
        if risky.any():
            one_by_one = np.unique(word[spots[risky]])
            for w in one_by_one.tolist():
                lo, hi = np.searchsorted(word, (w, w + 1))
                alone[w] = _agenda_ids(p, symbol[lo:hi].tolist(), origin[lo:hi].tolist())
            stay &= ~np.isin(word, one_by_one)
        fresh = np.zeros(len(symbol), dtype=bool)
        fresh[spots] = True
        symbol, origin, word, rank, made, fresh = (x[stay] for x in (merged, origin, word, rank, made, fresh))
        # Only pairs with a merged symbol have a new rank.
        fresh[:-1] |= fresh[1:].copy()
        at = np.flatnonzero(fresh)
        rank[at], made[at] = _pairs(p, symbol, word, at)
    result: list[np.ndarray] = [np.empty(0, dtype=np.int32)] * len(words)
    for w, ids in alone.items():
        result[w] = np.array(ids, dtype=np.int32)
    for part_word, part_symbol, part_origin in done:
        edges = np.flatnonzero(np.r_[True, part_word[1:] != part_word[:-1]])
        stray = part_symbol >= len(p.texts)
        stray_word = np.zeros(len(words), dtype=bool)
        stray_word[part_word[stray]] = True
        small = part_symbol.astype(np.int32)
        for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(part_word)], strict=True):
            w = part_word[lo]
            ids = small[lo:hi]
            result[w] = np.array(_bytes_for(p, ids.tolist(), part_origin[lo:hi].tolist()), np.int32) if stray_word[w] else ids
    return result


def _pairs(p: Pieces, symbol: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rank and piece of the pairs that start at ``at`` (everywhere by default); none across words."""
    if at is None:
        at = np.arange(len(symbol))
    after = np.minimum(at + 1, max(len(symbol) - 1, 0))
    rank, made = _lookup(p, symbol[at], symbol[after])
    rank[(after == at) | (word[after] != word[at])] = NO_PAIR
    return rank, made


def _bytes_for(p: Pieces, symbols: list[int], origins: list[int]) -> list[int]:
    """Symbols that are no pieces become the bytes of their character."""
    ids: list[int] = []
    for symbol, code in zip(symbols, origins, strict=True):
        if symbol < len(p.texts):
            ids.append(symbol)
        else:
            ids += [p.byte_ids[b] for b in chr(code).encode()]
    return ids


def _agenda_ids(p: Pieces, symbols: list[int], origins: list[int]) -> list[int]:
    stray = [c for s, c in zip(symbols, origins, strict=True) if s >= len(p.texts)]
    merged = _agenda(p, symbols)
    if not stray:
        return merged
    # A stray symbol that took part in a merge is gone from the result; the rest keep their order only if none did.
    left = [s for s in merged if s >= len(p.texts)]
    if len(left) != len(stray):
        raise ValueError("a character outside the vocabulary took part in a merge")
    codes = iter(stray)
    return _bytes_for(p, merged, [next(codes) if s >= len(p.texts) else 0 for s in merged])


def split_words(text: str) -> list[str]:
    """Words of the escaped text with its dummy prefix: a run of spaces and what follows it."""
    text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if "" not in parts:
        return parts
    words, spaces = [], ""
    for part in parts:
        if part:
            words.append(spaces + part)
            spaces = ""
        else:
            spaces += SPACE
    if spaces:
        words.append(spaces[1:])  # the last separator has nothing after it
    return words


def _groups(words: list[str]) -> Iterator[list[str]]:
    """The words in groups of about ``GROUP_CHARS``; a longer word stays alone."""
    group, held = [], 0
    for word in words:
        if group and held + len(word) > GROUP_CHARS:
            yield group
            group, held = [], 0
        group.append(word)
        held += len(word)
    if group:
        yield group


class WordStore:
    """Ids of the words met so far, flat."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.sizes = self.starts = np.empty(0, dtype=np.int64)
        self.flat = np.empty(0, dtype=np.int32)

    def full(self) -> bool:
        return len(self.place) > CACHED_WORDS or self.chars > CACHED_CHARS

    def add(self, p: Pieces, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if not new:
            return
        flats, counts = [self.flat], []
        for group in _groups(new):
            # split_words leaves out the space before every word.
            found = merge_words(p, [SPACE + w for w in group])
            counts.append(np.array([len(f) for f in found], dtype=np.int64))
            flats.append(np.concatenate(found))
        sizes = np.concatenate(counts)
        self.place.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
        self.chars += sum(map(len, new))
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.flat = np.concatenate(flats)


def encode_texts(p: Pieces, texts: list[str | None], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts and the offsets of each; null counts as empty."""
    split = [split_words(t) if t else [] for t in texts]
    words = [w for part in split for w in part]
    distinct = set(words)
    store = WordStore() if p.store is None or p.store.full() else p.store
    store.add(p, distinct)
    p.store = None if store.full() else store
    place = np.fromiter(map(store.place.__getitem__, words), dtype=np.int64, count=len(words))
    sizes = store.sizes[place]
    ends = np.cumsum(sizes)
    flat = store.flat[np.repeat(store.starts[place] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
    edges = np.r_[0, ends][np.r_[0, np.cumsum([len(s) for s in split], dtype=np.int64)]]
    if end:
        flat = np.insert(flat, edges[1:], p.end_id)
        edges = edges + np.arange(len(edges))
    return flat.astype(np.int32), edges


def decode_flat(p: Pieces, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of consecutive id lists ``ids[offsets[i]:offsets[i + 1]]``."""
    lengths = np.array([len(s) for s in p.surface], dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    store = np.frombuffer(b"".join(p.surface), dtype=np.uint8)
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    source = np.repeat(starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    data = store[source].tobytes()
    edges = np.r_[0, ends][offsets].tolist()
    control = (lengths[ids] == 0).nonzero()[0]
    # An id without text also ends a run of bytes; only its place between other ids matters.
    inner = set(np.searchsorted(offsets, control[~np.isin(control, offsets[1:] - 1)], "right").tolist())
    texts = []
    for row, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True), 1):
        part = data[lo:hi]
        mine = ids[offsets[row - 1] : offsets[row]]
        first = mine[lengths[mine] > 0][:1] if row in inner else mine[:1]
        skip = int(p.strip_first_space and len(first) > 0 and p.texts[first[0]].startswith(SPACE))
        if row in inner:
            cuts = np.r_[0, np.cumsum(lengths[mine])][np.r_[0, (lengths[mine] == 0).nonzero()[0], len(mine)]]
            runs = [part[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            texts.append("".join(r.decode("utf-8", _BAD_BYTE) for r in runs)[skip:])
        else:
            texts.append(part[skip:].decode("utf-8", _BAD_BYTE))
    return texts


def _decoded(p: Pieces, column: pa.ListArray) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    texts = decode_flat(p, column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)].astype(np.int64))
    return pa.array([t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist(), strict=True)], pa.string())


def encode(
    docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids", end: bool = True, decoded: str | None = None
) -> DataFrame:
    """Adds the ids of every whole text as an array and, if named, the text those ids decode to.

    Null and empty texts have the end id only (no id with ``end=False``). A column that already has one of
    the new names is replaced; all others stay. The vocabulary travels with the task and is bounded by
    the model file. Work is per row, without a shuffle.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_pieces(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = vocabulary.value
        for batch in pieces(batches, text, PIECE_BYTES):
            flat, offsets = encode_texts(p, batch.column(batch.schema.get_field_index(text)).to_pylist(), end)
            found = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            extra = {decoded: _decoded(p, found)} if decoded else {}
            yield with_columns(batch, drop=(ids, decoded), **{ids: found}, **extra)

    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    added += [T.StructField(decoded, T.StringType())] if decoded else []
    return docs.mapInArrow(run, T.StructType([*kept, *added]))


def decode(docs: DataFrame, model_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of every id array; null arrays give null, empty ones an empty text."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_pieces(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = vocabulary.value
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                column = batch.column(batch.schema.get_field_index(ids))
                yield with_columns(batch, drop=(out,), **{out: _decoded(p, column)})

    kept = [f for f in docs.schema.fields if f.name != out]
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(out, T.StringType())]))
