"""Document quality from a linear-chain conditional random field over lines.

Each line is labelled good or bad. A line's features are counts and ratios of its own characters and words,
those of the line before and of the line after. The chain has two labels, so emissions are one weight vector
(bad is the reference with weight zero) and transitions a 2 x 2 matrix. All chains of a piece go through the
forward-backward recursion together, longest first. A document's score is the mean of its lines'
marginals of the label good, weighted by the length of the line.

The model is fitted on a bounded sample of labelled documents: at most ``TRAIN_DOCS``, those of least hash, of at most
``DOC_BYTES`` and ``DOC_LINES`` each, up to ``TRAIN_BYTES`` together. All texts are scored, of any length. The
sample only carries a label for the whole document. All its lines start with it; after a first fit, lines of
bad documents that the model takes for good are set free, and the model is fitted again.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.llm.tables import pieces, with_columns
from stalewatch.staging import stage

#: Bounds of the training sample.
TRAIN_DOCS = 4000
TRAIN_BYTES = 32 << 20
DOC_BYTES = 256 << 10
DOC_LINES = 4000
THRESHOLD = 0.3
ROUNDS = 120
PIECE_BYTES = 2 << 20
#: Bytes whose features are taken at once; a longer line stays whole.
CHUNK_BYTES = 1 << 19
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _BEYOND = range(7)


def _classes() -> np.ndarray:
    table = np.full(256, _MARK, dtype=np.uint8)
    for low, high, kind in ((65, 90, _UPPER), (97, 122, _LOWER), (48, 57, _DIGIT), (128, 255, _BEYOND)):
        table[low : high + 1] = kind
    table[list(b" \t\n\v\f\r")] = _SPACE
    table[list(b".,;:'\"()?-")] = _STOP
    return table


_CLASS = _classes()
_MIX = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x2545F4914F6CDD1D)
N_OWN = 16
N_FEATURES = 3 * N_OWN + 3


def _ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _own_features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of whole lines by themselves, and their lengths in bytes; every line ends in a line break."""
    ends = np.flatnonzero(data == 10)
    starts = np.r_[0, ends[:-1] + 1]
    size = ends - starts
    kind = _CLASS[data]
    counts = np.empty((7, len(ends)))
    for k in range(7):
        total = np.r_[0, np.cumsum(kind == k)]
        counts[k] = total[ends] - total[starts]
    solid = kind != _SPACE
    first = np.flatnonzero(solid & np.r_[True, ~solid[:-1]])
    last = np.flatnonzero(solid & np.r_[~solid[1:], True]) + 1
    where = np.searchsorted(ends, first)
    words = np.bincount(where, minlength=len(ends)).astype(float)
    length = last - first
    short = np.bincount(where, weights=length <= 3, minlength=len(ends))
    repeated, distinct = np.zeros(len(ends)), np.zeros(len(ends))
    marked = np.zeros(len(ends))
    if len(first):
        place = np.arange(len(data)) - np.repeat(np.r_[0, first], np.diff(np.r_[0, first, len(data)]))
        mixed = np.where(solid, _MIX[data] * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)), np.uint64(0))
        word = np.add.reduceat(mixed, first)
        same = np.r_[False, (word[1:] == word[:-1]) & (where[1:] == where[:-1])]
        repeated = np.bincount(where, weights=same, minlength=len(ends))
        marked = np.bincount(where, weights=kind[last - 1] == _MARK, minlength=len(ends))
        both = np.sort(word ^ (where.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        # Distinct words of a line: words whose mixed value occurs first.
        order = np.argsort(word ^ (where.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), kind="stable")
        new = np.r_[True, both[1:] != both[:-1]]
        distinct = np.bincount(where[order[new]], minlength=len(ends))
    letters = counts[_UPPER] + counts[_LOWER] + counts[_BEYOND]
    own = np.stack(
        [
            np.log1p(size),
            np.log1p(words),
            _ratio(size, words) / 10,
            _ratio(counts[_UPPER], letters),
            _ratio(counts[_DIGIT], size),
            _ratio(counts[_MARK], size),
            _ratio(counts[_STOP], size),
            _ratio(counts[_BEYOND], size),
            _ratio(counts[_SPACE], size),
            _ratio(repeated, words),
            _ratio(distinct, words),
            _ratio(short, words),
            _ratio(marked, words),
            np.minimum(_ratio(counts[_MARK], size) * 10, 1),
            (size == 0).astype(float),
            np.minimum(_ratio(repeated, words) * 4, 1),
        ],
        axis=1,
    ).astype(np.float32)
    return own, size


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and the number of lines of each text (one at least)."""
    lines = np.array([t.count(b"\n") + 1 for t in texts], dtype=np.int64)
    whole = b"\n".join(texts) + b"\n"
    parts, start = [], 0
    while start < len(whole):
        end = whole.find(b"\n", min(start + CHUNK_BYTES, len(whole) - 1)) + 1
        parts.append(_own_features(np.frombuffer(whole, np.uint8, end - start, start)))
        start = end
    own, size = (np.concatenate(p) for p in zip(*parts, strict=True))
    begin = np.zeros(len(size), dtype=bool)
    begin[np.r_[0, np.cumsum(lines)[:-1]]] = True
    end = np.r_[begin[1:], True]
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[begin], after[end] = 0, 0
    flags = np.stack([begin, end, np.ones(len(size))], axis=1).astype(np.float32)
    return np.concatenate([own, before, after, flags], axis=1), size, lines


@dataclass
class Chain:
    """Weights of the emissions and transitions, with the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    emission: np.ndarray
    transition: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.emission


class Chains:
    """Chains laid out by step: at step ``t`` stand the lines ``t`` of all chains longer than ``t``."""

    def __init__(self, lines: np.ndarray) -> None:
        order = np.argsort(-lines, kind="stable")
        starts = (np.cumsum(lines) - lines)[order]
        sizes = lines[order]
        active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
        self.steps = [starts[:n] + t for t, n in enumerate(active.tolist())]

    def marginals(self, good: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and expected transition counts."""
        move = np.exp(transition - transition.max())
        emit = np.stack([np.ones_like(good), np.exp(np.clip(good, -30, 30))], axis=1)
        forward, backward = np.empty_like(emit), np.ones_like(emit)
        for t, at in enumerate(self.steps):
            now = emit[at] if t == 0 else (forward[self.steps[t - 1][: len(at)]] @ move) * emit[at]
            forward[at] = now / now.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(len(self.steps) - 1, 0, -1):
            at, previous = self.steps[t], self.steps[t - 1][: len(self.steps[t])]
            beyond = emit[at] * backward[at]
            joint = forward[previous][:, :, None] * move * beyond[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            now = beyond @ move.T
            backward[previous] = now / now.sum(axis=1, keepdims=True)
        product = forward * backward
        return product[:, 1] / product.sum(axis=1), expected


def fit(features: np.ndarray, lines: np.ndarray, label: np.ndarray, size: np.ndarray, rounds: int = ROUNDS) -> Chain:
    """Maximum likelihood with a ridge, by gradient steps with a rate for each weight."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    mean[-1], scale[-1] = 0, 1
    x = (features - mean) / scale
    chains = Chains(lines)
    document = np.repeat(np.arange(len(lines)), lines)
    truth = label[document].astype(float)
    chain = Chain(mean, scale, np.zeros(x.shape[1]), np.zeros((2, 2)))
    for again in range(2):
        if again:
            good, _ = chains.marginals(chain.scores(features), chain.transition)
            truth = np.where((label[document] == 0) & (good > 0.5) & (size > 0), 1.0, truth)
        inside = np.concatenate([np.stack([s[: len(n)], n]) for s, n in zip(chains.steps, chains.steps[1:])] or [np.empty((2, 0), int)], axis=1)
        observed = np.zeros((2, 2))
        np.add.at(observed, (truth[inside[0]].astype(int), truth[inside[1]].astype(int)), 1)
        weights = np.r_[chain.emission, chain.transition.ravel()]
        rate, last = np.full(len(weights), 0.05), np.zeros(len(weights))
        for _ in range(rounds):
            emission, transition = weights[:-4], weights[-4:].reshape(2, 2)
            good, expected = chains.marginals(x @ emission, transition)
            slope = np.r_[x.T @ (truth - good), (observed - expected).ravel()] - 1.0 * weights
            agree = np.sign(slope) * np.sign(last)
            rate = np.clip(np.where(agree > 0, rate * 1.2, np.where(agree < 0, rate * 0.5, rate)), 1e-6, 0.5)
            last = np.where(agree < 0, 0, slope)
            weights = weights + rate * np.sign(last)
        chain = Chain(mean, scale, weights[:-4], weights[-4:].reshape(2, 2))
    return chain


def score_texts(chain: Chain, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Score of each text, and the marginals and lengths of its lines."""
    features, size, lines = line_features([(t or "").encode() for t in texts])
    good, _ = Chains(lines).marginals(chain.scores(features), chain.transition)
    starts = np.cumsum(lines) - lines
    weight = np.maximum(size, 1e-6)
    score = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
    return np.clip(score, 0, 1), np.split(good, starts[1:]), np.split(size, starts[1:])


def training_rows(docs: DataFrame, labels: DataFrame, held_out: str | None, limit: int = TRAIN_DOCS) -> DataFrame:
    """``text`` and ``label`` of at most ``limit`` labelled documents, those whose doc_id has the least hash.

    ``held_out`` is an SQL condition on doc_id of documents never to learn from. Labels other than 0 and 1,
    and documents with contradicting labels, are left out, as are documents of more than ``DOC_BYTES`` or ``DOC_LINES``,
    and what comes after ``TRAIN_BYTES`` of text. The chosen labels are few and bounded, so the documents are only scanned.
    """
    usable = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
    if held_out:
        usable = usable.filter(f"NOT ({held_out})")
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    chosen = agreed.filter("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    chosen = stage(chosen.select(F.col("doc_id").alias("labelled"), "label"), "labelled")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    size, breaks = F.octet_length("text"), F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    found = found.filter(F.col("text").isNull() | ((size <= DOC_BYTES) & (breaks < DOC_LINES)))
    # A doc_id that several rows share counts once, or the bound would not hold.
    once = found.groupBy("labelled").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    upto = F.sum(F.coalesce(size, F.lit(0))).over(Window.orderBy(F.xxhash64("labelled"), "labelled"))  # at most limit rows
    return once.withColumn("__upto", upto).filter(F.col("__upto") <= TRAIN_BYTES).drop("__upto")


def learn(rows: DataFrame, rounds: int = ROUNDS) -> Chain:
    """The chain fitted in one task on the bounded rows of :func:`training_rows`; only its weights come back.

    Without a row of each label, the chain has zero weights and every score is one half.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        label = frame["label"].to_numpy()
        features, size, lines = line_features([(t or "").encode() for t in frame["text"]])
        chain = fit(features, lines, label, size, rounds)
        return pd.DataFrame(
            {
                "mean": [chain.mean.tolist()],
                "scale": [chain.scale.tolist()],
                "emission": [chain.emission.tolist()],
                "transition": [chain.transition.ravel().tolist()],
            }
        )

    schema = "mean array<double>, scale array<double>, emission array<double>, transition array<double>"
    kept = stage(rows.select("text", "label"), "training")
    if kept.select("label").distinct().count() < 2:
        return Chain(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), np.zeros((2, 2)))
    ordered = kept.orderBy(F.xxhash64("text"), "label").coalesce(1)
    row = ordered.groupBy(F.lit(1).alias("all")).applyInPandas(lambda frame: run(frame), schema).first()
    return Chain(*(np.array(row[n]) for n in ("mean", "scale", "emission")), np.array(row["transition"]).reshape(2, 2))


def score(docs: DataFrame, chain: Chain, text: str = "text", out: str = "score", lines: str | None = None) -> DataFrame:
    """Adds the quality of every whole text and, if named, the marginals of its lines.

    Null and empty texts are one empty line and get its marginal. Columns with the new names are replaced.
    Work is per row, without a shuffle; the weights are a fixed number of doubles.
    """
    model = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PIECE_BYTES):
            found, good, _ = score_texts(model.value, batch.column(batch.schema.get_field_index(text)).to_pylist())
            extra = {lines: pa.array([g.tolist() for g in good], pa.list_(pa.float64()))} if lines else {}
            yield with_columns(batch, drop=(out, lines), **{out: pa.array(found, pa.float64())}, **extra)

    kept = [f for f in docs.schema.fields if f.name not in (out, lines)]
    added = [T.StructField(out, T.DoubleType())]
    added += [T.StructField(lines, T.ArrayType(T.DoubleType()))] if lines else []
    return docs.mapInArrow(run, T.StructType([*kept, *added]))
