"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is built and cut into equal parts with few cut edges. A
small softmax classifier learns, for every sample vector, in which parts its neighbours lie. It then puts
every vector of the table into its most probable part, and sends a query to the several most probable parts,
where all vectors are compared with it exactly.

Parts are searched in blocks of bounded size: rows of a part are dealt over as many blocks as its row count
needs, queries over blocks likewise, and every block of rows meets every block of queries of its part. Equal
vectors are reduced beforehand to the ``k + 1`` smallest ids, which are all that an answer can hold.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stalewatch.staging import stage

#: Bound of the sample the partition is learnt from, in vectors.
SAMPLE = 4096
PARTS = 64
PROBES = 44
NEIGHBOURS = 10
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


#: Pairs of a query and a row that are measured exactly at once.
STEP_PAIRS = 1 << 18


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each line times a power of two that brings its largest component to about one.

    That changes no digit, and so no cosine, and keeps squares of very large or small components within doubles.
    """
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def neighbour_graph(unit: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Nearest other rows of each row."""
    near = unit @ unit.T
    np.fill_diagonal(near, -np.inf)
    count = min(neighbours, len(unit) - 1)
    return np.argpartition(-near, count - 1, axis=1)[:, :count] if count > 0 else np.empty((len(unit), 0), int)


def _halves(adjacency: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Mask of one of two equal halves with few edges between them.

    The start is the median of the slowest mode of the graph's random walk; pairs of vertices that
    both gain by it are then exchanged.
    """
    size = len(adjacency)
    degree = np.maximum(adjacency.sum(axis=1), 1e-9)
    value = unit @ np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)[2][0]
    for _ in range(60):
        value = value - (value * degree).sum() / degree.sum()
        value = 0.5 * value + 0.5 * (adjacency @ value) / degree
        value /= np.linalg.norm(value) + 1e-12
    half = np.zeros(size, dtype=bool)
    half[np.argsort(value, kind="stable")[: size // 2]] = True
    for _ in range(20):
        inside = adjacency @ half
        gain = np.where(half, adjacency.sum(axis=1) - 2 * inside, 2 * inside - adjacency.sum(axis=1))
        left, right = np.flatnonzero(half), np.flatnonzero(~half)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right), max(1, size // 50))
        good = gain[left[:pairs]] + gain[right[:pairs]] > 0
        if not good.any():
            break
        half[left[:pairs][good]], half[right[:pairs][good]] = False, True
    return half


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row; ``parts`` is a power of two, sizes differ by one row at most for each halving."""
    adjacency = np.zeros((len(unit), len(unit)), dtype=np.float32)
    np.put_along_axis(adjacency, graph, 1, axis=1)
    adjacency = np.maximum(adjacency, adjacency.T)
    label = np.zeros(len(unit), dtype=np.int64)
    for _ in range(parts.bit_length() - 1):
        halved = label * 2
        for part in np.unique(label).tolist():
            rows = np.flatnonzero(label == part)
            if len(rows) > 1:
                halved[rows[_halves(adjacency[np.ix_(rows, rows)], unit[rows])]] += 1
        label = halved
    return label


def train_router(unit: np.ndarray, graph: np.ndarray, label: np.ndarray, parts: int, rounds: int = 300) -> np.ndarray:
    """Softmax weights (dimensions + 1, parts) for the parts a row and its neighbours lie in."""
    target = np.zeros((len(unit), parts))
    rows = np.arange(len(unit))
    target[rows, label] = 1
    for column in graph.T:
        np.add.at(target, (rows, label[column]), 1 / graph.shape[1])
    target /= target.sum(axis=1, keepdims=True)
    x = np.c_[unit, np.ones(len(unit))]
    weights, speed, power = np.zeros((x.shape[1], parts)), 0.0, 0.0
    for step in range(1, rounds + 1):
        logits = x @ weights
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        slope = x.T @ (chance - target) / len(x) + 1e-5 * weights
        speed, power = 0.9 * speed + 0.1 * slope, 0.99 * power + 0.01 * slope**2
        weights = weights - 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
    return weights


def learn_router(sample: np.ndarray, parts: int = PARTS) -> np.ndarray:
    unit = _unit(sample)
    parts = min(parts, 1 << max(len(unit).bit_length() - 1, 0))
    graph = neighbour_graph(unit)
    return train_router(unit, graph, balanced_parts(unit, graph, parts), parts)


def sound(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows with an id and a finite vector that is not zero."""
    v = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    return rows.filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(finite & F.exists("v", lambda x: x != 0))


def _probes(rows: DataFrame, router: np.ndarray, count: int, out: str) -> DataFrame:
    """Adds the ``count`` most probable parts of each row, most probable first."""
    weights = rows.sparkSession.sparkContext.broadcast(router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                logits = np.c_[_unit(flat), np.ones(len(flat))] @ weights.value
                best = np.argsort(-logits, axis=1, kind="stable")[:, :count].astype(np.int32)
                parts = pa.ListArray.from_arrays(np.arange(0, best.size + 1, best.shape[1], dtype=np.int32), best.ravel())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), parts], names=["vec_id", "v", out])

    schema = T.StructType([*rows.select("vec_id", "v").schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return rows.select("vec_id", "v").mapInArrow(run, schema)


def cosine(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each pair of lines, summed in the same order wherever a pair stands."""
    product = (queries * rows).sum(axis=1)
    return product / (np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((rows * rows).sum(axis=1)))


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest ids of each query by their best rows: the larger cosine, then the smaller id; its own id is none."""
    empty = pd.DataFrame({"query_id": np.empty(0, int), "vec_id": np.empty(0, int), "score": np.empty(0)})
    if not len(queries) or not len(rows):
        return empty
    q, r = (_scaled(np.stack(side["v"].to_numpy())) for side in (queries, rows))
    q_ids, r_ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
    near = _unit(q) @ _unit(r).T
    near[q_ids[:, None] == r_ids[None, :]] = -np.inf
    # The bound counts ids: of the rows of one id the best stands for all.
    by_id = np.argsort(r_ids, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(r_ids[by_id]) != 0])
    of_ids = near if len(starts) == len(r_ids) else np.maximum.reduceat(near[:, by_id], starts, axis=1)
    count = min(k, len(starts))
    floor = np.partition(of_ids, len(starts) - count, axis=1)[:, len(starts) - count]
    # A margin for rounding; what is left is measured exactly.
    close = (near >= floor[:, None] - 1e-9) & np.isfinite(near)
    # Where all rows lie in one direction, all pairs are close: some queries at a time.
    slices = np.cumsum(close.sum(axis=1)) // STEP_PAIRS
    best = []
    for part in np.split(np.arange(len(q)), np.flatnonzero(np.diff(slices)) + 1):
        which, what = np.nonzero(close[part])
        found = pd.DataFrame({"query_id": q_ids[part][which], "vec_id": r_ids[what], "score": cosine(q[part][which], r[what])})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        best.append(found.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k))
    return pd.concat(best)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``part`` and its number of blocks; one row for each part."""
    return rows.groupBy("part").agg(F.greatest(F.ceil(F.count(F.lit(1)) / size), F.lit(1)).cast("int").alias("blocks"))


def _dealt(rows: DataFrame, mine: DataFrame, other: DataFrame, own: str, their: str) -> DataFrame:
    """Each row in one block of its own, once for every block of the other side."""
    sized = rows.join(F.broadcast(mine), "part").withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
    against = F.broadcast(other.withColumnRenamed("blocks", "others"))
    copies = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    return sized.join(against, "part").select("part", own, copies.alias(their), "vec_id", "v")


def nearest(
    vectors: DataFrame,
    queries: str | Column,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample: int = SAMPLE,
    parts: int = PARTS,
    probes: int = PROBES,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that meets the condition ``queries``.

    Gives query_id, rank, vec_id, score: the larger cosine first, ties by the smaller vec_id. A row with the
    query's own vec_id is no candidate. Vectors that are null, empty, zero or not finite take no part, nor do null
    ids and vectors of another length than the most frequent one. Of several query rows with one vec_id the one with the least
    vector counts, and of several candidates with one vec_id the best. Fewer candidates give fewer rows, an
    empty table none.
    """
    rows = sound(vectors, vec_id, embedding)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of_length = F.size("v") == lengths[0]
    order = Window.partitionBy("v").orderBy("vec_id")
    # The least k + 1 ids of equal vectors; Spark keeps that many per task before the shuffle.
    kept = rows.filter(of_length).distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    kept = stage(kept.drop("place"), "vectors")
    asked = sound(vectors.filter(queries), vec_id, embedding).filter(of_length).groupBy("vec_id").agg(F.min("v").alias("v"))
    # Rows under a hash threshold, twice as many as are wanted, so that what is sorted does not grow with the table.
    place = F.xxhash64("v", "vec_id")
    share = 2 * sample / max(kept.count(), 1)
    some = kept if share >= 1 else kept.filter(F.pmod(place, F.lit(1 << 40)) < int(share * (1 << 40)))
    chosen = some.orderBy(place, "vec_id").limit(sample).select("v").collect()
    router = learn_router(np.array([r[0] for r in chosen]), parts)
    count = min(probes, router.shape[1])
    index = stage(_probes(kept, router, 1, "at").select("vec_id", "v", F.col("at")[0].alias("part")), "index")
    routed = stage(_probes(asked, router, count, "at").select("vec_id", "v", F.explode("at").alias("part")), "routed")
    row_blocks, query_blocks = _blocks(index, BLOCK_ROWS), _blocks(routed, BLOCK_QUERIES)
    left = _dealt(routed, query_blocks, row_blocks, "q", "r").groupBy("part", "q", "r")
    right = _dealt(index, row_blocks, query_blocks, "r", "q").groupBy("part", "q", "r")
    schema = "query_id long, vec_id long, score double"
    found = left.cogroup(right).applyInPandas(lambda a, b: best_in_block(a, b, k), schema)
    # A vec_id comes from several rows only if the table repeats it.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = best.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

