"""Neighbours in tables that repeat rows and ids."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stalewatch.llm import neighbours


def test_repeated_rows_take_no_places(spark):
    rnd = np.random.default_rng(4)
    same, near = rnd.normal(size=8), rnd.normal(size=8)
    rows = [(1, same)] * 8 + [(i, same) for i in range(2, 9)] + [(100, same)] * 3
    rows += [(200, near)] + [(20, near)] * 9 + [(21, near + 1e-4 * i) for i in range(1, 9)] + [(22 + i, near + 0.01 * (i + 1)) for i in range(5)]
    rows += [(300 + i, rnd.normal(size=8)) for i in range(30)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id").isin(100, 200), k=5, parts=2, probes=2).collect()
    expected = {}
    for query, v in ((100, same), (200, near)):
        best = {}
        for i, w in rows:
            if i != query:
                best[i] = max(best.get(i, -2), round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 12))
        expected[query] = sorted(best, key=lambda i: (-best[i], i))[:5]
    assert {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in expected} == expected
    assert expected[100] == [1, 2, 3, 4, 5] and expected[200][:2] == [20, 21]


def test_block_counts_ids():
    frame = pd.DataFrame({"vec_id": [1] * 5 + [2, 3], "v": [[1.0, 0.0]] * 5 + [[1.0, 0.1], [1.0, 0.2]]})
    query = pd.DataFrame({"vec_id": [9], "v": [[1.0, 0.0]]})
    assert neighbours.best_in_block(query, frame, 3)["vec_id"].tolist() == [1, 2, 3]


def test_extreme_vectors(spark):
    """Components whose squares leave the range of doubles, and rows that all lie in one direction."""
    rnd = np.random.default_rng(4)
    vectors = rnd.normal(size=(120, 6))
    scale = np.array([1e200, 1e-170, 1.0, 3e-310, 1e300, 1e100])[np.arange(120) % 6]
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(vectors, scale))]
    rows += [(200 + i, (np.ones(6) * 2.0 ** (i - 15)).tolist()) for i in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, "vec_id % 10 = 0", k=5, parts=2, probes=2).collect()
    unit = np.array([np.array(v) / np.abs(v).max() for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    for at in np.flatnonzero(ids % 10 == 0):
        near = np.round(unit @ unit[at], 9)
        near[at] = -2
        expected = ids[np.lexsort((ids, -near))[:5]].tolist()
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == ids[at])
        if ids[at] < 200:
            assert [v for _, v, _ in got] == expected
        assert all(np.isfinite(s) and abs(s - near[ids == v][0]) < 1e-8 for _, v, s in got) and len(got) == 5


def test_many_close_pairs_in_slices(monkeypatch):
    rows = pd.DataFrame({"vec_id": np.arange(90), "v": [np.ones(3) * (i + 1.0) for i in range(90)]})
    whole = neighbours.best_in_block(rows, rows, 4)
    monkeypatch.setattr(neighbours, "STEP_PAIRS", 100)
    assert neighbours.best_in_block(rows, rows, 4).reset_index(drop=True).equals(whole.reset_index(drop=True))


def test_recall_with_few_probes_on_clustered_vectors(spark):
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(60, 16)) * 4
    vectors = centres[rnd.integers(0, 60, 3000)] + rnd.normal(size=(3000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, "vec_id % 20 = 0", k=5, sample=1500, parts=16, probes=4).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 20):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & {r["vec_id"] for r in found if r["query_id"] == q})
    assert hits / (5 * 150) >= 0.9
