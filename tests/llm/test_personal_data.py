"""The scores of patterns and instances against a plain graph."""

import math
import random
import uuid
from collections import defaultdict

import pytest

from stalewatch import staging
from stalewatch.llm import personal_data


def plain_scores(found, rounds):
    members, seeds = defaultdict(set), defaultdict(float)
    for shape, instance, seed, patterns in found:
        seeds[shape, instance] = max(seeds[shape, instance], float(seed))
        for pattern in patterns:
            members[pattern, shape].add((shape, instance))
    now = dict(seeds)
    for _ in range(rounds):
        reached = defaultdict(lambda: 1.0)
        for of_one in members.values():
            support = math.fsum(now[m] for m in of_one)
            if support >= personal_data.SUPPORT and support / len(of_one) >= personal_data.CONFIDENCE:
                for m in of_one:
                    reached[m] *= 1 - min(support / len(of_one), 0.999999)
        now = {m: max(seed, 1 - reached[m]) for m, seed in seeds.items()}
    return now


def mentions():
    """Rings that are reached one round after another, and mentions at random of which some repeat."""
    found = []
    for ring in range(5):
        own = [f"ring {ring}"]
        found += [("phone", f"s{ring}-{i}", True, own) for i in range(10)]
        found += [("phone", f"x{ring}", False, [*own, f"ring {ring + 1}"])]
    rnd = random.Random(5)
    for _ in range(900):
        shape, number = rnd.choice(["ip", "card"]), rnd.randrange(150)
        found.append((shape, f"v{number}", number % 20 > 0 and rnd.random() < 0.95, [f"p{rnd.randrange(25)}" for _ in range(rnd.randrange(3))]))
    return found


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_scores_against_a_plain_graph(spark, rounds):
    found = mentions()
    frame = spark.createDataFrame(found, "shape string, instance string, seed boolean, patterns array<string>")
    scored = personal_data.scores(frame, rounds).collect()
    plain = plain_scores(found, rounds)
    assert len(scored) == len(plain)
    for r in scored:
        assert r["score"] == pytest.approx(plain[r["shape"], r["instance"]], abs=1e-9)
    # Every round reaches one ring more.
    sure = {r["instance"] for r in scored if r["score"] >= personal_data.CONFIDENCE}
    assert [f"x{ring}" in sure for ring in range(5)] == [ring < rounds for ring in range(5)]
    # The scores of others than seeds count as well.
    if rounds:
        assert any(0 < r["score"] < 1 for r in scored if r["shape"] != "phone")


def test_files_written_do_not_grow_with_the_shuffle_partitions(spark, tmp_path, monkeypatch):
    """Two narrow tables are staged, one file for each task that reads; the rounds write none."""
    texts = [(i, f"call line {i % 40} at +1 555 {i:03d} {i * 7:04d} or mail user{i}@example{i % 9}.com for case {i}") for i in range(200)]
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    monkeypatch.setattr(staging, "scratch_path", lambda _, label: str(tmp_path / f"{label}-{uuid.uuid4().hex}"))
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
        assert personal_data.find_personal_data(docs).count() == len(texts)
        assert len(list(tmp_path.rglob("part-*.parquet"))) == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
