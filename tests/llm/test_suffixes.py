"""Leads, order and batches of the suffix operator against plain versions."""

import random

import numpy as np
import pytest

from stalewatch.llm import suffixes
from stalewatch.llm.piecewise import bounds


def _texts(seed, n=60, longest=400):
    rnd = random.Random(seed)
    base = bytes(rnd.choice(b"abc d") for _ in range(600))
    texts = [base[(a := rnd.randrange(500)) : a + rnd.randrange(longest)] for _ in range(n)]
    return [b"", *texts, b"", b"x" * 49, b"y" * 50, b"z" * 300, bytes(80), b""]


def _chosen(leads):
    """Place of the lead of every string, by the string's first byte."""
    strings = np.repeat(leads.first - np.cumsum(leads.count) + leads.count, leads.count) + np.arange(leads.count.sum())
    return dict(zip(strings.tolist(), np.repeat(leads.place, leads.count).tolist()))


@pytest.mark.parametrize("block", [1, 7, 31, 1 << 14])
def test_leads_are_those_of_every_string_alone(monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK", block)
    texts = _texts(3)
    leads = suffixes.Leads(texts)
    expected, at = {}, 0
    for text in texts:
        for i in range(len(text) - suffixes.LENGTH + 1):
            alone = suffixes.Leads([text[i : i + suffixes.LENGTH]])
            expected[at + i] = at + i + int(alone.place[0])
        at += len(text)
    assert _chosen(leads) == expected
    assert (leads.owner == np.searchsorted(np.cumsum(leads.sizes), leads.place, side="right")).all()


def test_leads_do_not_depend_on_the_size_of_the_piece(monkeypatch):
    """Hashes that differ in low bits only: as many of them have to count in a short text as in a long one."""

    def few_bits(data):
        return (data[: len(data) - suffixes.LEAD + 1].astype(np.uint64) * np.uint64(7919) % np.uint64(16)) << np.uint64(7)

    monkeypatch.setattr(suffixes, "_lead_hashes", few_bits)
    text, rest = random.Random(2).randbytes(100), bytes(5000)
    short, long = _chosen(suffixes.Leads([text])), _chosen(suffixes.Leads([text, rest]))
    assert short == {i: place for i, place in long.items() if i < len(text)}


def test_suffix_rows_hold_the_bytes_of_their_strings():
    texts = _texts(4)
    leads = suffixes.Leads(texts)
    some = np.arange(len(leads.place))[::3]
    rows = leads.suffixes(some)
    for row, k in zip(rows, some.tolist()):
        place, first, count = (int(x[k]) for x in (leads.place, leads.first, leads.count))
        around = np.zeros(suffixes.BEFORE + suffixes.LENGTH, np.uint8)
        a, b = first, first + count - 1 + suffixes.LENGTH
        around[suffixes.BEFORE - (place - a) : suffixes.BEFORE + b - place] = leads.data[a:b]
        before, after = around[: suffixes.BEFORE].tobytes(), around[suffixes.BEFORE :].tobytes()
        padding = bytes(suffixes.RIGHT - suffixes.LENGTH)
        assert row.tobytes() == after + padding + before + bytes([place - first - count + 1, place - first])


@pytest.mark.parametrize("size", [1, 5000, 64 << 20])
def test_batches_hold_every_suffix_sent(monkeypatch, size):
    monkeypatch.setattr(suffixes, "BATCH_BYTES", size)
    texts = _texts(5)
    leads = suffixes.Leads(texts)
    ids = np.random.default_rng(1).integers(0, 20, len(texts))
    splitters = np.unique(leads.keys())[::25]
    for low, high in ((0, 1), (1, 4), (4, len(splitters) + 1), (len(splitters) + 1, len(splitters) + 9)):
        sent = suffixes.Sent(leads, ids, splitters, low, high)
        found = [row for batch in suffixes._batches(sent, 7) for row in batch.to_pylist()]
        limits = bounds(sent.bucket).tolist()
        expected = [(int(sent.bucket[a]), 7, sent.least[a:b].tolist(), sent.rows[a:b].tobytes()) for a, b in zip(limits, limits[1:])]
        assert [(r["bucket"], r["piece"], np.repeat(r["ids"], r["runs"]).tolist(), r["suffixes"]) for r in found] == expected
        assert all(low <= r["bucket"] < high for r in found)


@pytest.mark.parametrize("shift", [0, 58])
def test_stable_order(shift):
    keys = np.random.default_rng(6).integers(0, 20, 3000) << shift
    assert suffixes.stable_order(keys).tolist() == np.argsort(keys, kind="stable").tolist()
    assert suffixes.stable_order(keys[:0]).tolist() == []


def test_different_rows_of_one_hash(monkeypatch):
    monkeypatch.setattr(suffixes, "_row_hashes", lambda words: words[:, 0] % np.uint64(2))
    rows = np.random.default_rng(7).integers(0, 3, (400, 2)).astype(np.uint64).view(np.uint8)
    ids = np.arange(400)[::-1]
    place, some, least = suffixes._distinct(rows, ids)
    assert (rows[some][place] == rows).all() and len(some) == len({r.tobytes() for r in rows}) == len(least)
    assert least.tolist() == [min(i for i, r in zip(ids.tolist(), rows) if (r == rows[s]).all()) for s in some]


def test_answers_of_another_size_are_refused():
    texts = _texts(8)
    ids = np.arange(len(texts))
    with pytest.raises(ValueError):
        suffixes.removed_bytes(texts, ids, [(0, bytes(4))], np.zeros(0, np.uint64))
