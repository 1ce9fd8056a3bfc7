"""Texts of very long tokens, in a time that grows with their length; base findings against Python's patterns."""

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from stalewatch.llm import personal_data, secret_scan
from stalewatch.llm.queries import QUERIES
from stalewatch.llm.spans import listed
from stalewatch.llm.tables import table

SIZE = 1_000_000
FOLDER = "/root/testdata/sf0.01"


def long_texts(size):
    shapes = ["seg/", "seg-1_", "a1", "=", "/", "-_", "1@", "@", ".", "x@y.", "1.", "1 ", "+1(", "4111 ", "AKIA", "é", "token=", "0f"]
    return [(i, (shape * (size // len(shape) + 1))[:size] + end) for i, (shape, end) in enumerate((s, e) for s in shapes for e in ("", "x"))]


@pytest.mark.parametrize("find, spans, by_start", [
    (secret_scan.find_secrets, secret_scan.all_spans, True), (personal_data.find_personal_data, personal_data.all_spans, False)
])
def test_long_tokens_end_in_linear_time(spark, find, spans, by_start):
    took = []
    for size in (SIZE // 10, SIZE):
        docs = spark.createDataFrame(long_texts(size), "doc_id long, text string").repartition(8)
        began = time.time()
        assert find(docs).select("doc_id", F.length(listed(spans(), by_start)).alias("n")).count() == 36
        took.append(time.time() - began)
    assert took[1] < 40 * took[0] + 60


def plain_secrets(text):
    found = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for order, (kind, pattern) in enumerate((("assign", assign), ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+"))):
        for m in re.finditer(pattern, text):
            if len(m[2]) >= 8 if kind == "assign" else len(m[0]) >= (16 if kind == "access" else 32):
                found.append((m.start(), order, kind, m.end()))
    return sorted(found)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_personal(text):
    found = []
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((order, m.start(), kind, m.end()))
    return sorted(found)


@pytest.mark.parametrize("name, plain, place, kinds", [
    ("op9_secrets", plain_secrets, 0, ("assign", "access", "hex")), ("op10_personal_data", plain_personal, 1, ("email", "ip", "card", "phone"))
])
def test_base_findings_over_the_whole_table(spark, name, plain, place, kinds):
    rows = {r["doc_id"]: r for r in QUERIES[name](spark, FOLDER).collect()}
    docs = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        found = plain(text or "")
        digest = hashlib.sha256(",".join(f"{f[2]}:{f[place]}:{f[3]}" for f in found).encode()).hexdigest()
        assert rows[doc_id]["base_sha256"] == digest
        assert [rows[doc_id][f"n_{k}"] for k in kinds] == [sum(f[2] == k for f in found) for k in kinds]
        assert {f"{f[2]}:{f[place]}:{f[3]}" for f in found} <= set(rows[doc_id]["spans"].split(","))


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh12 a@b.c", 7, "x", "y")], "doc_id long, text string, hex int, tokens string, context string")
    row = secret_scan.find_secrets(docs).first()
    assert [s["value"] for s in row["assign"]] == ["abcdefgh12"] and row["hex"] == [] and row["context"] == "y"
    row = personal_data.find_personal_data(docs).first()
    assert [s["value"] for s in row["email"]] == ["a@b.c"] and row["context"] == [] and row["tokens"] == "x" and row["hex"] == 7
