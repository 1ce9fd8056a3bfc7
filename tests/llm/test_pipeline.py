"""The pipeline against a plain version of its stages, over the whole tables of the smallest scale."""

import re
from collections import defaultdict

import corpus_pipeline
import numpy as np
import sentencepiece as library
import xxhash

from stalewatch.llm import decontamination, line_dedup, quality
from stalewatch.llm.queries import HELD_OUT, TOKENIZER
from stalewatch.llm.tables import table

FOLDER = "/root/testdata/sf0.001"


def _normal(line):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", line).strip(" ").lower()


def _one_edit(a, b):
    """Whether two different lines are one edited character apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    same = next((i for i, (x, y) in enumerate(zip(short, long_)) if x != y), len(short))
    return len(long_) == len(short) + 1 and short[same:] == long_[same + 1 :]


def _without_repeated_lines(docs):
    seen, by_size, kept = set(), defaultdict(list), []
    for doc_id, text in docs:
        stays, gone = [], 0
        for line in text.split("\n"):
            plain = _normal(line)
            near = [o for n in (-1, 0, 1) for o in by_size[len(plain) + n]] if len(plain) >= line_dedup.FUZZY_CHARS else []
            if plain and (plain in seen or any(_one_edit(plain, o) for o in near)):
                gone += 1
            else:
                stays.append(line)
            if plain and plain not in seen:
                seen.add(plain)
                if len(plain) >= line_dedup.FUZZY_CHARS:
                    by_size[len(plain)].append(plain)
        text = "\n".join(stays) if gone else text
        if not gone or text.strip():
            kept.append((doc_id, text))
    return kept


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _first_of_near_duplicates(docs):
    prints = [_fingerprint(t) for _, t in docs]
    part = list(range(len(docs)))
    changed = True
    while changed:
        changed = False
        for a in range(len(docs)):
            for b in range(a):
                if part[a] != part[b] and bin(prints[a] ^ prints[b]).count("1") <= 4:
                    part[a] = part[b] = min(part[a], part[b])
                    changed = True
    return [d for i, d in enumerate(docs) if part[i] == i]


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _leaks(text, items):
    words = _words(text)
    for item in items:
        size = min(len(item), decontamination.WINDOW)
        windows = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if item else set()
        if any(tuple(words[i : i + size]) in windows for i in range(len(words) - size + 1)):
            return True
    return False


def test_pipeline_equals_plain_stages(spark):
    documents = table(spark, FOLDER, "documents")
    rows = {r["doc_id"]: r for r in documents.collect()}
    assert len(rows) == documents.count()
    chain = quality.learn(quality.training_rows(documents, table(spark, FOLDER, "labels"), HELD_OUT))
    docs = []
    for doc_id in sorted(rows):
        _, good, size = quality.score_texts(chain, [rows[doc_id]["text"]])
        if np.average(good[0], weights=np.maximum(size[0], 1e-6)) >= quality.THRESHOLD:
            docs.append((doc_id, rows[doc_id]["text"] or ""))
    docs = _without_repeated_lines(docs)
    docs = _first_of_near_duplicates(docs)
    items = [_words(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    docs = [d for d in docs if not _leaks(d[1], items)]
    tokenizer = library.SentencePieceProcessor(model_file=TOKENIZER)
    expected = {}
    for doc_id, text in docs:
        ids = tokenizer.encode(text) + [tokenizer.eos_id()]
        expected[doc_id] = (rows[doc_id]["lang"], rows[doc_id]["source"], len(ids), ids, tokenizer.decode(ids))
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(found) == len(expected) < len(rows)
    assert {r["doc_id"]: tuple(r)[1:] for r in found} == expected
