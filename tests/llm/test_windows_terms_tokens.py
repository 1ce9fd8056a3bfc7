"""Substring dedup, source audit and tokenizer alignment against plain versions."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stalewatch.llm import alignment, divergence, substrings
from stalewatch.llm.piecewise import LAST
from stalewatch.llm.queries import BYTE_TOKENIZER, TOKENIZER

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()


def prose(seed, words):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(words))


def plain_repeats(rows, window):
    """(n_words, n_removed, kept) of each row, every window compared as a tuple of words."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ids = [LAST if i is None else i for i, _ in rows]
    first = {}
    for i, words in zip(ids, split):
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in zip(ids, split):
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        runs = [m.span() for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        out.append((len(words), sum(gone), runs, " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def substring_rows():
    base = prose(1, 80)
    rows = [(i, prose(i, 60)) for i in range(2, 12)]
    rows += [(20, base), (21, base), (22, base.replace(" ", "\t\n", 9)), (23, prose(5, 30) + " " + base[100:400] + " " + prose(7, 20))]
    rows += [(20, base), (19, "a b c"), (24, "x y z"), (30, ""), (31, None), (32, " \n\t"), (None, base), (None, None)]
    rows += [(40, " ".join(["same"] * 50)), (41, " ".join(["same"] * 13)), (42, " ".join(["same"] * 12)), (43, "é b 中 😀 " * 9), (44, "é b 中 😀 " * 9)]
    return rows


@pytest.mark.parametrize("window,piece,rounds", [(13, 4 << 20, 2), (13, 900, 3), (3, 300, 2)])
def test_repeated_windows(spark, monkeypatch, window, piece, rounds):
    monkeypatch.setattr(substrings, "PIECE_BYTES", piece)
    monkeypatch.setattr(substrings, "ROUNDS", rounds)
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 50)
    rows = substring_rows()
    docs = spark.createDataFrame([(i, t, "x", k, 1.5) for k, (i, t) in enumerate(rows)], "doc_id long, text string, kept string, row int, n_words double")
    found = substrings.remove_repeats(docs.repartition(3), window).collect()
    assert sorted(found[0].asDict()) == ["doc_id", "kept", "n_removed", "n_words", "row", "spans"]
    got = {r["row"]: (r["doc_id"], r["n_words"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept"]) for r in found}
    assert got == {k: (i, *e) for k, ((i, _), e) in enumerate(zip(rows, plain_repeats(rows, window)))}


def test_rolling_hash_is_the_polynomial():
    rnd = random.Random(2)
    words = [rnd.getrandbits(64) for _ in range(40)]
    found = substrings.rolling(np.array(words, np.uint64), 5, substrings.BASES[0]).tolist()
    power = [pow(substrings.BASES[0], 4 - k, 1 << 64) for k in range(5)]
    assert found == [sum(w * b for w, b in zip(words[i : i + 5], power)) % (1 << 64) for i in range(36)]


def test_windows_with_one_hash_and_different_checks():
    ids = np.array([5, 4, 3, 9])
    hashes, checks = np.array([7, 7, 7, 1], np.uint64), np.array([1, 2, 1, 0], np.uint32)
    place, _, _, least = substrings.different(ids, hashes, checks)
    assert least[place].tolist() == [3, 4, 3, 9]


def test_long_text_in_chunks(monkeypatch):
    text = (prose(3, 400) + "\n\n  ").encode() * 3
    whole = substrings.word_digests(text)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 37)
    assert substrings.word_digests(text) == whole and len(whole) == 16 * 1200


def plain_audit(docs):
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    holds, uses = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in pattern.findall(text or "")]
        holds[lang or ""].update(set(words))
        uses[lang or "", source or ""].update(words)
    out = []
    for lang, held in holds.items():
        kept = [t for t in held if held[t] >= 3]
        groups = [g for g in uses if g[0] == lang]

        def chances(count):
            whole = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // whole for t in kept}

        p = {g: chances(uses[g]) for g in groups}
        q = chances(sum((uses[g] for g in groups), Counter()))
        for g in groups:
            pairs = sorted((-sum((p[g][t] - p[h][t]) ** 2 // p[h][t] for t in kept), h[1].encode()) for h in groups if h != g)
            terms = sorted((-((p[g][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if uses[g][t] and p[g][t] > q[t])[:200]
            for part, rows in (("pair", pairs), ("term", terms)):
                out += [(lang, g[1], part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(rows)]
    return sorted(out)


def audit_rows():
    rnd = random.Random(8)
    many = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(120):
        lang, source = rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "ü", "ab", None, "z"])
        words = rnd.choices(many if source != "z" else many[:40], k=rnd.randint(0, 80))
        rows.append((lang, source, rnd.choice([" ", ", ", "_", "1"]).join(w.title() if rnd.random() < 0.3 else w for w in words)))
    rows += [("en", "silent", None), ("en", "silent", ""), ("en", "marks", "123 !!"), ("xx", "one", "lone word"), ("xx", "two", None)]
    rows += [("en", "a", "É é ÀB 中文 naïve")] * 3 + [("yy", "only", "same same")] * 3
    return rows


@pytest.mark.parametrize("block,entries,step", [(200_000, 100_000, 1 << 20), (40, 30, 7)])
def test_sources_against_dense_sums(spark, monkeypatch, block, entries, step):
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(divergence, "STEP", step)
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "lang string, source string, text string, value int, term string")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == plain_audit(rows)


def token_ends(ids, table):
    return np.cumsum([len(table[i]) for i in ids]).tolist()


def plain_alignment(texts):
    encoders = alignment.byte_vocabulary(BYTE_TOKENIZER), alignment.piece_vocabulary(TOKENIZER)
    strict = alignment._strict_encoder(BYTE_TOKENIZER)
    docs, counts = [], Counter()
    for text in texts:
        groups, links = [], []
        if text:
            ids = [strict(" " + text), encoders[1][0](text).tolist()]
            if all(b"".join(table[i] for i in x) == (" " + text).encode() for x, (_, table) in zip(ids, encoders)):
                ends = [token_ends(x, table) for x, (_, table) in zip(ids, encoders)]
                start = 0
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    groups.append([[i for i, e in zip(x, y) if start < e <= cut] for x, y in zip(ids, ends)])
                    start = cut
                links = [(a, b) for a, x in zip(*[ids[0], ends[0]]) for b, y in zip(ids[1], ends[1]) if x == y]
        docs.append((groups, links))
        counts.update(links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for groups, links in docs:
        form = ";".join("|".join(",".join(map(str, half)) for half in g) for g in groups)
        n_best = sum(counts[x] == most[x[1]] for x in links)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links), n_best, sum(counts[x] for x in links), form))
    return out


def token_texts():
    rnd = random.Random(4)
    bits = ["the ", "Quick", " brown", "<|endoftext|>", "</s>", "<unk>", "▁", "\n\n", "   ", "é", "中文字", "😀", "123456", "don't", "\t", "\x00", "x" * 30, " <0x41> "]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(60)] + [None, "", " ", "a", "▁a b", "same text", "same text"]


@pytest.mark.parametrize("piece", [4 << 20, 400])
def test_alignment_against_ends(spark, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE_BYTES", piece)
    texts = token_texts()
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in enumerate(texts)], "row int, text string, groups string, n_a int")
    found = alignment.align(docs.repartition(3), BYTE_TOKENIZER, TOKENIZER).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert {r["row"]: tuple(r[n] for n in names) for r in found} == dict(enumerate(plain_alignment(texts)))


def test_linked_tokens_are_suffixes_of_each_other():
    """The bound of the table of pairs."""
    tables = alignment.byte_vocabulary(BYTE_TOKENIZER)[1], alignment.piece_vocabulary(TOKENIZER)[1]
    assert sum(map(len, tables[0])) + sum(map(len, tables[1])) < 1_000_000
    for text in token_texts():
        a, b = alignment.encode_both(text, BYTE_TOKENIZER, TOKENIZER)
        ends = [dict(zip(token_ends(x, t), x)) for x, t in zip((a, b), tables)]
        for end in set(ends[0]) & set(ends[1]):
            x, y = tables[0][ends[0][end]], tables[1][ends[1][end]]
            assert x.endswith(y) or y.endswith(x)


def test_long_text_in_parts(monkeypatch):
    texts = [prose(6, 300) + " don't stop.  Now  " + prose(7, 200), "x" * 500, "a b " * 100, None, "é" * 90 + " word word"]
    whole = [alignment.encode_both(t, BYTE_TOKENIZER, TOKENIZER) for t in texts]
    monkeypatch.setattr(alignment, "STEP_CHARS", 50)
    for text, before in zip(texts, whole):
        after = alignment.encode_both(text, BYTE_TOKENIZER, TOKENIZER)
        assert [x.tolist() for x in before] == [x.tolist() for x in after]


def test_both_libraries_of_the_byte_vocabulary_agree():
    strict, encode = alignment._strict_encoder(BYTE_TOKENIZER), alignment.byte_vocabulary(BYTE_TOKENIZER)[0]
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(letters), 5000):
        text = " ".join(f"a{c}b 1{c}2 {c} .{c}{c}" for c in letters[at : at + 5000])
        assert encode(text).tolist() == strict(text)
    for text in (" " * 200_000, "\n" * 9000 + "x", "x" * 100_000, "?!" * 20_000):
        assert encode(text).tolist() == strict(text)


def test_pointers_reach_the_end_of_a_long_chain():
    a = np.array([*range(2, 4002, 2), 4001])
    b = np.array([*range(1, 4001, 2), 4001])
    labels = alignment.group_labels(a, b)
    assert [set(x.tolist()) for x in labels] == [{0}, {0}]
    assert alignment.group_labels(np.array([1, 2, 5]), np.array([2, 3, 5]))[1].tolist() == [0, 1, 1]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert substrings.remove_repeats(empty).count() == 0
    assert divergence.audit(empty).count() == 0
    assert alignment.align(empty, BYTE_TOKENIZER, TOKENIZER).count() == 0
