"""Lines against a comparison of each with all earlier ones."""

import random

import pytest

from stalewatch.llm import line_dedup

FUZZY = 8


def one_apart(a, b):
    """Equal but for one character replaced, inserted or left out."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    small, large = sorted((a, b), key=len)
    return len(large) == len(small) + 1 and any(large[:i] + large[i + 1 :] == small for i in range(len(large)))


def plain(rows):
    """(doc_id, text) -> kept text, lines, removed lines."""
    earlier, found = [], {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [] if text is None else text.split("\n")
        kept = []
        for line in lines:
            shown = " ".join(line.split()).lower()
            gone = shown != "" and any(
                shown == e or (min(len(shown), len(e)) >= FUZZY and one_apart(shown, e)) for e in earlier
            )
            if not gone:
                kept.append(line)
            earlier.append(shown)
        found[doc_id, text] = None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)
    return found


def edited(rnd, line):
    at = rnd.randrange(len(line))
    return rnd.choice([line[:at] + line[at + 1 :], line[:at] + "é" + line[at:], line[:at] + "z" + line[at + 1 :], line.upper(), line])


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_all_earlier_ones(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab c") for _ in range(rnd.choice([3, 6, 8, 9, 14, 40]))).strip() + "x" for _ in range(30)]
    pool = base + [edited(rnd, rnd.choice(base)) for _ in range(60)] + ["", "  ", "\t"]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 6)))) for i in range(60)]
    rows += [(None, rnd.choice(pool)), (100, None), (101, ""), (102, "\n\n"), *rows[:5]]
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows], "doc_id long, text string, n_removed string, more int")
    found = line_dedup.dedup_lines(docs, fuzzy_chars=FUZZY)
    assert found.columns == ["doc_id", "text", "more", "n_lines", "n_removed"]
    expected = plain(rows)
    assert sum(n for _, _, n in expected.values()) > 40
    wanted = sorted(repr((r[0], *expected[r])) for r in rows)
    assert sorted(repr((r["doc_id"], r["text"], r["n_lines"], r["n_removed"])) for r in found.collect()) == wanted
