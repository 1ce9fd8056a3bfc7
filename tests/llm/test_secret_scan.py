"""The models against plain counts; ordinary tokens with numbers stay ordinary, however large the corpus is."""

import base64
import datetime
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from test_long_tokens import plain_secrets

from stalewatch.llm import secret_scan
from stalewatch.llm.tables import table

ORDINARY = (
    "user_session_id_20240115", "http/2024/10/03/article", "checkout-service-v12-3456", "model/encoder/layer_12/attention",
    "backup_2023-11-05_daily", "release-notes-2024-03",
)
SECRETS = ("k3Jd9vQz1LmX8sWb2TnR7yPc", hashlib.sha1(b"y").hexdigest().upper(), "Zx81kQpL0vTt5uYw7RnB3eHs")
NAMES = "user session account service request handler layer encoder model notes value current print total daily backup article".split()


@pytest.mark.parametrize("size", [300, 6000])
def test_ordinary_tokens_with_numbers(spark, size):
    rnd = random.Random(1)
    rows = [(i, "see " + "_".join(rnd.choice(NAMES) for _ in range(4)) + " and " + "-".join(rnd.choice(NAMES) for _ in range(3))) for i in range(size)]
    rows += [(size + i, f"here {t} stands") for i, t in enumerate(ORDINARY + SECRETS)]
    found = secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    flagged = {s["value"] for r in found.select("random").collect() for s in r["random"]}
    assert flagged == set(SECRETS)


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
PART = "([A-Za-z]+[0-9]{0,4}|[0-9]{1,8})"
PLAIN = re.compile(f"[A-Za-z_-]+|[/_=-]*{PART}([/_=-]+{PART})*[/_=-]*")


def numbered(token):
    code = zlib.crc32(token.encode())
    date = datetime.date(1970, 1, 1) + datetime.timedelta(days=7000 + code % 16000)
    return [
        f"{token}_{date:%Y%m%d}", f"{token}_{date:%Y-%m-%d}", f"{token}/{date:%Y/%m/%d}/{token}", f"{token}-v{code % 40}-{code % 9973}",
    ][code // 7 % 4]


def chances(samples):
    """Chance of every second symbol after every first one, from a dictionary of counted pairs."""
    pairs = Counter(a + b for s in samples for a, b in zip(s, s[1:]) if a in LETTERS and b in LETTERS)
    first, second = Counter(), Counter(LETTERS)
    for pair, n in pairs.items():
        first[pair[0]] += n
        second[pair[1]] += n
    share = {b: n / sum(second.values()) for b, n in second.items()}
    weight, even = secret_scan.BACK_OFF, secret_scan.EVEN
    return {
        a + b: (1 - even) * (pairs[a + b] + weight * share[b]) / (first[a] + weight) + even / len(LETTERS)
        for a in LETTERS for b in LETTERS
    }


def plain_random(texts):
    """Random spans of every text, by samples, counts and ratios written out."""
    likely, ordinary = set(), set()
    found = [[(a, z, kind) for a, _, kind, z in plain_secrets(t)] for t in texts]
    for text, spans in zip(texts, found, strict=True):
        digest = hashlib.sha256(text.encode()).digest()
        likely |= {digest.hex(), digest.hex().upper(), base64.b64encode(digest).decode()}
        for a, z, kind in spans:
            likely.add(assigned(text[a:z]) if kind == "assign" else text[a:z])
        tokens = re.findall("[A-Za-z0-9+/_=-]+", text)
        ordinary |= {t for t in tokens if len(t) >= 12 and PLAIN.fullmatch(t)}
    ordinary |= {numbered(t) for t in ordinary}
    over, under = chances(likely), chances(ordinary)
    result = []
    for text, spans in zip(texts, found, strict=True):
        mine = []
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
            t = m[0]
            if re.search("[0-9]", t) and re.search("[A-Za-z]", t) and all(m.end() <= a or z <= m.start() for a, z, _ in spans):
                ratio = sum(math.log(over[x + y] / under[x + y]) for x, y in zip(t, t[1:])) / (len(t) - 1)
                if ratio > secret_scan.MARGIN:
                    mine.append((m.start(), m.end()))
        result.append(mine)
    return result


def assigned(value):
    return re.fullmatch(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", value)[1]


def test_random_spans_against_plain_counts(spark):
    docs = [t or "" for _, t in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    rnd = random.Random(3)
    kinds = [
        lambda: hashlib.sha1(rnd.randbytes(8)).hexdigest().upper(), lambda: base64.b64encode(rnd.randbytes(24)).decode(),
        lambda: "/".join(rnd.choice(NAMES) for _ in range(5)) + "/2024", lambda: "password = " + rnd.choice(NAMES) + ".x1",
        lambda: "_".join(rnd.choice(NAMES) for _ in range(4)) + str(rnd.randrange(10**9)), lambda: "token:" + rnd.randbytes(12).hex(),
    ]
    texts = docs + [f"é {rnd.choice(kinds)()} and {rnd.choice(kinds)()}." for _ in range(300)] + ["", "x" * 40, "x1" * 40]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["random"]] for r in secret_scan.find_secrets(rows).select("doc_id", "random").collect()}
    plain = plain_random(texts)
    assert sum(map(len, plain)) > 100
    assert [found[i] for i in range(len(texts))] == plain
