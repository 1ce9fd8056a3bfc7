"""Secrets: three fixed patterns, and random strings told from identifiers by character Markov models.

Two first-order models give the probability of a character after another one, in random strings and in ordinary
identifiers. A token of the text is a secret if its mean log-likelihood ratio per character is over a margin.

Both models are counted over all documents from labelled samples. Random: the values the fixed patterns find,
and digests of every document's text in the usual spellings (lower and upper hexadecimal, base 64).
Ordinary: tokens of words and short numbers with separators between them (identifiers, paths, dates), and each of
them once more with a date or number in a usual spelling, so that digits have their share whatever the corpus holds. The
models are two tables of ``SYMBOLS`` squared, whatever the corpus, and enter the scan as constant arrays.
"""

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stalewatch.llm.spans import labelled, let, matches, outside
from stalewatch.staging import stage

# The patterns of the base findings.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
#: A token worth scoring, and what an ordinary identifier looks like.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Every repetition is possessive: no part has a second way to match, and a long token takes no stack.
_PART = r"(?:[A-Za-z]++[0-9]{0,4}+|[0-9]{1,8}+)"
IDENTIFIER = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9/_=-]{12})"
    rf"(?:[A-Za-z_-]++|[/_=-]*+{_PART}(?:[/_=-]++{_PART})*+[/_=-]*+)(?![A-Za-z0-9+/_=-])"
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
SYMBOLS = len(ALPHABET)
MARGIN = 0.5
#: Weight of a symbol's own frequency, in observed pairs.
BACK_OFF = 5
#: Share of every chance that is the same for all symbols, so that no chance falls with the size of the corpus.
EVEN = 0.05


@dataclass
class Models:
    """Log-likelihood ratio of each pair of symbols, row by row."""

    ratio: list[float]


def base_findings(text: Column) -> tuple[Column, Column, Column]:
    """Spans of the three kinds; value is the secret itself."""
    assign = F.filter(matches(text, ASSIGN, group=2), lambda s: F.char_length(s["value"]) >= 8)
    access = F.when(F.contains(text, F.lit("AKIA")), matches(text, ACCESS)).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>")
    )
    return assign, access, matches(text, HEX)


def candidates(text: Column) -> Column:
    """Tokens with a letter and a digit that are long enough to judge."""
    return F.filter(matches(text, TOKEN), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))


def scanned(docs: DataFrame, text: str) -> DataFrame:
    """The findings and tokens of each row, narrow, read from the text once; written to the shared folder."""
    content = F.coalesce(F.col(text), F.lit(""))
    assign, access, hexes = base_findings(content)
    kept = docs.drop("assign", "access", "hex", "tokens", "plain", "digest")
    rows = kept.withColumns(
        {
            "assign": assign,
            "access": access,
            "hex": hexes,
            "tokens": candidates(content),
            "plain": F.regexp_extract_all(content, F.lit(IDENTIFIER), F.lit(0)),
            "digest": F.sha2(content, 256),
        }
    )
    return stage(rows.drop(text), "secrets")


def _pairs(samples: DataFrame) -> DataFrame:
    """Counts of neighbouring symbols of each label."""
    # Split once: finding a character by its number takes a pass over those before it.
    letters = F.split("sample", "")
    beside = let(letters, lambda c: F.zip_with(c, F.slice(c, 2, F.greatest(F.size(c), F.lit(1))), lambda a, b: F.concat(a, b)))
    neighbours = samples.select("label", F.explode(beside).alias("pair")).filter(F.col("pair").isNotNull())
    return neighbours.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).filter(F.char_length("pair") == 2)


def _smoothed(table: list[list[int]]) -> list[list[float]]:
    """Chances of the next symbol; a pair not seen has the chance of the symbol by itself, and ``EVEN`` of an even one."""
    single = [sum(column) + 1 for column in zip(*table, strict=True)]
    total = sum(single)
    seen = [[(n + BACK_OFF * s / total) / (sum(row) + BACK_OFF) for n, s in zip(row, single, strict=True)] for row in table]
    return [[(1 - EVEN) * chance + EVEN / SYMBOLS for chance in row] for row in seen]


def _numbered(sample: Column) -> Column:
    """An ordinary token with a date or number, in one of four usual spellings; which one follows from the token."""
    code = F.crc32(sample.cast("binary"))
    date = F.date_from_unix_date((F.lit(7000) + code % 16000).cast("int"))
    number = F.concat(F.lit("-v"), (code % 40).cast("string"), F.lit("-"), (code % 9973).cast("string"))
    dated = [
        F.concat(sample, F.lit("_"), F.date_format(date, "yyyyMMdd")),
        F.concat(sample, F.lit("_"), F.date_format(date, "yyyy-MM-dd")),
        F.concat(sample, F.lit("/"), F.date_format(date, "yyyy/MM/dd"), F.lit("/"), sample),
    ]
    return F.get(F.array(*dated, F.concat(sample, number)), F.floor(code / 7).cast("int") % 4)


def learn(rows: DataFrame) -> Models:
    """Both models from the rows of :func:`scanned`; an empty table gives models without a preference."""
    values = F.flatten(F.transform(F.array("assign", "access", "hex"), lambda a: F.transform(a, lambda s: s["value"])))
    real = rows.select(F.explode(values).alias("sample"))
    digest = F.col("digest")
    spelled = F.array(digest, F.upper(digest), F.base64(F.unhex(digest)))
    made = rows.select(F.explode(spelled).alias("sample"))
    plain = rows.select(F.explode("plain").alias("sample")).distinct()
    plain = plain.select(F.explode(F.array("sample", _numbered(F.col("sample")))).alias("sample"))
    # Copies of one document would let one sample outweigh the rest, so a sample counts once.
    samples = (
        real.union(made).select(F.lit("random").alias("label"), "sample").union(plain.select(F.lit("plain"), "sample"))
    ).distinct()
    place = {c: i for i, c in enumerate(ALPHABET)}
    tables = {label: [[0] * SYMBOLS for _ in range(SYMBOLS)] for label in ("random", "plain")}
    for label, pair, n in _pairs(samples).collect():  # at most SYMBOLS squared for each label
        if pair[0] in place and pair[1] in place:
            tables[label][place[pair[0]]][place[pair[1]]] += n
    chance = {label: _smoothed(table) for label, table in tables.items()}
    both = zip(chance["random"], chance["plain"], strict=True)
    ratio = [log(a) - log(b) for rows_ in both for a, b in zip(*rows_, strict=True)]
    return Models(ratio)


def likelihood_ratio(value: Column, models: Models) -> Column:
    """Mean log-likelihood ratio of a token's neighbouring characters, which must be of ``ALPHABET``."""
    table = F.array(*[F.lit(r) for r in models.ratio])
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    ratios = let(
        places, lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda a, b: F.get(table, a * SYMBOLS + b))
    )
    total = F.aggregate(ratios, F.lit(0.0), lambda sum_, r: sum_ + F.coalesce(r, F.lit(0.0)))
    return total / (F.char_length(value) - 1)


def find_secrets(docs: DataFrame, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Replaces the text by ``assign``, ``access``, ``hex`` and ``random``: arrays of (start, end, value).

    Null and empty texts have empty arrays. The first three are the fixed patterns; ``random`` holds the
    tokens that the models take for random and that overlap none of them. Columns that have one of those
    names are replaced, all others stay. The text is read once; what follows works on the findings. Time grows with the length
    of a text and of its tokens, however long they are.
    """
    rows = scanned(docs, text)
    models = learn(rows)
    base = F.flatten(F.array("assign", "access", "hex"))
    free = outside(F.col("tokens"), base)
    random = F.filter(free, lambda s: likelihood_ratio(s["value"], models) > margin)
    return rows.withColumn("random", random).drop("tokens", "plain", "digest")


def all_spans(with_random: bool = True) -> Column:
    """All findings of a row as (start, end, kind, order)."""
    kinds = KINDS if with_random else KINDS[:3]
    return F.flatten(F.array(*[labelled(F.col(k), k, i) for i, k in enumerate(kinds)]))
