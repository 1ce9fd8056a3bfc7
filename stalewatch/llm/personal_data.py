"""Personal data: four fixed patterns, and bootstrapped contextual extraction of what they miss.

The findings of the fixed patterns are the seeds. Every token group with a digit or an at sign is a mention of an
instance (its text); the words around it are its lexical patterns: the two words before, and the word before with
the word after. Patterns and instances form a graph that is scored in rounds:

* a pattern's confidence is the sum of its instances' scores over their number, for instances of one shape
  (email, ip, card, phone); it counts from ``SUPPORT`` on, in sums of distinct instances;
* an instance's score is one for a seed, else the chance that not all of its confident patterns are wrong.

Mentions of an instance whose score reaches ``CONFIDENCE`` are findings of the kind ``context``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stalewatch.llm.spans import labelled, matches, outside
from stalewatch.staging import stage

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base findings. Runs are possessive and start at their first character,
# which gives the same matches without trying every later start of a long run.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
MENTION = r"(?<!\S)\S*[0-9@]\S*(?:\x20\S*[0-9@]\S*){0,5}"
CONTEXT_CHARS = 60
ROUNDS = 3
SUPPORT = 5
CONFIDENCE = 0.9


def base_findings(text: Column) -> dict[str, Column]:
    """Spans of the four kinds; a match that fails its test is dropped."""

    def digits(s: Column) -> Column:
        return F.regexp_replace(s["value"], "[^0-9]", "")

    return {
        "email": matches(text, EMAIL),
        "ip": F.filter(matches(text, IP), lambda s: s["value"].rlike(rf"^(?:{_PART}\.){{3}}{_PART}$")),
        "card": F.filter(
            matches(text, CARD), lambda s: F.char_length(digits(s)).between(13, 19) & F.call_function("luhn_check", digits(s))
        ),
        "phone": F.filter(matches(text, PHONE), lambda s: F.char_length(digits(s)).between(9, 15)),
    }


def _shape(value: Column) -> Column:
    """What kind of identifier a mention looks like; null for short numbers and other tokens."""
    digits = F.char_length(F.regexp_replace(value, "[^0-9]", ""))
    bare = ~value.rlike(r"[^0-9\x20().+-]")
    return (
        F.when(value.rlike(r"^[^@]+@[^@]+$"), "email")
        .when(value.rlike(r"^[0-9]+(?:[.:][0-9]+){3}$"), "ip")
        .when(bare & digits.between(13, 19), "card")
        .when(bare & digits.between(7, 12), "phone")
    )


def scanned(docs: DataFrame, text: str) -> DataFrame:
    """Base findings and mentions of each row, narrow, read from the text once; written to the shared folder."""
    content = F.coalesce(F.col(text), F.lit(""))
    kept = docs.drop(*KINDS, "mentions", "digest")
    found = base_findings(content) | {"mentions": matches(content, MENTION, context=CONTEXT_CHARS)}
    return stage(kept.withColumns(found | {"digest": F.xxhash64(content)}).drop(text), "personal")


def _whole_words(context: str, cut: str) -> Column:
    """The context without the word its length has cut; a word of ``CONTEXT_CHARS`` or more is no context."""
    return F.when(F.char_length(context) < CONTEXT_CHARS, F.col(context)).otherwise(F.regexp_replace(context, cut, ""))


def mentions(rows: DataFrame) -> DataFrame:
    """One row for each mention with a shape: where it is, its instance, its patterns, and whether it is a seed."""
    base = F.flatten(F.array(*KINDS))
    each = rows.select("doc_id", "digest", base.alias("base"), F.explode("mentions").alias("m"))
    # Punctuation around the value is no part of it; each end is looked at once.
    opened = F.regexp_replace("m.value", r"^[^0-9A-Za-z+(]++", "")
    trimmed = F.regexp_replace(opened, r"(?<![^0-9A-Za-z)])[^0-9A-Za-z)]++$", "")
    start = F.col("m.start") + F.char_length("m.value") - F.char_length(opened)
    before = F.lower(F.regexp_extract(_whole_words("m.before", r"^\S+"), r"(\S+\s+)?(\S+)\s*$", 0))
    one = F.regexp_extract(before, r"(\S+)\s*$", 1)
    after = F.lower(F.regexp_extract(_whole_words("m.after", r"\S+$"), r"^\s*(\S+)", 1))
    patterns = F.array(
        F.when(one != "", F.concat(F.lit("two "), F.regexp_replace(F.trim(before), r"\s+", " "))),
        F.when((one != "") & (after != ""), F.concat(F.lit("around "), one, F.lit(" "), after)),
    )
    placed = each.select(
        "doc_id",
        "digest",
        "base",
        start.alias("start"),
        (start + F.char_length(trimmed)).alias("end"),
        F.lower(trimmed).alias("instance"),
        F.array_compact(patterns).alias("patterns"),
    )
    overlaps = F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    return placed.withColumns({"shape": _shape(F.col("instance")), "seed": overlaps}).filter("shape IS NOT NULL").drop("base")


def scores(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``shape``, ``instance`` and ``score`` of every instance after the rounds.

    One plan: the rounds share the shuffled edges, and only the scores pass from one to the next. Writing them out after
    each would give a file for every shuffle partition, mostly of a few rows.
    """
    edges = found.select("shape", "instance", "seed", F.explode("patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "shape", "instance").agg(F.max("seed").alias("seed"))
    seeds = now = found.groupBy("shape", "instance").agg(F.max("seed").cast("double").alias("score"))
    for _ in range(rounds):
        confident = (
            edges.join(now, ["shape", "instance"])
            .groupBy("pattern", "shape")
            .agg(F.sum("score").alias("support"), F.avg("score").alias("confidence"))
            .filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))
        )
        doubt = F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999)))))
        reached = edges.join(confident, ["pattern", "shape"]).groupBy("shape", "instance").agg((1 - doubt).alias("reached"))
        joined = seeds.join(reached, ["shape", "instance"], "left")
        now = joined.select("shape", "instance", F.greatest("score", F.coalesce("reached", F.lit(0.0))).alias("score"))
    return now


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Replaces the text by ``email``, ``ip``, ``card``, ``phone`` and ``context``: arrays of (start, end, value).

    ``context`` holds what the fixed patterns miss and overlaps none of their findings. Null and empty texts
    have empty arrays. Rows of equal doc_id (null too) and equal text get equal findings. Columns that have one of
    the new names are replaced, all others stay. The text is read once, in a time that grows with its length, however long
    its tokens are.
    """
    named = docs.withColumnRenamed(doc_id, "doc_id") if doc_id != "doc_id" else docs
    rows = scanned(named.drop("context"), text)
    found = stage(mentions(rows), "mentions")
    sure = scores(found).filter(F.col("score") >= CONFIDENCE).select("shape", "instance")
    new = found.filter("NOT seed").join(sure, ["shape", "instance"], "left_semi")
    span = F.struct("start", "end", F.col("instance").alias("value"))
    gathered = new.groupBy("doc_id", "digest").agg(F.collect_set(span).alias("context"))
    other = gathered.select(F.col("doc_id").alias("other_id"), F.col("digest").alias("other_digest"), "context")
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("digest") == F.col("other_digest"))
    whole = rows.join(other, same, "left").drop("other_id", "other_digest", "digest", "mentions")
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    whole = whole.withColumn("context", outside(F.coalesce("context", empty), F.flatten(F.array(*KINDS))))
    return whole.withColumnRenamed("doc_id", doc_id) if doc_id != "doc_id" else whole


def all_spans(with_context: bool = True) -> Column:
    """All findings of a row as (start, end, kind, order)."""
    kinds = (*KINDS, "context") if with_context else KINDS
    return F.flatten(F.array(*[labelled(F.col(k), k, i) for i, k in enumerate(kinds)]))
