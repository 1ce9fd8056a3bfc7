"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given. All but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stalewatch.llm import decontamination, line_dedup, quality, sentencepiece, simhash
from stalewatch.llm.queries import HELD_OUT, TOKENIZER
from stalewatch.llm.tables import table
from stalewatch.staging import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line model takes for good; it never learns from the held-out fifth of the labels."""
    chain = quality.learn(quality.training_rows(docs, table(spark, sf_dir, "labels"), HELD_OUT))
    return quality.score(docs, chain, out="__score").filter(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; one whose whole content stands earlier goes."""
    kept = line_dedup.dedup_lines(docs.select("*", F.lit(0).alias("n_removed")))
    emptied = (F.col("n_removed") > 0) & ~F.col("text").rlike(r"\S")
    return kept.filter(~emptied).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of linked SimHash fingerprints: least doc_id, rows without one last."""
    # A row is known by all its columns, as ids may be null or repeated; xxhash64 alone passes over nulls.
    columns = [c for name in docs.columns for c in (F.col(name).isNull(), F.col(name))]
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", F.xxhash64(*columns).alias("hash"))
    placed = docs.withColumn("__key", place)
    found = simhash.near_duplicates(placed.select("__key", "text"), doc_id="__key")
    fields = ("without", "doc_id", "hash")
    first = found.filter("doc_id = component_id").select(*[F.col("doc_id")[f].alias(f"__{f}") for f in fields]).distinct()
    same = [F.col("__key")[f].eqNullSafe(F.col(f"__{f}")) for f in fields]
    kept = placed.join(first, same[0] & same[1] & same[2], "left_semi")
    # Rows that are equal in every column have one key.
    equal = Window.partitionBy("doc_id", "__key.hash").orderBy("n_chars")
    return kept.withColumn("__place", F.row_number().over(equal)).filter("__place = 1").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with a benchmark item."""
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("n_hit = 0").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document with an end id, and the text they decode to."""
    coded = sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER, decoded="decoded")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("SimHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", encoded),
]

#: The classifier and the tokenizer have no SQL form; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
