"""Registered queries of the operators: name -> function (spark, table folder) -> DataFrame."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stalewatch.llm import (
    alignment,
    decontamination,
    divergence,
    line_dedup,
    neighbours,
    personal_data,
    quality,
    secret_scan,
    sentencepiece,
    sharding,
    simhash,
    substrings,
    suffixes,
)
from stalewatch.llm.spans import listed
from stalewatch.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_learned_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest vectors of every fiftieth one."""
    return neighbours.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every document that repeat an earlier line up to one character, and what stays."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0"


@query
def op3_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every document, learnt from the labels outside the held-out fifth."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    chain = quality.learn(quality.training_rows(docs, table(spark, d, "labels"), HELD_OUT))
    return quality.score(docs, chain).select(
        "doc_id",
        F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id among its near-duplicates."""
    found = simhash.near_duplicates(table(spark, d, "documents"))
    digits = F.lower(F.lpad(F.hex("simhash"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op5_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    coded = sentencepiece.encode(docs, TOKENIZER, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_suffixes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of every document covered by a 50-byte string of an earlier one, and the digest of the rest."""
    found = suffixes.remove_repeats(table(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_sharding(spark: SparkSession, d: str) -> DataFrame:
    """Every document in one of 16 equal shards by its key, and where it goes with a seventeenth."""
    docs = table(spark, d, "documents").select(
        "doc_id", sharding.text_bytes(F.col("text")).alias("size"), sharding.text_crc(F.col("text")).alias("text_crc32")
    )
    placed = sharding.shard_rows(docs, "doc_id", [1.0] * 16, extra_weight=1.0)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query
def op8_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document that lie in a ten-word window of a benchmark item."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, d, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op9_secrets(spark: SparkSession, d: str) -> DataFrame:
    """Secrets of every document: fixed patterns, and random strings by Markov models."""
    found = secret_scan.find_secrets(table(spark, d, "documents").select("doc_id", "text"))
    count = {f"n_{k}": F.size(k).cast("long") for k in ("assign", "access", "hex")}
    base = listed(secret_scan.all_spans(with_random=False), by_start=True)
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(base, 256).alias("base_sha256"),
        listed(secret_scan.all_spans(), by_start=True).alias("spans"),
    )


@query
def op10_personal_data(spark: SparkSession, d: str) -> DataFrame:
    """Personal data of every document: fixed patterns, and identifiers found by their contexts."""
    found = personal_data.find_personal_data(table(spark, d, "documents").select("doc_id", "text"))
    count = {f"n_{k}": F.size(k).cast("long") for k in personal_data.KINDS}
    base = listed(personal_data.all_spans(with_context=False), by_start=False)
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(base, 256).alias("base_sha256"),
        listed(personal_data.all_spans(), by_start=False).alias("spans"),
    )


@query
def op11_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Groups in which the tokens of two vocabularies end together, and how common the links are in the corpus."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = alignment.align(docs, BYTE_TOKENIZER, TOKENIZER)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256")
    )


@query
def op12_divergence(spark: SparkSession, d: str) -> DataFrame:
    """How every source differs from the others of its language, and its most telling terms."""
    return divergence.audit(table(spark, d, "documents"))


@query
def op13_substrings(spark: SparkSession, d: str) -> DataFrame:
    """Words of every document in a 13-word window of an earlier one, and the digest of the rest."""
    found = substrings.remove_repeats(table(spark, d, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
