"""Corpus pipeline: reject toxic documents, keep one of each near-duplicate group, remove repeated
passages, pseudonymise personal data, pack what is left into training sequences.

Each stage takes all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsync.llm import jaccard, packing, pii, repeats, toxicity
from loomsync.llm.common import read
from loomsync.llm.packing import token_pieces
from loomsync.llm.tokens import added_tokens
from loomsync.session import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labels of the given documents."""
    weights = toxicity.toxic_weights(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, score="_score").where(F.col("_score") < toxicity.THRESHOLD).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked rows the one with the smallest id (null: last), of equal ids any one.

    Rows, not ids, are compared: rows that share an id and are not linked all stay.
    """
    rows = staged(docs.select(F.monotonically_increasing_id().alias("_row"), *COLUMNS), "rows")
    classes = jaccard.near_duplicates(rows, doc_id="_row").select(F.col("doc_id").alias("_row"), "component_id")
    members = rows.select("_row", "doc_id").join(classes, "_row")
    kept = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")).select("first._row")
    return rows.join(kept, "_row", "left_semi").select(*COLUMNS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 400 bytes or more that occur again; cut characters go whole."""
    cut = repeats.remove_repeats(docs.select(*COLUMNS), decoded=True)
    kept = cut.withColumn("text", F.when(F.col("_removed") > 0, F.col("_kept")).otherwise(F.col("text"))).select(*COLUMNS)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with validated personal data replaced by pseudonyms under the session's key, in checks a known one."""
    key = spark.conf.get("spark.loomsync.pseudonym.key", pii.TEST_KEY)
    done = pii.pseudonymize(docs.select(*COLUMNS), key, count="_private").drop("_private")
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences of at most 2048 tokens."""
    ranks, added = public_tokenizers.path("byte_bpe_50k.tiktoken"), added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(token_pieces(docs, ranks, public_tokenizers.PATTERN, added=added))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard_join", keep_one_of_each),
    ("suffix_array_dedup", remove_repeats),
    ("pii", pseudonymize),
    ("best_fit_packing", pack),
]

#: Tokens, training and suffix order are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
