"""A corpus from raw documents to packed sequences. Each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline.llm import jaccard, line_dedup, packing, suffix_dedup, toxicity
from yieldline.llm.catalog import ship
from yieldline.llm.encoding import vocabulary_path
from yieldline.llm.names import apart_from_input
from yieldline.session import new_folder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (9): documents whose score reaches the threshold go. Fitted on the labels of the input folder."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (7): later repeated lines and runs of lines go, and documents of which nothing else is left."""
    cleaned = line_dedup.drop_repeated_lines(docs, min_words=line_dedup.MIN_WORDS)
    return _with_text_left(docs, cleaned, F.col("n_removed_lines"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (1): the first document of each group stays."""
    return jaccard.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup (8): later copies of passages go, and documents of which nothing else is left."""

    @apart_from_input
    def shorter(docs: DataFrame) -> DataFrame:
        cleaned = suffix_dedup.drop_repeated(docs.withColumn("__bytes", F.octet_length("text")))
        return _with_text_left(docs, cleaned, F.col("__bytes") - F.octet_length("text"))

    return shorter(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (6): pieces of all documents left, with their sequence and place in it."""
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"))


def _with_text_left(docs: DataFrame, cleaned: DataFrame, removed: Column) -> DataFrame:
    """The columns of documents, with n_chars of the new text. Texts that were empty before stay as they are."""
    emptied = (removed > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    left = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    counted = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", counted).select(docs.columns)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Classifier, components and token ids are beyond SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            folder = new_folder(spark, f"stage-{i}-{name}")
            docs.write.parquet(folder)
            docs = spark.read.parquet(folder)
    return docs
