"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline.llm import (
    bpe,
    eliasfano,
    hard_negatives,
    html,
    jaccard,
    line_dedup,
    packing,
    pigeonhole,
    quality,
    ranked_search,
    suffix_dedup,
    toxicity,
    warc,
)
from yieldline.llm.encoding import vocabulary_path
from yieldline.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each session. Their working folders are not the driver's; only workers of a
    local master share its search path. The archive stays until the driver ends, as executors fetch it when they start."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    known = {os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]}
    if not (context.master.startswith("local[") and str(ROOT) in known):
        folder = tempfile.mkdtemp(prefix="yieldline-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/yieldline", "zip", ROOT, "yieldline"))
    _shipped.add(context.applicationId)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op1_ngram_jaccard_join"] = jaccard.checking_sql()


@query
def op2_elias_fano_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    eliasfano.write(table(spark, sf_dir, "documents"), folder, vocabulary_path("word_bpe_49k.json"))
    return eliasfano.read_index(spark, folder)


@query
def op3_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op4_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.near_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op4_subspace_pigeonhole"] = pigeonhole.checking_sql()


@query
def op5_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


@query
def op6_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


@query
def op7_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_words=line_dedup.MIN_WORDS)
    return cleaned.select("doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op7_winnowed_line_dedup"] = line_dedup.checking_sql()


@query
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.measure_repeated(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op8_suffix_array_dedup"] = suffix_dedup.checking_sql()


@query
def op9_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, network).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op10_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


ORACLES["op10_line_first_quality"] = quality.checking_sql()


@query
def op11_range_maximum_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op11_range_maximum_search"] = ranked_search.checking_sql()


@query
def op12_four_russians_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op12_four_russians_negatives"] = hard_negatives.checking_sql()


@query
def op13_splittable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.page_records(spark, folder)


ORACLES["op13_splittable_warc"] = warc.checking_sql()
