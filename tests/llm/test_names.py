"""Input columns that are named like columns that operators use inside keep their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from yieldline.llm import line_dedup, quality, suffix_dedup
from yieldline.llm.names import apart_from_input

ODD = ["__words", "__lines", "__chars", "__symbols", "__sorted", "__real", "__good", "__places", "__left", "__drop", "__key", "__null", "__bytes", "__score", "column0"]


@pytest.fixture(scope="module")
def odd(spark):
    line = "a line of some words that stands in two documents " * 6
    rows = [(1, line), (2, line + "\nmore"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id")).alias(c) for c in ODD])


OPERATORS = {
    "measure": quality.measure,
    "lines": line_dedup.drop_repeated_lines,
    "bytes": suffix_dedup.remove_repeated,
    "texts": suffix_dedup.drop_repeated,
    "line_stage": lambda docs: corpus_pipeline.drop_repeated_lines(docs.sparkSession, docs, ""),
    "passage_stage": lambda docs: corpus_pipeline.drop_repeated_passages(docs.sparkSession, docs, ""),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_stay(odd, name):
    docs = odd.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    plain = docs.drop(*ODD)
    found = OPERATORS[name](docs)
    assert set(docs.columns) <= set(found.columns)
    for row in found.collect():
        assert [row[c] for c in ODD] == [f"{c} {row.doc_id}" for c in ODD]
    same = [c for c in found.columns if c not in ODD]
    assert sorted(map(str, found.select(same).collect())) == sorted(map(str, OPERATORS[name](plain).select(same).collect()))


def test_arguments_follow_their_columns(spark):
    docs = spark.createDataFrame([(1, "x")], "__id long, __text string")
    seen = []

    @apart_from_input
    def operator(frame, key, text="text"):
        seen.append((key, text, frame.columns))
        return frame.select(key, text)

    assert operator(docs, "__id", text="__text").columns == ["__id", "__text"]
    assert seen == [("column0", "column1", ["column0", "column1"])]
