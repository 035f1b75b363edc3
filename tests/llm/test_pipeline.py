"""Registration, the pipeline's stages, and the library without the training-data operators."""

import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
import brute
import corpus_pipeline
from oracle import compare, connect
from yieldline.llm import toxicity
from yieldline.llm.encoding import ForcedBoundaryEncoder, vocabulary_path

NAMES = [f"op{n}_" for n in range(1, 11)]


def test_every_operator_is_registered():
    names = list(driver.queries())
    assert all(sum(n.startswith(p) for n in names) == 1 for p in NAMES) and "pipeline" in names
    assert set(WITH_SQL) <= set(driver.oracle_sql())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "suffix_dedup", "packing"]


WITH_SQL = ["op1_ngram_jaccard_join", "op4_subspace_pigeonhole", "op7_winnowed_line_dedup", "op8_suffix_array_dedup", "op10_line_first_quality"]


@pytest.mark.parametrize("name", WITH_SQL)
def test_registered_sql(spark, folder, name):
    assert compare(driver.queries()[name](spark, folder), connect(folder), driver.oracle_sql()[name])[1] == []


def test_stages_in_turn(spark, documents, folder, tmp_path):
    """Every stage keeps the columns; decisions equal the plain versions on the stage's own input."""
    docs = documents.drop("key", "n")
    stages = dict(corpus_pipeline.STAGES)
    lined = stages["line_dedup"](spark, docs, folder)
    assert lined.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in lined.collect()]
    one = stages["near_duplicates"](spark, spark.createDataFrame(rows, "doc_id long, text string"), folder)
    want = brute.near_duplicates([(i, t) for i, t in rows if i is not None])
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in want.items() if c == i} | {None}
    passages = stages["suffix_dedup"](spark, docs, folder)
    assert passages.columns == docs.columns
    sizes = brute.repeated_bytes([(r.doc_id, r.text) for r in docs.dropDuplicates().collect() if r.doc_id is not None])
    gone = {i for i, (n, removed, _, _) in sizes.items() if n and n == removed}
    assert {r.doc_id for r in passages.collect()} >= set(sizes) - gone


def test_whole_pipeline(spark, folder):
    pieces = corpus_pipeline.run(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = Counter(p.doc_id for p in pieces)
    assert 0.5 * docs.count() < len(kept) <= docs.count()
    total = Counter()
    for p in pieces:
        total[p.sequence_id] += p.length
    assert max(total.values()) <= 2048


@pytest.fixture(scope="module")
def labelled(spark, documents, tmp_path_factory):
    """A folder with the odd corpus and 300 labelled documents, a fifth of them toxic."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1000, 1300):
        words = [f"word{j}" for j in rng.integers(0, 3000, rng.integers(5, 60))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(["idiot", "scum"])))
        rows.append((i, " ".join(words), "en", "s", 5, toxic))
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, toxic int")
    folder = str(tmp_path_factory.mktemp("labelled"))
    documents.drop("key", "n").unionByName(made.drop("toxic")).write.parquet(f"{folder}/documents.parquet")
    made.selectExpr("doc_id", "0 AS quality", "toxic").write.parquet(f"{folder}/labels.parquet")
    return folder


def rows_of(frame):
    return [(r.doc_id, r.text, r.n_chars) for r in frame.collect()]


def clean_rows(spark, folder, rows):
    """Rows whose score is below the threshold; scored here, without the stage."""
    network = toxicity.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    scores = toxicity.Network.from_bytes(network).scores(toxicity.Words(pa.array([t for _, t, _ in rows], pa.string())))
    return [r for r, x in zip(rows, scores.tolist(), strict=True) if x < toxicity.THRESHOLD]


def pieces_of(rows, size=2048):
    library, want = ForcedBoundaryEncoder(vocabulary_path("byte_bpe_50k.json")).library, Counter()
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), size):
            part = ids[a : a + size]
            want[key, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    return want


def check_pieces(found, rows):
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in found) == pieces_of(rows)
    ends = Counter()
    for p in sorted(found, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
    assert max(ends.values()) <= 2048


@pytest.mark.parametrize("name, plain", [("line_dedup", brute.line_stage), ("near_duplicates", brute.near_stage), ("suffix_dedup", brute.passage_stage)])
def test_whole_output_of_a_stage(spark, labelled, name, plain):
    docs = spark.read.parquet(f"{labelled}/documents.parquet")
    found, before = dict(corpus_pipeline.STAGES)[name](spark, docs, labelled), rows_of(docs)
    assert found.columns == docs.columns
    want = Counter(plain(before))
    assert Counter(rows_of(found)) == want and want != Counter(before)


def test_whole_output_of_toxicity_and_packing(spark, labelled):
    docs, stages = spark.read.parquet(f"{labelled}/documents.parquet"), dict(corpus_pipeline.STAGES)
    want = clean_rows(spark, labelled, rows_of(docs))
    assert Counter(rows_of(stages["toxicity"](spark, docs, labelled))) == Counter(want) and len(want) < docs.count()
    check_pieces(stages["packing"](spark, docs, labelled).collect(), rows_of(docs))


def test_rows_of_the_whole_pipeline(spark, labelled):
    rows = clean_rows(spark, labelled, rows_of(spark.read.parquet(f"{labelled}/documents.parquet")))
    for stage in (brute.line_stage, brute.near_stage, brute.passage_stage):
        rows = stage(rows)
    check_pieces(corpus_pipeline.run(spark, labelled).collect(), rows)


def test_library_imports_without_the_operators():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('yieldline.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') for n in e.queries()) and len(e.queries()) > 90\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rpartition("/")[0])
