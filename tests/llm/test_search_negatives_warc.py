"""Ranked search and hard negatives against plain versions; WARC archives by exact round trips over any byte ranges."""

import gzip
import hashlib
import math
import random
import re
import zlib
from base64 import b32encode
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle import compare, connect
from yieldline.llm import catalog, hard_negatives, ranked_search, warc
from yieldline.session import new_folder

NEW = ("op11_range_maximum_search", "op12_four_russians_negatives", "op13_splittable_warc")


@pytest.mark.parametrize("name", NEW)
def test_query_equals_its_sql(spark, folder, name):
    rows, differences = compare(catalog.QUERIES[name](spark, folder), connect(folder), catalog.ORACLES[name])
    assert rows and not differences


# ranked search -----------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain_ranking(docs, items, top=10):
    held = [(d, Counter(terms(t))) for d, t in docs if d is not None]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for d, c in held:
            size = sum(c.values())
            m = 25 + (75 * size * n) // total
            score = 0
            for t, k in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += k * w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("size, at_once, block", [(16 << 20, 64, 4 << 20), (900, 1, 40), (1, 3, 4 << 20)])
def test_search_equals_scoring_everything(spark, pairs, documents, monkeypatch, size, at_once, block):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", size)
    monkeypatch.setattr(ranked_search, "AT_ONCE", at_once)
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    asked = [(i, pairs[i][1]) for i in (0, 1, 7, 30, 64)] + [(90, "one ONE two green0 字 字"), (91, "kůň"), (92, "neverheard"), (93, "")]
    items = spark.createDataFrame([(*x, 1) for x in asked + [(94, None), (None, "one"), (90, "zzz")]], "item_id long, text string, rank int")
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(ranked_search.ranked(documents, items)) == plain_ranking(docs, asked)
    assert found(ranked_search.ranked(documents, items, top=1)) == plain_ranking(docs, asked, 1)


def test_an_index_file_holds_few_shards_however_many_documents_a_task_has(spark, pairs, documents, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 900)
    folder = new_folder(spark, "index")
    index = ranked_search.Index.write(documents.coalesce(1), folder)
    rows = [pq.ParquetFile(f).metadata.num_rows for f in Path(folder).glob("*.parquet")]
    assert sum(rows) == index.shards().count() > 20 and max(rows) <= 4
    assert {t for _, t in index.shards().dtypes} == {"bigint", "binary"}
    asked = [(0, pairs[0][1]), (1, "one two")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert found(ranked_search.search(index, items)) == plain_ranking([(r.doc_id, r.text) for r in documents.collect()], asked)


def test_search_of_copies_and_of_nothing(spark, nothing):
    docs = [(i, "same words here" if i % 3 else f"other words {i}") for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    items = [(1, "same here"), (2, "words words other 12")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(ranked_search.ranked(frame, asked)) == plain_ranking(docs, items)
    assert found(ranked_search.ranked(nothing, asked)) == []
    assert found(ranked_search.ranked(frame, asked.limit(0))) == []
    blank = spark.createDataFrame([(1, None), (2, " .,"), (3, "")], "doc_id long, text string")
    assert found(ranked_search.ranked(blank, asked)) == []


@settings(max_examples=60, deadline=None)
@given(values=st.lists(st.integers(0, 2**40), min_size=1, max_size=70), data=st.data())
def test_range_maxima(values, data):
    maxima = ranked_search.RangeMaxima(np.array(values, np.int64), len(values))
    ranges = data.draw(st.lists(st.tuples(st.integers(0, len(values)), st.integers(0, len(values))), min_size=1, max_size=9))
    low, high = np.array([min(r) for r in ranges]), np.array([max(r) for r in ranges])
    assert maxima(low, high).tolist() == [max(values[a:b], default=0) for a, b in zip(low, high, strict=True)]


def test_search_leaves_most_documents_unscored(monkeypatch):
    rng = random.Random(5)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(80))) for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"id": [d for d, _ in docs], "text": [t for _, t in docs]})
    row = ranked_search.shard(batch)
    lists = {n: row.column(i)[0].values for i, n in enumerate(row.schema.names) if i > 1}
    words, _ = ranked_search.terms_of(pa.array([docs[77][1]]))
    coded = words.dictionary_encode()
    vocabulary = coded.dictionary.cast(pa.string())
    asked, places = ranked_search._asked(lists["terms"], vocabulary)
    held = np.zeros(len(vocabulary), np.int64)
    held[asked] = np.diff(lists["ends"].to_numpy(), prepend=0)[places]
    weights = np.array([ranked_search.weight(3000, int(h)) for h in held], np.int64)
    scored, real = [0], ranked_search.better

    def counted(best, more, top):
        scored[0] += len(more[0])
        return real(best, more, top)

    monkeypatch.setattr(ranked_search, "better", counted)
    searcher = ranked_search.Searcher(lists, vocabulary, weights, 3000, 240_000)
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    best = searcher.search(*np.unique(coded.indices.to_numpy(), return_counts=True), none, 10)
    assert best[1][0] == 77
    assert scored[0] < 1500


# hard negatives ----------------------------------------------------------------------------------


def plain_negatives(rows, every=10, scale=256):
    known = []
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((key, str(label), [math.floor(scale * float(x)) for x in vector]))
    least = {}
    for key, label, c in known:
        if key % every == 0:
            least[key] = min(least.get(key, (label, c)), (label, c))
    out = []
    for anchor, (label, c) in least.items():
        scored = [(-sum(x * y for x, y in zip(c, d, strict=False)), key, own) for key, own, d in known if key != anchor]
        near = sorted((s, k) for s, k, own in scored if own == label)[:5]
        for slot, (s, positive) in enumerate(near):
            fits = sorted((n, k) for n, k, own in scored if own != label and 80 * -s <= 100 * -n <= 100 * -s)
            out += [(anchor, positive, r, k, -s, -n) for r, (n, k) in enumerate(fits[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, chunk", [(512, 4096), (3, 7)])
def test_hard_negatives(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "CHUNK", chunk)
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 5)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=20).round(1).tolist(), int(i * 7 % 4)) for i in range(150)]
    rows += [(200 + i, rows[20][1], i % 3) for i in range(40)]  # a vector that many rows have
    rows += [(300, [0.0] * 20, 1), (301, [1e6, -1e6, 3.25], 0), (310, [2.0] * 9, 2), (320, [], 1), (330, [-4.0] * 20, 3)]
    rows += [(340, None, 1), (350, [1.0] * 20, None), (None, [1.0] * 20, 1), (360, [float("nan")] * 20, 1), (370, [float("inf")] * 20, 1), (380, [None, 1.0], 1)]
    rows += [rows[10], rows[10], (10, [0.5] * 20, 0), rows[33]]
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<double>, label int, id string, c int").repartition(4)
    answer = hard_negatives.hard_negatives(frame, frame.vec_id % 10 == 0)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows)
    assert sorted(tuple(r) for r in answer.select(names).collect()) == want and len(want) > 300
    assert hard_negatives.hard_negatives(frame.limit(0), frame.vec_id % 10 == 0).collect() == []
    assert hard_negatives.hard_negatives(frame, frame.vec_id < -1).collect() == []


def test_anchors_are_scored_in_legs_and_not_copied_for_each_chunk(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).round(1).tolist(), int(i * 7 % 3)) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    monkeypatch.setattr(hard_negatives, "CHUNK", 9)
    answers = [hard_negatives.hard_negatives(frame, frame.vec_id % 10 == 0)]
    plan = answers[0]._jdf.queryExecution().toString()
    assert "Join" not in plan and "Generate" not in plan and "explode" not in plan
    monkeypatch.setattr(hard_negatives, "HELD", 20)
    monkeypatch.setattr(hard_negatives, "LEG_BYTES", 600)  # some three anchors
    answers.append(hard_negatives.hard_negatives(frame, frame.vec_id % 10 == 0))
    first, other = (sorted(tuple(r) for r in a.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) for a in answers)
    assert first == other == plain_negatives(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 19), st.integers(1, 6), st.integers(1, 5), st.integers(0, 2**31), st.integers(0, 40))
def test_lookups_are_inner_products(width, rows, anchors, seed, power):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-(2**power), 2**power + 1, (rows, width)), rng.integers(-300, 300, (anchors, width))
    first, other = (hard_negatives.matrix(pa.array(v.tolist(), pa.list_(pa.int64()))) for v in (x, y))
    got = hard_negatives.scores(hard_negatives.bit_planes(first), hard_negatives.subset_sums(other))
    assert got.tolist() == (x @ y.T).tolist()


# archives ----------------------------------------------------------------------------------------


def plain_records(pages, least=0):
    top = {}
    for key, _, html in pages:
        data = (html or "").encode()
        if key is not None and len(data) >= least:
            top[data] = max(top.get(data, key), key)
    out = []
    for key, _, html in pages:
        data = (html or "").encode()
        response = top.get(data, key)
        digest = b32encode(hashlib.sha1(data).digest()).decode()
        other = response != key and len(data) >= least
        out.append((key, len(data), digest, "revisit" if other else "response", response if other else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    rows = [(i, f"http://site{i % 9}/page?x={i}%20&é", "<p>" + " ".join(rng.choice(["sea", "Straße", "字"]) for _ in range(i)) + "</p>") for i in range(60)]
    rows += [(100 + i, None if i % 2 else "u\r\nWARC-Type: evil", "<b>copy</b>") for i in range(20)]
    rows += [(200, "u", None), (201, "u", ""), (202, None, "\r\n\r\nHTTP/1.1 \x1f\x00 WARC/1.1\r\n\r\n"), (203, "big", "x y z\n" * 90_000)]
    rows += [rows[5], rows[70], (None, "none", "<b>copy</b>"), (None, None, "alone"), (204, "u", "".join(map(chr, range(1, 3000))))]
    return rows


@pytest.mark.parametrize("least", [0, 12])
def test_archives_round_trip(spark, pages, least):
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, sha string, id int").repartition(5)
    folder = new_folder(spark, "warc")
    warc.write(frame, folder, least=least)
    found = [tuple(r) for r in warc.page_records(spark, folder).collect()]
    assert sorted(found, key=str) == plain_records(pages, least)
    full = {r.record_id: r for r in warc.read(spark, folder).where("warc_type = 'response'").collect()}
    assert all(r.intact for r in full.values())
    assert {k: r.payload.decode() for k, r in full.items()}[f"{warc.RECORD_PREFIX}203"] == pages[83][2]
    assert full[f"{warc.RECORD_PREFIX}3"].target_uri == pages[3][1]
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(folder).glob("part-*")))
    assert plain.count(b"WARC/1.1\r\nWARC-Type: ") == len(pages)


def test_archives_of_nothing(spark):
    folder = new_folder(spark, "warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.page_records(spark, folder).collect() == []


def raw_member(data, level):
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def records_in(spark, folder, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return sorted((r.warc_type, r.record_id, r.payload) for r in warc.read(spark, folder).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [23, 61, 127, 500, 1999, 1 << 20])
def test_any_byte_ranges_give_the_same_records(spark, size):
    """Members stored without compression, whose payloads hold magic bytes and whole gzip members."""
    rng = random.Random(4)
    payloads = [b"plain", b"", warc.MAGIC * 30, warc.EMPTY_MEMBER * 3, raw_member(b"no record", 6) * 4, rng.randbytes(300) + warc.MAGIC + rng.randbytes(50)]
    payloads += [rng.randbytes(40) + warc.MAGIC[:2], warc.MAGIC + b"\x00" * 30 + warc.MAGIC]
    records = []
    for i, p in enumerate(payloads * 2):
        text = warc.record(i, None, p, None, "2024-01-01T00:00:00Z")
        records.append(raw_member(text, 0 if i < 8 else 6))
    folder = new_folder(spark, "warc-raw")
    Path(folder).mkdir(parents=True)
    Path(folder, "a.warc").write_bytes(b"".join(records))
    Path(folder, "b.warc").write_bytes(warc.EMPTY_MEMBER + records[2] + raw_member(b"not a record", 6) + records[0])
    want = [("response", f"{warc.RECORD_PREFIX}{i}", p) for i, p in enumerate(payloads * 2)]
    want += [want[2], want[0]]
    assert records_in(spark, folder, size) == sorted(want)


def test_damaged_members_are_reported(spark):
    good = [raw_member(warc.record(i, None, b"text %d" % i, None, "2024-01-01T00:00:00Z"), 6) for i in range(4)]
    broken = good[1][:30] + b"\xff\xff\xff" + good[1][33:]
    folder = new_folder(spark, "warc-damaged")
    Path(folder).mkdir(parents=True)
    Path(folder, "a.warc").write_bytes(good[0] + broken + good[2] + good[3][:-20])
    kinds = Counter(k for k, _, _ in records_in_default(spark, folder))
    assert kinds == {"response": 2, "damaged": 2}


def records_in_default(spark, folder):
    return [(r.warc_type, r.record_id, r.payload) for r in warc.read(spark, folder).collect()]
