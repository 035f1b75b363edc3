"""Near duplicates, repeated bytes and repeated lines against plain versions."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
import corpus_pipeline
from oracle import compare
from yieldline.llm import jaccard, line_dedup, quality, suffix_dedup
from yieldline.llm.components import components
from yieldline.llm.shingles import shingle_sets


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (7, 3), (5, 5), (9, 8), (8, 9), (20, 21), (21, 22), (22, 23), (23, 24), (1, None)], "a long, b long")
    assert {r.id: r.component for r in components(links).collect()} == {1: 1, 2: 1, 3: 1, 7: 1, 8: 8, 9: 8, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}
    assert components(links.where("a = 5")).count() == 0


def test_shingle_sets(pairs):
    sets = shingle_sets(pa.array([t for _, t in pairs]), 5)
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for _, t in pairs]
    known = {}
    for made, (_, text) in zip(sets, pairs):
        for value in set(made.tolist()):
            known.setdefault(value, text)
    assert len(known) == len(set().union(*(brute.shingles(t) for _, t in pairs)))


def test_near_duplicates(documents, pairs):
    want = brute.near_duplicates(pairs)
    found = jaccard.near_duplicates(documents).collect()
    assert len(found) == len(pairs) + 2
    for r in found:
        if r.doc_id is None:
            assert (r.n_shingles, r.component_id) == (want[0][0], None)
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    kept = jaccard.keep_one(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted([0, *(i for i, (_, c) in want.items() if c == i)])


def test_families_of_near_copies(spark):
    """Many copies with a few changed words each, and many unlike texts with one passage in common."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for j in rng.integers(0, 120, rng.integers(0, 4)):
            words[j] = f"x{rng.integers(0, 9)}"
        rows.append((i, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(1000 + i, " ".join(f"u{rng.integers(0, 10**6)}" for _ in range(30)) + " " + passage) for i in range(60)]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.near_duplicates(rows)


def test_copies_with_one_changed_word_each(spark):
    """Many have the prefix and size of another, some link with their group's first only, some with none."""
    rng = np.random.default_rng(11)
    rows = []
    for f in range(12):
        base = [f"f{f}w{i}" for i in range(60)]
        for _ in range(30):
            words = list(base)
            for j in rng.choice(60, rng.integers(1, 4), replace=False):
                words[j] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(words)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.near_duplicates(rows)


@pytest.mark.parametrize("short", [16, 1])
def test_links_are_found_without_stars(documents, pairs, monkeypatch, short):
    """The last step alone finds every link, also between classes of one group; with short lists and with all lists long."""
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "SHORT", short)
    want = brute.near_duplicates(pairs)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents).collect() if r.doc_id is not None}
    assert found == want


def paragraphs(rng, documents, pool, unique, each):
    """Texts of shared paragraphs in any order, with some words of their own."""
    shared = [" ".join(f"p{p}w{i}" for i in range(30)) for p in range(pool)]
    texts = []
    for _ in range(documents):
        parts = [shared[p] for p in rng.choice(pool, each, replace=False)]
        texts.append(" ".join([*parts, *(f"u{rng.integers(0, 10**9)}" for _ in range(unique))]))
    return texts


@pytest.mark.parametrize("pool, unique, each", [(12, 60, 3), (30, 10, 5)])
def test_pairs_do_not_grow_with_the_square_of_a_family(spark, monkeypatch, pool, unique, each):
    """Texts that share paragraphs, twice as many and four times as many: no more pair rows for each text."""
    rows = []
    for name in ("meetings", "_met_in"):

        def counted(*args, real=getattr(jaccard, name)):
            met = real(*args)
            rows[-1] += met.count()
            return met

        monkeypatch.setattr(jaccard, name, counted)
    rng = np.random.default_rng(5)
    sizes = (200, 800)
    for count in sizes:
        rows.append(0)
        texts = list(enumerate(paragraphs(rng, count, pool, unique, each)))
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
        if count == 200:
            assert found == brute.near_duplicates(texts)
    assert all(n <= 2 * jaccard.SHORT * count for n, count in zip(rows, sizes, strict=True)), rows


def test_pairs_of_a_family_of_near_copies(spark, monkeypatch):
    """Copies with changed words, some of which link and some do not: less than a quarter of all pairs are rows."""
    rows = []

    def counted(*args, real=jaccard._met_in):
        met = real(*args)
        rows.append(met.count())
        return met

    monkeypatch.setattr(jaccard, "_met_in", counted)
    rng = np.random.default_rng(11)
    texts = []
    for i in range(240):
        words = [f"w{j}" for j in range(150)]
        for j in rng.choice(150, rng.integers(1, 6), replace=False):
            words[j] = f"u{rng.integers(0, 10**9)}"
        texts.append((i, " ".join(words)))
    found = jaccard.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(texts)
    assert rows and 4 * sum(rows) < len(texts) * (len(texts) - 1) // 2, rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3000), unique=True, max_size=80), min_size=2, max_size=4))
def test_sets_differ_in_at_least_as_many_members_as_in_parities(sets):
    bits = jaccard.parities([np.array(s, np.uint64) for s in sets])
    assert bits.shape == (len(sets), jaccard.PARITIES)
    for x, row in zip(sets, bits, strict=True):
        for y, other in zip(sets, bits, strict=True):
            assert sum(int(w).bit_count() for w in (row ^ other).view(np.uint64)) <= len({*x} ^ {*y})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=12), st.integers(0, 20), st.data())
def test_classes_that_link_share_items_of_each_prefix(weights, own, data):
    """Whatever a class misses, if it is no more than a link allows: l of its l-prefix's items are left."""
    n = own + sum(weights)
    slack = n - -(-75 * n // 100)
    depth, most = jaccard.depths(weights, own, slack)
    missing, at = own, set()
    for i in data.draw(st.permutations(range(len(weights)))):
        if missing + weights[i] <= slack:
            missing, at = missing + weights[i], at | {i}
    if own <= slack:
        for level in range(1, most + 1):
            assert sum(0 < d <= level for i, d in enumerate(depth) if i not in at) >= level


def test_long_words_that_a_polynomial_hash_confuses(spark):
    """The word of 2^k letters in the order of Thue and Morse, and its complement."""
    rows = []
    for k in (10, 11):
        word = "a"
        for _ in range(k):
            word += word.translate(str.maketrans("ab", "ba"))
        rows += [(len(rows), word), (len(rows) + 1, word.translate(str.maketrans("ab", "ba")))]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(i, i) for i in range(4)]


def test_rows_of_one_key_are_one_document(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(5, one), (5, other), (3, one), (9, other), (7, None), (5, one), (8, one + " more")]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(3, 36, 3), (5, 36, 3), (5, 36, 3), (5, 36, 3), (7, 0, 7), (8, 37, 3), (9, 36, 3)]


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=60))
def test_longest_previous_factors(text):
    """Against comparing each suffix with every earlier one."""

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    order = sorted(range(len(text)), key=lambda i: text[i:])
    steps = np.array([0, *(common(i, j) for i, j in zip(order[:-1], order[1:], strict=True))][: len(order)], np.int64)
    found = suffix_dedup.longest_previous_factors(np.array(order, np.int64), steps)
    assert found.tolist() == [max((common(i, j) for j in range(i)), default=0) for i in order]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=40), min_size=1, max_size=8), st.data())
def test_later_windows(parts, data):
    """Windows of parts of several documents that may overlap, against comparing all of them."""
    length = 8
    keys = np.array(data.draw(st.lists(st.integers(0, 2), min_size=len(parts), max_size=len(parts))), np.int64)
    whole = {k: "".join(p for p, q in zip(parts, keys.tolist(), strict=True) if q == k) for k in set(keys.tolist())}
    starts = [data.draw(st.integers(0, len(whole[k]) - len(p))) for p, k in zip(parts, keys.tolist(), strict=True)]
    pieces = [whole[k][s : s + len(p)].encode() for p, s, k in zip(parts, starts, keys.tolist(), strict=True)]
    groups = np.array(data.draw(st.lists(st.integers(0, 1), min_size=len(parts), max_size=len(parts))), np.int64)
    part, within = suffix_dedup.later_windows(pieces, keys, np.array(starts, np.int64), groups, length)
    windows = [(int(groups[i]), p[a : a + length], (int(keys[i]), starts[i] + a), (i, a)) for i, p in enumerate(pieces) for a in range(len(p) - length + 1)]
    want = {w[3] for w in windows if any(v[:2] == w[:2] and v[2] < w[2] for v in windows)}
    assert set(zip(part.tolist(), within.tolist(), strict=True)) == want


def test_no_documents(nothing):
    assert jaccard.near_duplicates(nothing).count() == 0
    assert suffix_dedup.remove_repeated(nothing).count() == 0
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    assert quality.measure(nothing).count() == 0


def test_repeated_bytes(documents, pairs):
    want = brute.repeated_bytes(pairs)
    found = suffix_dedup.remove_repeated(documents).collect()
    assert len(found) == len(pairs) + 2
    for r in found:
        if r.doc_id is None:
            assert (r.n_removed, r.n_spans, r.kept.decode()) == (0, 0, r.text)
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) == want[r.doc_id], r.doc_id
    texts = suffix_dedup.drop_repeated(documents)
    assert texts.columns == documents.columns and texts.count() == len(found)
    assert texts.where("doc_id IS NOT NULL AND text IS NULL").count() == 1


def test_repeated_rows_beside_each_other_keep_their_text(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string").coalesce(1)
    assert sorted((r.doc_id, r.text) for r in suffix_dedup.drop_repeated(docs).collect()) == [(1, text), (1, text), (2, "")]


def test_crowded_groups_go_by_windows():
    """The same spans whether parts that meet are put in suffix order or dealt by window."""
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("ab"), 70)) + "same passage of text " * 6 + "".join(rng.choice(list("cd"), 50)) for _ in range(40)]
    rows = sorted((1, i, 0, t.encode()) for i, t in enumerate(texts))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([0] * len(rows)), pa.array([len(r[3]) for r in rows]), pa.array([r[3] for r in rows], pa.binary())],
        names=["sub", "key", "start", "end", "part"],
    )

    def covered(most):
        made = pa.Table.from_batches(suffix_dedup._ordered(iter([batch]), 100, most)).to_pylist()
        made.sort(key=lambda r: (r["known"], r["p"], r["key"], r["start"]))
        batches = pa.Table.from_pylist(made, pa.schema([("p", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("known", pa.bool_())])).to_batches(max_chunksize=7)
        spans = [r for b in suffix_dedup._settled(iter(batches)) for r in b.to_pylist()]
        return {(r["key"], x) for r in spans for x in range(r["start"], r["end"])}

    want = brute.repeated_bytes(list(enumerate(texts)))
    for most in (2000, 7):
        found = covered(most)
        assert [sum(1 for k, _ in found if k == i) for i in range(len(texts))] == [want[i][1] for i in range(len(texts))]


def test_line_dedup_and_quality_against_sql(spark, documents, duck_documents):
    once = documents.where("doc_id IS NOT NULL").dropDuplicates()
    cleaned = line_dedup.drop_repeated_lines(once, min_words=line_dedup.MIN_WORDS)
    assert cleaned.columns == [*once.columns, "n_lines", "n_removed_lines"]
    digest = cleaned.selectExpr("doc_id", "n_lines", "n_removed_lines", "sha2(text, 256) AS kept_sha256")
    assert compare(digest, duck_documents, line_dedup.checking_sql())[1] == []
    measured = quality.measure(once)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert compare(measured.select(columns), duck_documents, quality.checking_sql())[1] == []
    assert quality.clean(once).columns == once.columns


@pytest.fixture()
def duck_documents(pairs):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs)
    return con


def test_later_runs_of_lines_go(spark):
    rows = [(1, "A b\nC d\nE f\nG h"), (2, "new\n C d \nE f\nG h\nlast"), (3, "A b\nC d\nother"), (4, "z\n" + "w " * 130), (5, "y\n" + "w " * 130), (None, "A b\nC d\nE f")]
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: rows[0][1], 2: "new\nlast", 3: rows[2][1], 4: rows[3][1], 5: "y", None: rows[5][1]}


def test_short_lines_shared_by_many_documents_go(spark, documents, pairs):
    """A line of some words goes between unlike neighbours too; so does a run of two, and a line without spaces. Few words stay."""
    shared, pair, unspaced = "All our news by mail on every single morning.", ["Sign up here now", "and miss no more news"], "\u5b57\u6f22\u8a9e\u6587" * 5
    rows = []
    for i in range(30):
        lines = [f"Top of number {i} that has words of its own", f"more {i}"]
        lines.insert(1, shared) if i % 3 == 0 else None
        lines += [*pair, f"end {i}"] if i % 3 == 1 else []
        lines += [unspaced, f"end {i}", "Read on."] if i % 3 == 2 else []
        rows.append((i, "\n".join(lines)))
    found = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=8).collect()}
    later = {0: [shared], 1: pair, 2: [unspaced]}
    assert found == {i: t if i < 3 else "\n".join(x for x in t.split("\n") if x not in later[i % 3]) for i, t in rows}
    spaced = [(i, t) for i, t in pairs if "\u5b57" not in (t or "")]
    cleaned = line_dedup.drop_repeated_lines(documents.where("doc_id IS NOT NULL AND (text IS NULL OR NOT text LIKE '%\u5b57%')"), min_words=8)
    want = brute.repeated_lines(spaced)
    assert {r.doc_id: r.text for r in cleaned.collect()} == {i: None if t is None else "\n".join(want[i]) for i, t in spaced}


def test_line_stage_of_the_pipeline_drops_short_shared_lines(spark):
    rows = [(i, f"own {i}\nThe very same line of eight words here.\nother {i}", 9) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, "").collect()}
    assert found == {i: t if i == 0 else f"own {i}\nother {i}" for i, t, _ in rows}


def test_short_lines_of_any_script_against_sql(spark):
    """Lines and short runs around the limits of words and characters, shared by many documents in other company."""
    import duckdb

    rng = np.random.default_rng(17)
    words = ["word", "größer", "niño", "мир", "字字", "かな漢字", "ไทย", "x", "42", "…", "a-b", "ﾊﾝ", "한국어"]
    lines = [" ".join(rng.choice(words, n)) for n in rng.integers(1, 14, 40)]
    lines += ["字" * n for n in (7, 8, 14, 15, 16, 17)] + ["a  b\tc d e f g h", "a b c d e f g", "y" * 249, "y" * 250]
    rows = [(i, "\n".join(rng.choice(lines + [f"own {i} {j}" for j in range(20)], rng.integers(1, 9)))) for i in range(120)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cleaned = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=line_dedup.MIN_WORDS)
    digest = cleaned.selectExpr("doc_id", "n_lines", "n_removed_lines", "sha2(text, 256) AS kept_sha256")
    assert compare(digest, con, line_dedup.checking_sql())[1] == []
    assert cleaned.where("n_removed_lines > 0").count() > 60


def test_quality_rules(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(12))
    menu = "\n".join(f"Home{i} | News{i} | Sport{i} | More{i} | Contact{i}" for i in range(30))
    rows = [(1, good), (2, menu), (3, good + "\n" + menu), (4, "too short."), (5, None), (6, good + "\nAll rights reserved.")]
    found = {r.doc_id: (r.base_failed, r.kept) for r in quality.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (False, True), 2: (False, False), 3: (False, False), 4: (True, False), 5: (True, False), 6: (False, True)}


def test_native_operators_run_no_python(documents):
    for frame in (line_dedup.drop_repeated_lines(documents, min_words=8), quality.measure(documents)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_some_rounds_of_components_join_linked_nodes_only(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)], "a long, b long")
    some = {r.id: r.component for r in components(links, 1).collect()}
    assert set(some) == {*range(41), *range(100, 120)}
    assert all(c <= 40 for i, c in some.items() if i <= 40) and {some[i] for i in range(100, 120)} == {100}


def test_texts_of_no_class_are_not_shuffled(spark):
    """Of 4,000 texts, of which 40 are of a class, few reach the join that finds the class."""
    words = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(4000)]
    docs = spark.createDataFrame([*enumerate(words), (None, words[0]), (100, "another text of a key"), (100, words[100])], "id long, text string")
    sets = jaccard.set_sizes(docs.where("id IS NOT NULL"), 5)
    classes = sets.where("id % 100 = 0 AND n = 5").distinct().withColumnRenamed("id", "rep").withColumn("node", jaccard.F.col("rep") + 7)
    marks = jaccard._marks(classes.select(jaccard.F.col("rep").alias("id")))
    assert 30 <= np.unpackbits(marks).sum() <= 40 and len(marks) * 8 >= 16 * 40
    joined = jaccard.class_texts(docs, classes, 5)
    assert {(r.node, r.text) for r in joined.collect()} == {(i + 7, words[i]) for i in range(0, 4000, 100)} and joined.count() == 40
    seen = joined._jdf.queryExecution().analyzed().toString()
    assert seen.index("Join") < seen.index("MapInArrow"), "texts pass the marks before they are joined"


def test_lists_meet_in_one_join_with_stuck_classes_looked_for(spark):
    """All of a short list meet; in a long one only pairs with a class that cannot be dealt out."""
    rows = [("s", i, False, False) for i in (1, 2, 3)] + [("l", i, True, i in (11, 12)) for i in (11, 12, 13, 14)]
    frame = spark.createDataFrame(
        [(x, x == "l" and 14 or 3, i, 10, i, 10, None, [0] * jaccard.PARITIES, long, stuck) for x, i, long, stuck in rows],
        "list string, largest long, node long, n int, component long, rest long, before long, bits array<long>, long boolean, stuck boolean",
    )
    met = jaccard._met_in(frame, 75)
    assert {(r.a, r.b) for r in met.collect()} == {(1, 2), (1, 3), (2, 3), (11, 12), (11, 13), (11, 14), (12, 13), (12, 14)}
    assert met._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1


def test_a_class_tries_the_hub_most_alike(spark):
    """Of an item's hubs, the one with the fewest differing parities is tried, and none of the class's own component."""
    zeros, far = [0] * jaccard.PARITIES, [(1 << 62) - 1] * jaccard.PARITIES
    prefix = spark.createDataFrame([(i, 5, 1) for i in (1, 2, 3, 9)], "node long, item long, depth int")
    labelled = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (9, 9)], "node long, component long")
    texts = spark.createDataFrame([(1, 400, far), (2, 400, zeros), (3, 400, far), (9, 400, zeros)], "node long, n int, bits array<long>")
    found = {(r.a, r.b) for r in jaccard._likely_pairs(prefix, labelled, texts, 75).collect()}
    assert found <= {(9, 2)}
