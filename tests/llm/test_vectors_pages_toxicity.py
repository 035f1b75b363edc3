"""Vectors and pages against plain versions; the classifier by held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import brute
from bench import shuffled_bytes
from yieldline.llm import html, pigeonhole, toxicity


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    d = 20
    x = rng.normal(size=(250, d))
    near = x[rng.integers(0, 30, 150)] + rng.normal(size=(150, d)) * rng.choice([0.1, 0.2, 0.24, 0.3], size=(150, 1))
    hot = x[40] + rng.normal(size=(120, d)) * 0.12
    return np.concatenate([x, near, hot, np.repeat(x[50:51], 60, 0)]).astype(np.float32)


def test_near_vectors(spark, vectors, monkeypatch):
    n, d = vectors.shape
    rows = [(i, [float(v) for v in x], 0, 1) for i, x in enumerate(vectors)]
    odd = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [1.0, None] + [0.0] * (d - 2), [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, v, None, 1) for i, v in enumerate(odd)] + [(None, [1.0] * d, 1, 1), rows[0]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component long")
    unit = vectors.astype(float) / np.sqrt((vectors.astype(float) ** 2).sum(1))[:, None]
    linked = (unit[:, None, :] * unit[None]).sum(2) >= 0.95
    np.fill_diagonal(linked, False)
    label = brute.least_reachable(range(n), np.argwhere(linked).tolist())
    for cell, chunk in ((3000, 6000), (40, 25)):
        monkeypatch.setattr(pigeonhole, "PER_CELL", cell)
        monkeypatch.setattr(pigeonhole, "CHUNK", chunk)
        found = pigeonhole.near_vectors(frame).collect()
        assert len(found) == len(rows)
        for r in found:
            if r.vec_id is None:
                assert (r.n_links, r.component_id, r.kept) == (0, None, False)
            elif r.vec_id < n:
                assert (r.n_links, r.component_id, r.kept) == (linked[r.vec_id].sum(), label[r.vec_id], label[r.vec_id] == r.vec_id)
            elif r.vec_id < n + 6:
                assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
            else:
                assert (r.n_links, r.component_id) == (1, n + 6)
    assert pigeonhole.near_vectors(frame.limit(0)).count() == 0


def test_a_vector_is_sent_for_each_other_chunk_and_not_for_each_cell(spark, monkeypatch):
    x = np.random.default_rng(9).normal(size=(4000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    sent, kept = [], pigeonhole.stored

    def measured(rows, label):
        if label == "found":
            rows.collect()
            sent.append(shuffled_bytes(rows))
        return kept(rows, label)

    monkeypatch.setattr(pigeonhole, "stored", measured)
    assert pigeonhole.near_vectors(frame).count() == 4000
    assert 0 < sent[0] < 8 * x.nbytes


def test_every_near_pair_meets_in_a_cell():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24))
    y = x + rng.normal(size=x.shape) * 0.2
    turned = [np.round(pigeonhole._unit(v) @ pigeonhole.rotation(24) * pigeonhole.SCALE).astype(np.int64) for v in (x, y)]
    limits = pigeonhole.budgets(24, 0.95)
    for bits in (0, 3, 8, 11):
        for b, budget in enumerate(limits):
            part = [t[:, 8 * b : 8 * b + 8] for t in turned]
            near = ((part[0] - part[1]) ** 2).sum(axis=1) <= budget
            cells = [set(zip(*(v.tolist() for v in pigeonhole.reached(p, 24, bits, budget)[:2]))) for p in part]
            for i in np.flatnonzero(near).tolist():
                assert {c for r, c in cells[0] if r == i} & {c for r, c in cells[1] if r == i}


def test_minimum_cut_is_minimal():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 7)
        costs = [round(rng.uniform(-2, 2), 2) for _ in range(n)]
        edges = [(a, b, round(rng.uniform(0, 1.5), 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]

        def total(label):
            own = sum(max(-c, 0) if y else max(c, 0) for c, y in zip(costs, label))
            return own + sum(c for a, b, c in edges if label[a] != label[b])

        best = min(total(label) for label in itertools.product([True, False], repeat=n))
        assert abs(total(html.labelled(costs, edges)) - best) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home"><header><h1>Site</h1><a href=/>Home</a></header>
<div id="cookie-notice">We use cookies.</div><div class="wrap"><main><article><header><h1>Title</h1></header><p>First with <a href=x>link</a> &amp; more &lt;b&gt;.
<div class="advert">Buy now!</div><p><b>Second   para<br>goes&nbsp;on.<p>x<ul><li>one item<li>two items</ul><aside>Related stuff.</aside><form>Name <input></form>
<table><tr><td>a<td>b</table><section id="comments"><h2>Comments</h2><p>I like this article, it is a great one. Thanks.</p></section></article></main>
<div class=sidebar><ul><li><a href=1>A</a></ul></div></div><footer>&copy;</footer><script>var a="<p>no</p>"</script>"""


def test_main_text():
    assert html.main_text(PAGE) == "Title\nFirst with link & more <b>.\nSecond para goes on.\nx\none item\ntwo items\na\nb"
    for odd in ("", "<", "<p", "<!-- open", "<script>x", "<p><p></p></div></p>", "&amp"):
        html.main_text(odd)
    assert html.main_text("<nav>only a menu</nav>") == ""
    long_page = "<article>" + "<p>A paragraph of text that goes on for a while.</p>" * 5000 + "</article>"
    assert html.main_text(long_page).count("\n") == 4999


WRAPPERS = ["content no-sidebar", "main-content has-sidebar", "wrapper with-sidebar", "post type-post category-social", "container menu-open", "post-body comments-open", "widget Blog"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_names_of_wrappers_are_no_veto(name):
    lines = [f"Paragraph {i} tells a part of the story in a sentence, long enough to be read as one, and it goes on for some more words." for i in range(4)]
    text = "".join(f"<p>{x}</p>" for x in lines)
    around = "<div class=site-footer><a href=/>Home</a> <a href=/a>About</a></div><div class=comments><p>Great text, I liked it.</p></div>"
    assert html.main_text(f"<body><div class='{name}'>{text}</div>{around}</body>") == "\n".join(lines)
    assert html.main_text(f"<body><article><div class='{name}'>{text}</div></article>{around}</body>") == "\n".join(lines)


def test_names_of_boilerplate_still_count():
    prose = " ".join(["We use your answers to improve what we offer, and you agree to it by reading on."] * 3)
    for name in ("cookie-notice", "comments-area", "advert", "sponsored", "newsletter-box", "post-comments"):
        assert html.main_text(f"<article><p>{prose} First.</p><div class='{name}'><p>{prose}</p></div><p>{prose} Last.</p></article>") == f"{prose} First.\n{prose} Last."
    for name in ("sidebar", "site-footer", "main-nav", "related-posts", "share"):
        assert html.main_text(f"<article><p>{prose}</p><div class='{name}'><a href=1>Other page</a></div></article>") == prose


def test_long_names_take_no_time():
    assert html.main_text(f"<article><p class='{'menu_' * 5000}!'>Text.</p></article>") == "Text."


def test_formulas_listings_and_fallbacks_stay():
    more = "and the sentence goes on after it with some words."
    for inner, text in (
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn></math>", "x=1"),
        ("<object data=a.swf><param name=a>what it showed</object>", "what it showed"),
        ("<noembed>what it showed</noembed>", "what it showed"),
        ("<svg><text>No</text></svg>", ""),
        ("<template><p>No.</p></template>", ""),
        ("<svg><foreignObject><div>No.</div></foreignObject></svg>", ""),
    ):
        assert html.main_text(f"<article><p>Here is {inner} {more}</p></article>") == " ".join(f"Here is {text} {more}".split())
    listing = html.main_text("<article><p>Listing of a page follows here.</p><xmp>if a<b && c: &amp; <p>markup</p></xmp><p>And this is the end of it.</p></article>")
    assert listing == "Listing of a page follows here.\nif a<b && c: &amp; <p>markup</p>\nAnd this is the end of it."
    assert html.main_text("<frameset><noframes><p>A page without frames.</p></noframes></frameset>" + f"<p>Then {more}</p>").startswith("A page without frames.")


@pytest.mark.parametrize("name", ["svg", "math", "object", "template"])
def test_unclosed_elements_end_at_the_next_block(name):
    rest = "<p>This paragraph comes after it and stays.</p><p>So does the other one, of course.</p>"
    want = "This paragraph comes after it and stays.\nSo does the other one, of course."
    assert html.main_text(f"<article><p><{name}>{rest}</article>") == want
    if name != "template":
        assert html.main_text(f"<article><p><{name}>{rest}<p><{name}></{name}></p></article>") == want


def test_extract_keeps_rows_and_columns(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, None, None, None), (3, "v", "", 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, block long")
    found = html.extract(frame)
    assert found.columns == [*frame.columns, "text"]
    assert sorted(r.text for r in found.collect()) == ["", "", html.main_text(PAGE), html.main_text(PAGE)]
    assert html.extract(frame.limit(0)).count() == 0


def labelled_rows(n=700):
    rng = np.random.default_rng(9)
    plain = [f"word{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        words = [plain[j] for j in rng.integers(0, 3000, rng.integers(5, 120))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(["idiot", "scum", "you stupid"])))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = labelled_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "idiot", "x"), (-1, None, "x"), (-2, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (10**6, 1), (3, None)], "doc_id long, toxic int")
    network = toxicity.train(docs, labels)
    assert network == toxicity.train(docs.repartition(7), labels.repartition(3))
    found = toxicity.score(docs, network)
    assert found.columns == ["doc_id", "text", "score"] and dict(found.dtypes)["score"] == "double"
    scores = {r.doc_id: r.score for r in found.collect()}
    assert len(scores) == len(rows) + 3 and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[i] >= toxicity.THRESHOLD, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = sum(p == bool(y) for p, y in held) / len(held)
    assert right > 0.95
    assert scores[-1] == scores[-2]
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """Each word is in two documents only: the network knows it if it learns from both of them."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 2000)
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    n = 14000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', translate(cast(id div 2 AS string), '0123456789', 'abcdefghij')) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "cast(id % 5 = 0 AS int) AS toxic")
    network = toxicity.Network.from_bytes(toxicity.train(docs, labels))
    learnt = docs.where(~toxicity.held_out(docs.doc_id) & ~toxicity.calibrates(docs.doc_id))
    both = [r.text for r in learnt.groupBy("text").count().where("count = 2").collect()]
    assert learnt.count() > 6000
    assert np.array_equal(np.sort(toxicity.Words(pa.array(both)).hashes), network.known)


def test_blocks_of_a_shard_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 4)
    owners = [5] * 9 + [2] * 4 + [3]

    def blocks(size):
        rows = pa.table({"shard": pa.array(owners, pa.int32()), "y": list(range(14)), "words": [b""] * 14})
        return [(s, n, b.column(1).to_pylist()) for s, n, b in toxicity._blocks(iter(rows.to_batches(max_chunksize=size)))]

    want = [(5, 0, [0, 1, 2, 3]), (5, 1, [4, 5, 6, 7]), (5, 2, [8]), (2, 0, [9, 10, 11, 12]), (3, 0, [13])]
    assert all(blocks(size) == want for size in (1, 3, 5, 14))


def test_held_out_is_the_third_by_checksum(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    found = {r.doc_id: r.h for r in rows.select("doc_id", toxicity.held_out(rows.doc_id).alias("h")).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)} | {None: False}


def test_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.keep_clean(docs, none).count() == 2
    assert toxicity.score(docs.limit(0), toxicity.train(docs, none)).count() == 0


def test_network_bytes_round_trip():
    rows = labelled_rows(120)
    network = toxicity.fit(pa.array([t for _, t, _ in rows]), np.array([y for _, _, y in rows]), np.ones(len(rows)))
    words = toxicity.Words(pa.array(["you idiot", "", None, "plain"]))
    assert np.array_equal(network.scores(words), toxicity.Network.from_bytes(network.to_bytes()).scores(words))


def test_tags_are_evidence_that_an_article_outweighs():
    """An article inside a page-wide form, a dialog or something hidden, and remarks inside an article, are kept."""
    sentence = "This is a sentence of the article that goes on for a while, as such sentences do."
    text = f"<p>{' '.join([sentence] * 4)}</p>"
    menu = "<ul><li><a href=x>Home</a></li><li><a href=y>News</a></li><li><a href=z>Sport</a></li></ul>"
    for page in (
        f"<form id=aspnetForm>{menu}<article>{text * 3}</article></form>",
        f"<form id=aspnetForm>{menu}<div>{text * 3}</div></form>",
        f"<div role=dialog>{menu}<main>{text * 3}</main></div>",
        f"<div hidden><article>{text * 3}</article></div><div hidden>{text}</div>",
        f"<article>{text * 3}</article><form><label>Name</label><p>Your email address will not be published. Required fields are marked *</p>"
        "<button>Send</button></form>",
        f"<article>{text}<form><p>Subscribe to our letter</p><input></form>{text * 2}</article><aside>{menu}{text}</aside>",
    ):
        found = html.main_text(f"<body>{page}</body>")
        assert found.split("\n") == [" ".join([sentence] * 4)] * 3, page
    remark = "A long remark beside the story that belongs to it and is told in full sentences."
    page = f"<article>{text}<aside><p>{' '.join([remark] * 3)}</p></aside>{text}</article>"
    assert remark in html.main_text(page)


def test_trained_copies_are_sent_in_parts():
    rows = toxicity.SENT_ROWS * 2 + 5
    before, sums = np.zeros((rows, toxicity.DIMENSIONS), np.float32), np.ones((rows, toxicity.DIMENSIONS), np.float32)
    after, after_sums = before.copy(), sums.copy()
    after[[0, 7], 1], after_sums[rows - 1, 0] = 0.5, 2.0
    parts = list(toxicity._moves(before, after, sums, after_sums))
    assert [moved.tolist() for moved, _ in parts] == [[0, 7], [rows - 1]]
    values = np.concatenate([v for _, v in parts]) * toxicity.UNIT
    assert values[0, 1] == 0.5 and values[2, toxicity.DIMENSIONS] == 2.0 and values.dtype == np.float64
    assert max(len(moved) for moved, _ in toxicity._moves(before, after + 1, sums, after_sums)) == toxicity.SENT_ROWS


def test_training_passes_small_batches_and_puts_the_setting_back(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, epoch = spark.conf.get(name), toxicity._epoch

    def watched(*args):
        seen.append(int(spark.conf.get(name)))
        return epoch(*args)

    monkeypatch.setattr(toxicity, "_epoch", watched)
    docs = spark.createDataFrame([(i, "bad words here" if i % 2 else "good words there") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    toxicity.train(docs, labels)
    assert len(seen) == toxicity.EPOCHS and max(seen) <= toxicity.BLOCK_ROWS
    assert spark.conf.get(name) == before


def test_network_of_a_matrix_leaves_it_as_it_is():
    network = toxicity.Network(np.random.default_rng(1), np.arange(5, dtype=np.uint64))
    matrix = network.matrix()
    made = toxicity.Network.from_matrix(network.known, matrix)
    made.embeddings += 1
    assert np.array_equal(matrix, network.matrix()) and np.array_equal(made.filters[2], network.filters[2]) and made.bias == network.bias
