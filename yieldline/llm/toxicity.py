"""Toxicity by a small convolutional network over hashed word embeddings, trained in numpy.

Words (runs of letters, lower-cased) are hashed, and the hash finds their embedding; words that too few training documents
have share an empty one, so that no rare word can pass for another. Filters of one to three words slide over the whole
text, the largest response of each counts, and a logistic layer weighs them. Thresholds are calibrated for each language, which
is told from frequent words of the text itself, and scores are scaled so that every threshold lies at 0.7.

Every labelled document outside the held-out third is learnt from. They are dealt to shards by a hash of their key; in each
epoch every shard trains a copy of the network on all its documents, and the copies are averaged, each word's embedding over
the shards that moved it. Words are counted, and thresholds taken, over all shards. The network alone is held in one place.
Scoring is a map over all documents without a shuffle.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline.llm.columns import RangeHash, flat, give_back, runs, slices, word_hashes
from yieldline.llm.names import apart_from_input
from yieldline.llm.components import discard, stored

# Training documents of a shard, on average, and of a block, which a task holds at once and goes through in random order.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
# A word has an embedding of its own if so many training documents have it, and one in RAREST.
LEAST_DOCUMENTS, RAREST = 2, 100_000
DIMENSIONS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 8, 64, 0.05
# A word's first embedding value starts from its odds among toxic documents, with so many documents as prior.
PRIOR = 10.0
# One labelled document in so many is for thresholds, not for training, and the rows a language needs for its own threshold.
CALIBRATION_PART, CALIBRATION_LEAST = 4, 25
# Steps of a score's logit that are told apart by thresholds.
LOGIT_STEPS = 1024
# Copies are added up as whole numbers of this unit, so that the order of adding does not matter.
UNIT = 2.0**-24
THRESHOLD = 0.7
SLICE = 1 << 20
# Rows of a trained copy that a task sends at once.
SENT_ROWS = 8192
SEED = 7

# Frequent words by which a language is told.
FREQUENT = {
    "en": "the and of to is was that with for are this from",
    "de": "der die und das nicht von mit ein den dem auf ist",
    "fr": "le la les des est et une que pour dans sur pas",
    "es": "el los las y del una por con es su al lo",
}


class Words:
    """Hash of every word of a column, where each row begins, and the language of each row."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        wide = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) else np.empty(0, np.int64)
        low[wide[(data[wide] >= 0x80) & (data[wide] <= 0x9E) & (data[wide] != 0x97)]] += 32
        starts, ends = runs(((low >= 97) & (low <= 122)) | (low >= 128), offsets)
        self.hashes = word_hashes(low, starts, ends)
        self.offsets = np.searchsorted(starts, offsets)
        votes = np.stack([self._count(np.isin(self.hashes, known)) for known in _frequent().values()], axis=1)
        self.language = votes.argmax(axis=1)

    def _count(self, hit: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(hit)])[self.offsets])


_known: dict[str, np.ndarray] = {}


def _frequent() -> dict[str, np.ndarray]:
    if not _known:
        for language, words in FREQUENT.items():
            data, offsets = flat(pa.array(words.split()))
            _known[language] = RangeHash(data)(offsets[:-1], offsets[1:])
    return _known


class Network:
    """Known words (sorted hashes), embeddings, filters by width, output layer, and a threshold for each language.

    Embedding 0 is that of all other words; it stays empty.
    """

    def __init__(self, rng: np.random.Generator, known: np.ndarray):
        self.known = known
        self.embeddings = rng.normal(0, 0.1, (len(known) + 1, DIMENSIONS)).astype(np.float32)
        self.embeddings[0] = 0
        self.filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        for w, f in zip(WIDTHS, self.filters, strict=True):
            f[:, 0, :] = np.abs(f[:, 0, :]) + 1.0 / w
        self.shift = [np.full(FILTERS, -0.5, np.float32) for _ in WIDTHS]
        self.weights = np.full(FILTERS * len(WIDTHS), 1.0 / (FILTERS * len(WIDTHS)), np.float32)
        self.bias = np.float32(-2.0)
        self.thresholds = np.full(len(FREQUENT), 0.5)

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        """Embedding of each word."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0)

    def responses(self, rows: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """By width: the response of each filter at each word, -inf where the window leaves the row."""
        vectors = self.embeddings[rows]
        for width, f, shift in zip(WIDTHS, self.filters, self.shift, strict=True):
            out = np.full((len(rows), FILTERS), -np.inf, np.float32)
            n = len(rows) - width + 1
            if n > 0:
                out[:n] = shift + sum(vectors[j : n + j] @ f[j] for j in range(width))
                for j in range(1, width):
                    cut = offsets[1:] - j
                    out[cut[cut >= offsets[:-1]]] = -np.inf
            yield out

    def logits(self, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log odds of each row before calibration. A row without words has empty responses."""
        pooled = np.zeros((len(offsets) - 1, len(self.weights)), np.float32)
        filled = np.flatnonzero(np.diff(offsets))
        if len(filled):
            for i, out in enumerate(self.responses(rows, offsets)):
                most = np.maximum.reduceat(out, offsets[filled], axis=0)
                pooled[filled, i * FILTERS : (i + 1) * FILTERS] = np.maximum(most, 0)
        return pooled.astype(np.float64) @ self.weights + self.bias

    def raw(self, rows: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows, offsets))

    def scores(self, words: Words) -> np.ndarray:
        """Probabilities scaled so that a language's threshold becomes THRESHOLD."""
        raw, at = self.raw(self.rows_of(words.hashes), words.offsets), self.thresholds[words.language]
        below, above = THRESHOLD * raw / at, THRESHOLD + (1 - THRESHOLD) * (raw - at) / (1 - at)
        return np.clip(np.where(raw < at, below, above), 0.0, 1.0)

    def matrix(self) -> np.ndarray:
        """All that is trained, in rows of DIMENSIONS: an embedding each, then the other values one after the other."""
        return _rows_of_values(self.embeddings, [*self.filters, *self.shift, self.weights, np.atleast_1d(self.bias)])

    def take(self, matrix: np.ndarray) -> None:
        values = _values_of_rows(matrix, len(self.embeddings))
        self.embeddings, n = values["embeddings"], range(len(WIDTHS))
        self.filters, self.shift = [values[f"filter{i}"] for i in n], [values[f"shift{i}"] for i in n]
        self.weights, self.bias = values["weights"], values["bias"][0]

    @classmethod
    def from_matrix(cls, known: np.ndarray, matrix: np.ndarray) -> Network:
        """Of a `matrix`, which stays as it is."""
        made = cls.__new__(cls)
        made.known, made.embeddings, made.thresholds = known, matrix[: len(known) + 1], np.full(len(FREQUENT), 0.5)
        made.take(matrix)
        return made

    def to_bytes(self) -> bytes:
        file = io.BytesIO()
        np.savez_compressed(
            file,
            known=self.known,
            embeddings=self.embeddings,
            weights=self.weights,
            bias=self.bias,
            thresholds=self.thresholds,
            **{f"filter{i}": f for i, f in enumerate(self.filters)},
            **{f"shift{i}": s for i, s in enumerate(self.shift)},
        )
        return file.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Network:
        made, file = cls.__new__(cls), np.load(io.BytesIO(data))
        made.known, made.embeddings, made.weights, made.bias, made.thresholds = (
            file[k] for k in ("known", "embeddings", "weights", "bias", "thresholds")
        )
        made.filters = [file[f"filter{i}"] for i in range(len(WIDTHS))]
        made.shift = [file[f"shift{i}"] for i in range(len(WIDTHS))]
        return made


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


SHAPES = {
    **{f"filter{i}": (w, DIMENSIONS, FILTERS) for i, w in enumerate(WIDTHS)},
    **{f"shift{i}": (FILTERS,) for i in range(len(WIDTHS))},
    "weights": (FILTERS * len(WIDTHS),),
    "bias": (1,),
}


def _rows_of_values(embeddings: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    flat_others = np.concatenate([x.ravel() for x in others])
    filled = np.pad(flat_others, (0, -len(flat_others) % DIMENSIONS))
    return np.concatenate([embeddings, filled.reshape(-1, DIMENSIONS)]).astype(np.float32)


def _values_of_rows(matrix: np.ndarray, words: int) -> dict[str, np.ndarray]:
    values, rest = {"embeddings": matrix[:words].copy()}, matrix[words:].ravel()
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        values[name], rest = rest[:size].reshape(shape).copy(), rest[size:]
    return values


def _counts(hashes: np.ndarray, offsets: np.ndarray, toxic: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of `least` documents or more, and how many clean and toxic documents have each."""
    known, at = np.unique(hashes, return_inverse=True)
    pairs = np.unique(np.repeat(np.arange(len(toxic)), np.diff(offsets)) * len(known) + at) if len(known) else at
    word, label = pairs % max(len(known), 1), toxic[pairs // max(len(known), 1)]
    counts = [np.bincount(word[label == y], minlength=len(known)) for y in (0, 1)]
    often = counts[0] + counts[1] >= least
    return known[often], counts[0][often], counts[1][often]


def fit(texts: pa.Array, toxic: np.ndarray, weights: np.ndarray) -> Network:
    """Train on whole texts that one task holds; `weights` are how many documents a row stands for (calibration only)."""
    rng = np.random.default_rng(SEED)
    if not len(toxic) or toxic.min() == toxic.max():
        return _of_one_class(bool(len(toxic) and toxic[0]))
    words = Words(texts)
    held = rng.random(len(toxic)) < 1 / CALIBRATION_PART
    train = np.flatnonzero(~held)
    spans = list(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True))

    def texts_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [words.hashes[spans[i][0] : spans[i][1]] for i in chosen.tolist()]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate(parts) if parts else np.empty(0, np.uint64), offsets

    network = _untrained(rng, *_counts(*texts_of(train), toxic[train], LEAST_DOCUMENTS), toxic[train].mean())
    place = network.rows_of(words.hashes)

    def rows(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [place[spans[i][0] : spans[i][1]] for i in chosen.tolist()]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate(parts) if parts else np.empty(0, np.int64), offsets

    state: dict = {}
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for first in range(0, len(order), BATCH):
            chosen = order[first : first + BATCH]
            _step(network, *rows(chosen), toxic[chosen].astype(np.float32), state)
    if held.any():
        raw = network.raw(*rows(np.flatnonzero(held)))
        _calibrate(network, raw, raw, toxic[held], weights[held], words.language[held])
    return network


def _of_one_class(toxic: bool) -> Network:
    """The same score for every text."""
    network = Network(np.random.default_rng(SEED), np.empty(0, np.uint64))
    network.weights[:] = 0
    network.bias = np.float32(20.0 if toxic else -20.0)
    return network


def _untrained(rng: np.random.Generator, known: np.ndarray, clean: np.ndarray, bad: np.ndarray, share: float) -> Network:
    """A network for words that so many clean and toxic documents have, where a `share` of the documents is toxic."""
    network = Network(rng, known)
    odds = (bad + PRIOR * share) / (clean + PRIOR * (1 - share)) * (1 - share) / max(share, 1e-9)
    network.embeddings[1:, 0] = np.log(np.maximum(odds, 1e-9))
    return network


def _scaled(state: dict, name: str, gradient: np.ndarray) -> np.ndarray:
    seen = state.setdefault(name, np.full_like(gradient, 1e-2))
    seen += gradient**2
    return RATE * gradient / np.sqrt(seen)


def _step(network: Network, words: np.ndarray, offsets: np.ndarray, toxic: np.ndarray, state: dict) -> None:
    """One step of AdaGrad. The largest response alone passes a gradient to its window."""
    filled = np.flatnonzero(np.diff(offsets))
    pooled = np.zeros((len(toxic), len(network.weights)), np.float32)
    places = []
    for i, out in enumerate(network.responses(words, offsets)):
        at = np.stack([out[offsets[r] : offsets[r + 1]].argmax(axis=0) + offsets[r] for r in filled]) if len(filled) else np.empty((0, FILTERS), np.int64)
        best = np.take_along_axis(out, at, axis=0) if len(filled) else np.empty((0, FILTERS), np.float32)
        pooled[filled, i * FILTERS : (i + 1) * FILTERS] = np.maximum(best, 0)
        places.append(at)
    error = (_sigmoid(pooled @ network.weights + network.bias) - toxic).astype(np.float32) / len(toxic)
    back = error[:, None] * network.weights * (pooled > 0)
    touched, moves = [], []
    for i, (width, f) in enumerate(zip(WIDTHS, network.filters, strict=True)):
        g = back[filled, i * FILTERS : (i + 1) * FILTERS]
        q = np.minimum(places[i], max(len(words) - width, 0))
        slope = np.zeros_like(f)
        for j in range(width):
            word = words[q + j] if len(words) >= width else np.zeros_like(q)
            slope[j] = np.einsum("ncd,nc->dc", network.embeddings[word], g)
            touched.append(word.ravel())
            moves.append((g[..., None] * f[j].T[None]).reshape(-1, DIMENSIONS))
        f -= _scaled(state, f"filter{i}", slope)
        network.shift[i] -= _scaled(state, f"shift{i}", g.sum(axis=0))
    network.weights -= _scaled(state, "weights", pooled.T @ error)
    network.bias -= _scaled(state, "bias", np.atleast_1d(error.sum()))[0]
    used, place = np.unique(np.concatenate(touched), return_inverse=True)
    slope = np.zeros((len(used), DIMENSIONS), np.float32)
    np.add.at(slope, place, np.concatenate(moves))
    slope[used == 0] = 0
    seen = state.setdefault("embeddings", np.full_like(network.embeddings, 1e-2))
    seen[used] += slope**2
    network.embeddings[used] -= RATE * slope / np.sqrt(seen[used])


def _calibrate(
    network: Network, least: np.ndarray, most: np.ndarray, toxic: np.ndarray, weights: np.ndarray, language: np.ndarray
) -> None:
    """Each language's threshold: the middle of the best interval by F1, or the one of all rows if it has few.

    A row stands for so many documents as it weighs, whose probabilities lie between `least` and `most`.
    """

    def best(chosen: np.ndarray) -> float:
        order = np.argsort(-least[chosen], kind="stable")
        p, y, w = least[chosen][order], toxic[chosen][order], weights[chosen][order]
        hit, all_ = np.cumsum(w * y), np.cumsum(w)
        f1 = 2 * hit / (all_ + (w * y).sum())
        f1[:-1][p[:-1] == p[1:]] = -1
        i = int(np.argmax(f1))
        after = most[chosen][order][i + 1] if i + 1 < len(p) else 0.0
        return float(np.clip((p[i] + after) / 2, 1e-6, 1 - 1e-6))

    everything = np.ones(len(least), bool)
    shared = best(everything) if toxic.any() else 0.5
    for i in range(len(FREQUENT)):
        own = language == i
        enough = min((weights * toxic)[own].sum(), (weights * (1 - toxic))[own].sum()) >= CALIBRATION_LEAST
        network.thresholds[i] = best(own) if enough else shared


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt. Never null."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def calibrates(key: Column) -> Column:
    """Labelled rows that thresholds are taken from and nothing else is."""
    return F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(CALIBRATION_PART)) == 0


def _hashed(labelled: DataFrame) -> DataFrame:
    """key, y, language, words: the hashes of every word of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            words = Words(batch.column(2))
            ends = pa.py_buffer((words.offsets * 8).astype(np.int32))
            hashes = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(words.hashes)])
            language = pa.array(words.language.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), language, hashes], names=["key", "y", "language", "words"])

    rows = labelled.select("key", "y", "text")
    return rows.mapInArrow(work, rows.drop("text").withColumns({"language": F.lit(0), "words": F.lit(b"")}).schema)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column of `_hashed`, and where each row begins."""
    data, offsets = flat(column)
    return np.frombuffer(data.tobytes(), np.uint64), offsets // 8


def _word_counts(rows: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of words that `least` documents have, and how many clean and toxic ones have each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words", SLICE):
            known, clean, bad = _counts(*_words(batch.column(1)), batch.column(0).to_numpy(), 1)
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(clean), pa.array(bad)], names=["word", "clean", "bad"])

    counts = rows.select("y", "words").mapInArrow(work, "word long, clean long, bad long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")).where(F.col("clean") + F.col("bad") >= least)
    word, clean, bad = (c.to_numpy() for c in counts.toArrow().columns)
    order = np.argsort(word.view(np.uint64))
    return word[order].view(np.uint64), clean[order], bad[order]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Shard, number in it, and rows of each block; wherever batches end, a shard has the same blocks."""
    kept: list[pa.RecordBatch] = []
    shard, number = None, 0
    for batch in slices(batches, "words", SLICE):
        owners = batch.column(0).to_numpy()
        first = 0
        while first < len(owners):
            if owners[first] != shard:
                if kept:
                    yield shard, number, pa.concat_batches(kept)
                kept, shard, number = [], int(owners[first]), 0
            others = np.flatnonzero(owners[first:] != shard)
            left = int(others[0]) if len(others) else len(owners) - first
            end = first + min(BLOCK_ROWS - sum(b.num_rows for b in kept), left)
            kept.append(batch.slice(first, end - first))
            if sum(b.num_rows for b in kept) == BLOCK_ROWS:
                yield shard, number, pa.concat_batches(kept)
                kept, number = [], number + 1
            first = end
    if kept:
        yield shard, number, pa.concat_batches(kept)


def _moves(before: np.ndarray, after: np.ndarray, sums: np.ndarray, after_sums: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that training changed, and their new values and sums in whole units, a part of the matrix at a time."""
    for first in range(0, len(after), SENT_ROWS):
        part = slice(first, first + SENT_ROWS)
        moved = first + np.flatnonzero(((after[part] != before[part]) | (after_sums[part] != sums[part])).any(axis=1))
        if len(moved):
            yield moved, np.rint(np.concatenate([after[moved], after_sums[moved]], axis=1) / UNIT).astype(np.int64)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs in here pass a block of rows to Python at once: by default whole texts of 10,000 rows lie in both processes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= BLOCK_ROWS:
        spark.conf.set(name, str(BLOCK_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _epoch(rows: DataFrame, network: Network, seen: np.ndarray, epoch: int) -> np.ndarray:
    """Train a copy of the network on each shard and make it their average; `seen` are the sums of AdaGrad, averaged as well.

    A row of values counts the shards that moved it.
    """
    sent = rows.sparkSession.sparkContext.broadcast((network.known, network.matrix(), seen))
    names = [f"{kind}{i}" for kind in ("value", "seen") for i in range(DIMENSIONS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blocks in groupby(_blocks(batches), lambda block: block[0]):
            known, before, sums = sent.value
            own = Network.from_matrix(known, before)
            state = _values_of_rows(sums, len(own.embeddings))
            for _, number, block in blocks:
                toxic = block.column(1).to_numpy().astype(np.float32)
                hashes, offsets = _words(block.column(2))
                place = own.rows_of(hashes)
                order = np.random.default_rng([SEED, epoch, shard, number]).permutation(len(toxic))
                for first in range(0, len(order), BATCH):
                    chosen = order[first : first + BATCH]
                    parts = [place[offsets[i] : offsets[i + 1]] for i in chosen.tolist()]
                    _step(own, np.concatenate(parts), np.cumsum([0, *map(len, parts)]), toxic[chosen], state)
            after = own.matrix()
            del own
            after_sums = _rows_of_values(state.pop("embeddings"), [state[name] for name in SHAPES])
            del state
            for moved, values in _moves(before, after, sums, after_sums):
                columns = [pa.array(moved.astype(np.int32)), *(pa.array(np.ascontiguousarray(v)) for v in values.T)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *names])
            del after, after_sums
        give_back()

    copies = rows.select("shard", "y", "words").mapInArrow(work, "row int, " + ", ".join(f"{n} long" for n in names))
    means = [(F.sum(n) / F.count(F.lit(1)) * UNIT).cast("float").alias(n) for n in names]
    found = copies.groupBy("row").agg(*means).toArrow()
    at, *values = (c.to_numpy() for c in found.columns)
    matrix, seen = network.matrix(), seen.copy()
    matrix[at], seen[at] = np.stack(values[:DIMENSIONS], axis=1), np.stack(values[DIMENSIONS:], axis=1)
    network.take(matrix)
    sent.unpersist()
    return seen


def _calibrated(rows: DataFrame, network: Network) -> None:
    """Thresholds from all of `rows`, counted by language and step of the logit."""
    sent = rows.sparkSession.sparkContext.broadcast(network.to_bytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.from_bytes(sent.value)
        for batch in slices(batches, "words", SLICE):
            hashes, offsets = _words(batch.column(2))
            step = np.floor(np.clip(model.logits(model.rows_of(hashes), offsets), -30, 30) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(step)], names=["y", "language", "step"])

    steps = rows.select("y", "language", "words").mapInArrow(work, "y int, language int, step int")
    found = steps.groupBy("y", "language", "step").agg(F.count(F.lit(1)).alias("n")).orderBy("step", "language", "y").toArrow()
    if found.num_rows:
        toxic, language, step, n = (c.to_numpy() for c in found.columns)
        _calibrate(network, _sigmoid(step / LOGIT_STEPS), _sigmoid((step + 1) / LOGIT_STEPS), toxic, n, language)
    sent.unpersist()


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> bytes:
    """Fit on all labelled documents outside the held-out third; the network as bytes (a few MB).

    Labels other than 0 and 1, keys without a document, and null keys are left out. Without labels of both classes every
    document gets the same score.
    """
    with _small_batches(docs.sparkSession):
        return _trained(docs, labels, key, text, label)


def _trained(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> bytes:
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("key")).agg(
        F.max(label).cast("int").alias("y")
    )
    usable = stored(usable, "labels")
    shards = max(1, -(-usable.count() * (CALIBRATION_PART - 1) // (CALIBRATION_PART * SHARD_ROWS)))
    texts = docs.where(~held_out(F.col(key))).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # Labels grow with the documents: neither side is broadcast at any size, and texts are not sorted.
    rows = _hashed(texts.join(usable.hint("shuffle_hash"), "key")).withColumns(
        {"place": F.xxhash64("key"), "shard": F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"), "calibrates": calibrates(F.col("key"))}
    )
    rows = stored(rows.drop("key").repartition(shards, "shard").sortWithinPartitions("shard", "place", F.xxhash64("words")), "labelled")
    sizes = {(r.y, r.calibrates): r.n for r in rows.groupBy("y", "calibrates").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({y for y, _ in sizes}) < 2:
        network = _of_one_class(any(y for y, _ in sizes))
    else:
        learnt = rows.where("NOT calibrates")
        clean, toxic = (sizes.get((y, False), 0) for y in (0, 1))
        counts = _word_counts(learnt, max(LEAST_DOCUMENTS, (clean + toxic) // RAREST))
        network = _untrained(np.random.default_rng(SEED), *counts, toxic / max(clean + toxic, 1))
        seen = np.full_like(network.matrix(), 1e-2)
        for epoch in range(EPOCHS):
            seen = _epoch(learnt, network, seen, epoch)
        _calibrated(rows.where("calibrates"), network)
    discard(usable, rows)
    return network.to_bytes()


def score(docs: DataFrame, network: bytes, text: str = "text", into: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1 of the whole text; null counts as empty. THRESHOLD marks toxic texts.

    All rows and columns stay; a column named like `into` is replaced. Nothing but the text enters the score.
    """
    base = docs.drop(into)
    sent = docs.sparkSession.sparkContext.broadcast(network)
    schema = base.withColumn(into, F.lit(0.0)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.from_bytes(sent.value)
        for batch in slices(batches, text, SLICE):
            words = Words(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.scores(words), pa.float64())], names=[*batch.schema.names, into]
            )

    return base.mapInArrow(work, schema)


@apart_from_input
def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without those whose score reaches THRESHOLD."""
    network = train(docs, labels, key, text)
    scored = score(docs, network, text, "__score")
    return scored.where(F.col("__score") < THRESHOLD).select(docs.columns)
