"""Ranked lexical search by range maxima: exact best documents of each item without scoring all of them.

1. The index. A task turns its documents into shards: posting lists of some thousand documents in key order, with how often each
   document has the term. A shard is a row of two packed columns, so that Spark moves small bytes and not millions of numbers, and a
   file has few of them; nothing is shuffled. Statistics of the whole corpus are sums over shards.
2. The search. For the lists that any item asks for, a shard gets impacts (what a posting adds to a score) and sparse tables over
   them, which give the largest impact of any stretch of a list, and its document, from two entries.
3. For an item, the interval of all documents of the shard is bounded by the sum of its lists' range maxima. The intervals with
   the highest bounds are split at the document that has the largest single impact there; that document is scored in full, and
   what lies left and right of it is bounded in turn. An interval that cannot reach the item's best documents so far goes.

A task keeps the best documents of each item over all its shards, so its output does not grow with its input. Items are
searched in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yieldline.llm.columns import flat, give_back, runs, slices
from yieldline.session import new_folder

# Bytes of text and rows of a shard; a longer text is a shard of its own.
SHARD_BYTES, SHARD_ROWS = 16 << 20, 1 << 20
# Bytes of item texts that are searched at once.
BLOCK_BYTES = 4 << 20
# Intervals that are split at once. One by one would score fewer documents, but each at the price of a whole step.
AT_ONCE = 64
SALTS = 64
# Bytes of text whose terms are found at once, and shards of a file: Spark reads and writes a small file's rows as one batch.
PIECE_BYTES, FILE_SHARDS = 4 << 20, 4
INDEX_SCHEMA = "holding long, n_terms long, words binary, postings binary"
_WORDS, _POSTINGS = ["terms", "ends"], ["docs", "lengths", "post_docs", "counts"]
_NAMES = ["holding", "n_terms", "docs", "lengths", "terms", "ends", "post_docs", "counts"]
# A table entry is an impact and, in the low bits, how far its document is from the last one a shard can have.
_DOC_BITS = SHARD_ROWS.bit_length()
_DOC_MASK = (1 << _DOC_BITS) - 1

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all rows one after the other, and where each row's begin (one more entry at the end)."""
    data, offsets = flat(column)
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    inside = _TERM_BYTE[low]
    starts, ends = runs(inside, offsets)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    text = np.ascontiguousarray(low[inside])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(text)), np.searchsorted(starts, offsets)


def shard(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The index row of some documents (id, text); None if no document has a term."""
    order = np.argsort(batch.column(0).to_numpy(), kind="stable")
    pieces = [terms_of(some.column(1)) for some in slices(iter([batch]), "text", PIECE_BYTES)]
    lengths = np.concatenate([np.empty(0, np.int64), *[np.diff(first) for _, first in pieces]])
    words = pa.chunked_array([x for x, _ in pieces], pa.large_string())
    if not len(words):
        return None
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    coded = words.dictionary_encode().combine_chunks()
    del pieces, words
    keys = coded.indices.to_numpy().astype(np.int64) * len(order) + np.repeat(place, lengths)
    keys, counts = np.unique(keys, return_counts=True)
    ends = np.searchsorted(keys, np.arange(1, len(coded.dictionary) + 1) * len(order))
    lists = [
        batch.column(0).to_numpy()[order],
        lengths[order].astype(np.int32),
        coded.dictionary.cast(pa.string()),
        ends.astype(np.int32),
        (keys % len(order)).astype(np.int32),
        counts.astype(np.int32),
    ]
    whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists]
    return pa.RecordBatch.from_arrays([pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())]), *whole], names=_NAMES)


def packed(row: pa.RecordBatch) -> pa.RecordBatch:
    """An index row as it is stored."""

    def narrow(column: pa.ListArray) -> pa.ListArray:
        values = column.values
        if not pa.types.is_int32(values.type):
            return column
        most = pc.max(values).as_py() or 0
        kind = pa.uint8() if most < 1 << 8 else pa.uint16() if most < 1 << 16 else pa.int32()
        return pa.ListArray.from_arrays(column.offsets, values.cast(kind))

    def blob(names: list[str]) -> pa.Array:
        part = pa.RecordBatch.from_arrays([narrow(row.column(_NAMES.index(n))) for n in names], names=names)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            stream.write_batch(part)
        return pa.array([sink.getvalue().to_pybytes()], pa.binary())

    return pa.RecordBatch.from_arrays([row.column(0), row.column(1), blob(_WORDS), blob(_POSTINGS)], names=["holding", "n_terms", "words", "postings"])


def opened(blob: pa.BinaryScalar) -> dict[str, pa.Array]:
    part = pa.ipc.open_stream(blob.as_buffer()).read_next_batch()
    return {n: part.column(i)[0].values for i, n in enumerate(part.schema.names)}


@dataclass(frozen=True)
class Index:
    """A stored index: N documents with a term, L terms with their repeats, and the shards."""

    spark: SparkSession
    folder: str

    @classmethod
    def write(cls, docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> "Index":
        """Index whole texts. Rows without a key are left out; repeated rows of a key are documents of their own."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for some in slices(batches, "text", SHARD_BYTES):
                for first in range(0, some.num_rows, SHARD_ROWS):
                    row = shard(some.slice(first, SHARD_ROWS))
                    if row is not None:
                        yield packed(row)

        rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        rows.mapInArrow(work, INDEX_SCHEMA).write.option("maxRecordsPerFile", FILE_SHARDS).parquet(folder)
        return cls(docs.sparkSession, folder)

    def shards(self) -> DataFrame:
        return self.spark.read.schema(INDEX_SCHEMA).parquet(self.folder)

    def totals(self) -> tuple[int, int]:
        row = self.shards().agg(F.sum("holding"), F.sum("n_terms")).first()
        return row[0] or 0, row[1] or 0

    def documents_with(self, vocabulary: pa.Array) -> np.ndarray:
        """For each term of `vocabulary` the number of documents that hold it."""
        shared = self.spark.sparkContext.broadcast(vocabulary)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(len(shared.value), np.int64)
            for batch in batches:
                for i in range(batch.num_rows):
                    row = opened(batch.column(0)[i])
                    asked, lists = _asked(row["terms"], shared.value)
                    held[asked] += np.diff(row["ends"].to_numpy().astype(np.int64), prepend=0)[lists]
            found = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(held[found])], names=["term", "held"])

        parts = self.shards().select("words").mapInArrow(work, "term int, held long")
        out = np.zeros(len(vocabulary), np.int64)
        for term, held in parts.groupBy("term").agg(F.sum("held")).collect():  # a row for each term of a block of items
            out[term] = held
        return out


def _asked(terms: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in the vocabulary of the terms that it has, and which of `terms` they are."""
    at = pc.index_in(terms, value_set=vocabulary)
    lists = np.flatnonzero(~np.asarray(at.is_null()))
    return at.drop_null().to_numpy(), lists


class RangeMaxima:
    """Sparse tables over all lists of a shard at once: level j holds the largest of 2**j entries from each place on.

    Entries that reach into the next list are never asked for.
    """

    def __init__(self, values: np.ndarray, longest: int):
        self._table = np.empty((max(1, max(1, longest).bit_length()), len(values)), values.dtype)
        self._table[0] = values
        for j in range(1, len(self._table)):
            last, half = self._table[j - 1], 1 << (j - 1)
            self._table[j] = last
            np.maximum(last[:-half], last[half:], out=self._table[j, :-half])
        self._level = np.zeros(longest + 1, np.int8)
        for j in range(1, len(self._table)):
            self._level[1 << j :] = j

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest of values[low:high] for each pair; 0 for an empty one."""
        length = high - low
        some = length > 0
        level = self._level[np.where(some, length, 0)]
        low = np.where(some, low, 0)
        other = np.where(some, high - (np.int64(1) << level.astype(np.int64)), 0)
        return np.where(some, np.maximum(self._table[level, low], self._table[level, other]), 0)


class Searcher:
    """One shard, ready for the items of a block."""

    def __init__(self, row: dict, vocabulary: pa.Array, weights: np.ndarray, documents: int, all_terms: int):
        asked, lists = _asked(row["terms"], vocabulary)
        lengths, ends = row["lengths"].to_numpy().astype(np.int64), row["ends"].to_numpy().astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        sizes = (ends - starts)[lists]
        places = np.repeat(starts[lists] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        self.docs, self.ids = row["post_docs"].to_numpy().astype(np.int64)[places], row["docs"].to_numpy()
        counts = row["counts"].to_numpy().astype(np.int64)[places]
        m = 100 - 75 + (75 * lengths * documents) // all_terms
        owner = np.repeat(np.arange(len(lists)), sizes)
        self.impacts = weights[asked][owner] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[self.docs]))
        self.keys = owner * len(lengths) + self.docs  # ascending: lists one after the other, documents in order
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.list_of = np.full(len(vocabulary), -1, np.int64)
        self.list_of[asked] = np.arange(len(asked))
        self.maxima = RangeMaxima((self.impacts << _DOC_BITS) | (_DOC_MASK - self.docs), int(sizes.max(initial=0)))

    def search(self, terms: np.ndarray, repeats: np.ndarray, best: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
        """`best` (scores, ids) of an item, brought up to date with this shard."""
        lists = self.list_of[terms]
        lists, repeats = lists[lists >= 0], repeats[self.list_of[terms] >= 0][:, None]
        if not len(lists):
            return best
        count = len(self.ids)

        def bounded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Bound of each interval, and the document to split it at."""
            largest = self.maxima(low, high)
            impacts = (largest >> _DOC_BITS) * repeats
            chosen = np.take_along_axis(largest, impacts.argmax(axis=0)[None], axis=0)[0]
            return impacts.sum(axis=0), _DOC_MASK - (chosen & _DOC_MASK)

        def hopeful(bounds: np.ndarray, first: np.ndarray) -> np.ndarray:
            """Intervals that may hold one of the best documents: at equal scores the smaller id counts."""
            scores, ids = best
            if len(scores) < top:
                return bounds > 0
            return (bounds > scores[-1]) | ((bounds == scores[-1]) & (self.ids[np.minimum(first, count - 1)] < ids[-1]))

        low, high = self.starts[lists][:, None], self.ends[lists][:, None]
        first = np.zeros(1, np.int64)
        bounds, split = bounded(low, high)
        while True:
            keep = hopeful(bounds, first)
            if not keep.any():
                return best
            if not keep.all():
                low, high, first, bounds, split = low[:, keep], high[:, keep], first[keep], bounds[keep], split[keep]
            now = np.argpartition(-bounds, AT_ONCE)[:AT_ONCE] if len(bounds) > AT_ONCE else np.arange(len(bounds))
            a, b, docs = low[:, now], high[:, now], split[now]
            at = np.searchsorted(self.keys, lists[:, None] * count + docs)
            there = (at < b) & (self.docs[np.minimum(at, len(self.docs) - 1)] == docs)
            found = (np.where(there, self.impacts[np.minimum(at, len(self.docs) - 1)], 0) * repeats).sum(axis=0)
            best = better(best, (found, self.ids[docs]), top)
            left = np.delete(low, now, axis=1), np.delete(high, now, axis=1), np.delete(first, now), np.delete(bounds, now), np.delete(split, now)
            new_low, new_high = np.concatenate([a, at + there], axis=1), np.concatenate([at, b], axis=1)
            new_first = np.concatenate([first[now], docs + 1])
            new_bounds, new_split = bounded(new_low, new_high)
            keep = hopeful(new_bounds, new_first)
            low, high = np.concatenate([left[0], new_low[:, keep]], axis=1), np.concatenate([left[1], new_high[:, keep]], axis=1)
            first, bounds, split = (np.concatenate(x) for x in ((left[2], new_first[keep]), (left[3], new_bounds[keep]), (left[4], new_split[keep])))


def better(best: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
    """The `top` best of both, by falling score and then by id; scores of 0 do not count."""
    scores, ids = np.concatenate([best[0], more[0]]), np.concatenate([best[1], more[1]])
    order = np.lexsort((ids, -scores))
    order = order[scores[order] > 0][:top]
    return scores[order], ids[order]


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


def _search_block(index: Index, items: list, documents: int, all_terms: int, top: int) -> DataFrame:
    """item_id, doc_id, score: the best documents of each task. `items`: rows (item_id, text) of one block."""
    words, first = terms_of(pa.array([r.text for r in items], pa.string()))
    coded = words.dictionary_encode()
    vocabulary, codes = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
    asked = [np.unique(codes[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
    held = index.documents_with(vocabulary)
    weights = np.array([weight(documents, int(h)) for h in held], np.int64)
    shared = index.spark.sparkContext.broadcast((vocabulary, weights, [r.item_id for r in items], asked))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, names, asked = shared.value
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        best = [none] * len(names)
        for batch in batches:
            for i in range(batch.num_rows):
                here = Searcher({**opened(batch.column(0)[i]), **opened(batch.column(1)[i])}, vocabulary, weights, documents, all_terms)
                best = [here.search(*asked[k], best[k], top) for k in range(len(names))]
                del here  # before the next one takes room
        rows = [(names[k], d, s) for k, (scores, ids) in enumerate(best) for s, d in zip(scores.tolist(), ids.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])
        give_back()

    return index.shards().drop("holding", "n_terms").mapInArrow(work, "item_id long, doc_id long, score long")


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", top: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` documents with a score above 0, equal scores by ascending key.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, with A-Z lower-cased. A term adds
    w * ((10**9 * tf) div (1000 * tf + 8 * m)) for each time the item has it, with w = floor(1000 * ln((2N + 2) / (2 df + 1))) and
    m = 25 + (75 n N) div L. Items without a key, text or known term have no rows; of items that repeat a key the least text
    counts. Documents that repeat a key can each have a rank. Other columns are not read.
    """
    documents, all_terms = index.totals()
    asked = items.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("item_id"))
    asked = asked.agg(F.min(F.col(text).cast("string")).alias("text")).where("text IS NOT NULL")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = index.spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks if documents else 0):
        some = asked.where(F.col("block") == block).select("item_id", "text").collect()  # BLOCK_BYTES, or one longer item
        if some:
            found = found.unionByName(_search_block(index, some, documents, all_terms, top))
    order = [F.desc("score"), F.asc("doc_id")]
    parts = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    parts = parts.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("r") <= top)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return parts.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def ranked(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """Index `docs` and search it for `items`."""
    return search(Index.write(docs, new_folder(docs.sparkSession, "lexical-index")), items, top=top)


def checking_sql() -> str:
    """The registered query in DuckDB, scoring each document that shares a term."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{term}') AS w FROM documents
), stats AS (
  SELECT count(*) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM d WHERE len(w) > 0
), postings AS (
  SELECT row, doc_id, n, t, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL
), weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), stats
), asked AS (
  SELECT item_id, t, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS t FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT a.item_id, p.row, p.doc_id, CAST(sum(a.c * x.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * p.n * s.N) // s.L)))) AS BIGINT) AS score
  FROM asked a JOIN postings p ON p.t = a.t JOIN weights x ON x.t = a.t, stats s GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
