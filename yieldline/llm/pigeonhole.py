"""Near-duplicate vectors by an exact subspace pigeonhole join.

Unit vectors with cosine >= c are at most t = 2 - 2c apart in squared distance. After a rotation the dimensions are split into
blocks; if two vectors are that near, then in some block they are within the block's share of t, in proportion to its dimensions.
Each block is a range join of its own: a grid over the block gives every vector a home cell, and a vector visits each cell
further on in the grid's order that comes within the block's budget. Pairs within budget are verified on whole vectors in double
precision, each in the first block that finds it.

Equal vectors are one class, named by a digest. Classes are dealt to chunks of bounded size, and a task joins two chunks in all
blocks: a vector is sent once for each other chunk, and cells are made of row numbers inside the task. Tasks return counts
and a spanning forest of their links, never the pairs, so a dense group costs rows in proportion to its size.

Rotated coordinates are rounded to whole numbers once; block distances are then exact and the same in every task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline.llm.columns import flat, give_back
from yieldline.llm.components import components, stored

BLOCK = 8
SCALE = 1 << 20
# Widens budgets by more than the rounding of coordinates can take away.
SLACK = 1e-5
# Vectors at home in a cell on average, and the most vectors and bytes of a chunk.
PER_CELL, CHUNK, CHUNK_BYTES = 1_000, 128_000, 32 << 20
# Chunks that there are at least, unless they would be smaller than this.
LEAST_CHUNKS, LEAST_CHUNK = 5, 1_000
# Block distances computed at once, rows whose cells are looked up at once, and pairs verified at once.
PRODUCTS, ROWS, AT_ONCE = 1 << 19, 1 << 14, 20_000
SEED = 11


@functools.lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A fixed random rotation, so that no block gathers more of the variance than another."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def budgets(dimensions: int, cosine: float) -> np.ndarray:
    """Squared distance that each block may take, in units of rounded coordinates."""
    sizes = np.diff(np.append(np.arange(0, dimensions, BLOCK), dimensions))
    return ((2 - 2 * cosine) * sizes / dimensions + SLACK) * float(SCALE) ** 2


def _usable(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    return np.isfinite(vectors).all(axis=1) & np.isfinite(norms) & (norms > 0)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]


def _by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their vectors, one matrix for each length. Null, empty and partly null vectors are left out."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = lists.flatten()
    missing = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
    numbers = values.to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    whole = missing[ends] == missing[ends - lengths]
    for n in np.unique(lengths[whole & (lengths > 0)]).tolist():
        rows = np.flatnonzero(whole & (lengths == n))
        yield rows, numbers[(ends - lengths)[rows][:, None] + np.arange(n)]


def _classes(vectors: DataFrame, kind: str, whole: bool) -> DataFrame:
    """id, class, dims of each row, with the values as bytes if `whole`; rows that are not usable have a null class."""
    schema = "id long, class binary, dims int" + ", vec binary" * whole

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec: list[bytes | None] = [None] * batch.num_rows
            dims = np.zeros(batch.num_rows, np.int32)
            for rows, matrix in _by_length(batch.column(1)):
                matrix = matrix.astype(kind) + 0.0  # no negative zeros
                for i in np.flatnonzero(_usable(matrix)).tolist():
                    vec[rows[i]] = matrix[i].astype(kind).tobytes()
                    dims[rows[i]] = matrix.shape[1]
            names = [None if v is None else hashlib.blake2b(v, digest_size=16).digest() for v in vec]
            columns = [batch.column(0), pa.array(names, pa.binary()), pa.array(dims)] + [pa.array(vec, pa.binary())] * whole
            yield pa.RecordBatch.from_arrays(columns, names=["id", "class", "dims", "vec"][: len(columns)])

    return vectors.mapInArrow(work, schema)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    data, _ = flat(column)
    return data.view(kind).reshape(len(column), -1)


def _cuts(bits: int) -> list[np.ndarray]:
    """Cut points of the grid by dimension of a block: at zero first, then at the quartiles, for 2 ** bits cells or so."""
    spread = SCALE * 0.6745
    return [
        np.array([-spread, 0.0, spread]) if bits > BLOCK + j else np.array([0.0]) if bits > j else np.empty(0) for j in range(BLOCK)
    ]


def reached(block: np.ndarray, dimensions: int, bits: int, budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell, home? for each cell that a row's block comes within budget of, its own and those after it in order."""
    rows, cells, spent = np.arange(len(block)), np.zeros(len(block), np.int64), np.zeros(len(block))
    home = np.zeros(len(block), np.int64)
    for j, cuts in enumerate(_cuts(bits)[: block.shape[1]]):
        if not len(cuts):
            continue
        cuts = np.round(cuts / np.sqrt(dimensions))
        x = block[:, j].astype(np.float64)
        own = np.searchsorted(cuts, x, side="right")
        home = home * (len(cuts) + 1) + own
        parts = []
        for k in range(len(cuts) + 1):
            below = cuts[k - 1] if k else -np.inf
            above = cuts[k] if k < len(cuts) else np.inf
            gap = np.maximum(np.maximum(below - x, x - above), 0.0)[rows]
            total = spent + gap**2
            ok = total <= budget
            parts.append((rows[ok], cells[ok] * (len(cuts) + 1) + k, total[ok]))
        rows, cells, spent = (np.concatenate(p) for p in zip(*parts, strict=True))
    keep = cells >= home[rows]
    return rows[keep], cells[keep], cells[keep] == home[rows[keep]]


def _cells(block: np.ndarray, dimensions: int, bits: int, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows at home and rows that visit, cell by cell."""
    parts = []
    for first in range(0, len(block), ROWS):
        rows, cells, home = reached(block[first : first + ROWS], dimensions, bits, budget)
        parts.append(((rows + first).astype(np.int32), cells.astype(np.uint16), home))
    rows, cells, home = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(cells, kind="stable")
    rows, home, ends = rows[order], home[order], np.cumsum(np.bincount(cells))
    for first, last in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        here = home[first:last]
        if here.any():
            yield rows[first:last][here], rows[first:last][~here]


class _Forest:
    """Links found so far among rows, as labels and the edges that joined them."""

    def __init__(self, count: int):
        self.label = np.arange(count)
        self.edges: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        la, lb = self.label[a], self.label[b]
        apart = np.flatnonzero(la != lb)
        if not len(apart):
            return
        pairs, first = np.unique(np.stack([la[apart], lb[apart]]), axis=1, return_index=True)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for (x, y), i in zip(pairs.T.tolist(), apart[first].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.edges.append((int(a[i]), int(b[i])))
        to = np.arange(len(self.label))
        for x in parent:
            to[x] = root(x)
        self.label = to[self.label]


class _Rows:
    """The rows of several matrices as one, without a copy."""

    def __init__(self, parts: list[np.ndarray]):
        self.parts, self.starts = parts, np.cumsum([0, *map(len, parts)])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty((len(rows), self.parts[0].shape[1]), self.parts[0].dtype)
        where = np.searchsorted(self.starts, rows, side="right") - 1
        for p in np.unique(where).tolist():
            here = where == p
            out[here] = self.parts[p][rows[here] - self.starts[p]]
        return out


def linked(
    parts: list[np.ndarray], second: np.ndarray, within: tuple[bool, bool], copies: np.ndarray, cosine: float
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row (counting copies) and a spanning forest. The rows are those of all `parts`.

    Compares rows of a first chunk with those of a `second` one, and the rows of each chunk `within` says so with each other.
    """
    vectors = _Rows(parts)
    count, n = len(vectors), parts[0].shape[1]
    turned = np.empty((count, n), "<i4")
    for first in range(0, count, ROWS):
        some = slice(first, min(first + ROWS, count))
        turned[some] = np.round(_unit(vectors[np.arange(some.start, some.stop)]) @ rotation(n) * SCALE)
    limits, starts = budgets(n, cosine), np.arange(0, n, BLOCK)
    bits = int(np.clip(np.ceil(np.log2(max(count, 1) / PER_CELL)), 0, 2 * BLOCK))
    links, forest = np.zeros(count, np.int64), _Forest(count)
    products = np.empty(max(PRODUCTS, count), np.float32)
    flags = np.empty(len(products), bool)

    def compared(home: np.ndarray, visit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Rows to compare with rows; True if both are the same ones."""
        ours, theirs = ([rows[~second[rows]], rows[second[rows]]] for rows in (home, visit))
        if all(within):
            yield home, home, True
            yield home, visit, False
            return
        yield ours[0], np.concatenate([ours[1], theirs[1], *[theirs[0]] * within[0]]), False
        yield ours[1], np.concatenate([theirs[0], *[theirs[1]] * within[1]]), False
        for side in (0, 1):
            if within[side]:
                yield ours[side], ours[side], True

    def close(block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs within the block's budget, and maybe some more."""
        whole = np.ascontiguousarray(turned[:, block * BLOCK : (block + 1) * BLOCK])
        part = whole.astype(np.float32) / SCALE
        half = (part**2).sum(axis=1, keepdims=True) / 2
        one = np.ones_like(half)
        # The product of these rows is minus half the squared distance.
        left, right = np.hstack([part, -half, one]), np.hstack([part, one, -half])
        near = -np.float32(limits[block] / float(SCALE) ** 2 * (1 + 1e-4) + 1e-6) / 2
        for home, visit in _cells(whole, n, bits, limits[block]):
            for rows, columns, same in compared(home, visit):
                step, facing = max(1, PRODUCTS // max(1, len(columns))), right[columns].T
                for first in range(0, len(rows) if len(columns) else 0, step):
                    some = rows[first : first + step]
                    size = len(some) * len(columns)
                    np.matmul(left[some], facing, out=products[:size].reshape(len(some), -1))
                    hits = np.flatnonzero(np.greater_equal(products[:size], near, out=flags[:size]))
                    a, b = np.divmod(hits, len(columns))
                    if same:
                        keep = a + first > b
                        a, b = a[keep], b[keep]
                    if len(a):
                        yield some[a], columns[b]

    def verify(waiting: list[tuple[np.ndarray, np.ndarray]]) -> None:
        x, y = (np.concatenate(p) for p in zip(*waiting, strict=True))
        good = (_unit(vectors[x]) * _unit(vectors[y])).sum(axis=1) >= cosine
        x, y = x[good], y[good]
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        forest.add(x, y)

    waiting, held = [], 0
    for block in range(len(limits)):
        # Together with the blocks that come next, round and round, a pair may not exceed the whole budget.
        near_by = sorted({(block + k) % len(limits) for k in range(3)})
        beside = np.concatenate([turned[:, b * BLOCK : (b + 1) * BLOCK] for b in near_by], axis=1).astype(np.float32)
        most = limits.sum() * (1 + 1e-4)
        for a, b in close(block):
            for at in range(0, len(a), AT_ONCE):
                x, y = a[at : at + AT_ONCE], b[at : at + AT_ONCE]
                maybe = ((beside[x] - beside[y]) ** 2).sum(axis=1) <= most
                x, y = x[maybe], y[maybe]
                if not len(x):
                    continue
                gaps = np.add.reduceat((turned[x].astype(np.int64) - turned[y]) ** 2, starts, axis=1) <= limits
                own = gaps[:, block] & ~gaps[:, :block].any(axis=1)
                waiting.append((x[own], y[own]))
                held += len(waiting[-1][0])
                if held > AT_ONCE:
                    verify(waiting)
                    waiting, held = [], 0
    if waiting:
        verify(waiting)
    return links, forest.edges


def _keys(spark: SparkSession, count: int) -> list[int]:
    """So many numbers that Spark deals to as many partitions, one to each."""
    tried = spark.range(64 * count).select(F.col("id").cast("int").alias("k"))
    dealt = tried.groupBy(F.pmod(F.hash("k"), F.lit(count)).alias("p")).agg(F.min("k").alias("k"))
    keys = [r.k for r in dealt.collect()]
    return keys + list(range(64 * count, 65 * count - len(keys)))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per row of `vectors`: key, n_links, component_id, kept.

    n_links: other vectors with cosine >= `cosine` in double precision; component_id: smallest key that links reach; kept: whether it is
    the row's own. Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, nor do vectors of
    different length, nor rows without a key (component null, not kept). Rows repeated with one key and vector are one vector,
    each returned. An empty table gives no rows. Other columns, labels included, are not read.
    """
    element = vectors.schema[column].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    every = stored(_classes(rows, kind, whole=False), "vectors")
    distinct = every.where("id IS NOT NULL AND class IS NOT NULL").groupBy("class", "dims", "id").agg(F.lit(1).alias("one"))
    classes = stored(distinct.groupBy("class", "dims").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    size = classes.agg(F.count(F.lit(1)).alias("n"), (F.sum("dims") * np.dtype(kind).itemsize).alias("bytes")).first()
    chunks = max(-(-size.n // CHUNK), -(-(size.bytes or 0) // CHUNK_BYTES), min(LEAST_CHUNKS, size.n // LEAST_CHUNK), 1)

    # A task for each two chunks. A chunk's own pairs are left to its task with the next one, round and round.
    pairs = [(a, b) for a in range(chunks) for b in range(a + 1, chunks)] or [(0, 0)]
    keys = _keys(vectors.sparkSession, len(pairs))
    asked = {k: (a, b, b - a < 2, (a, b) == (0, chunks - 1)) for k, (a, b) in zip(keys, pairs, strict=True)}
    key_of = {p: k for k, (a, b, *_) in asked.items() for p in ((a, b), (b, a))}
    tasks_of = F.array(*[F.array(*[F.lit(key_of[a, b]) for b in range(chunks) if (a, b) in key_of]) for a in range(chunks)])
    vec = _classes(rows.where("id IS NOT NULL"), kind, whole=True).where("class IS NOT NULL").groupBy("class", "dims").agg(F.min("vec").alias("vec"))
    own = F.pmod(F.xxhash64("class"), F.lit(chunks)).cast("int")
    dealt = vec.join(classes, ["class", "dims"]).withColumn("chunk", own)
    tasks = dealt.select(F.explode(F.element_at(tasks_of, F.col("chunk") + 1)).alias("task"), "chunk", "dims", "id", "copies", "vec")

    def work(table: pa.Table) -> pa.Table:
        first, second, *within = asked[table["task"][0].as_py()]
        dims = table["dims"].to_numpy()
        found = [(np.empty(0, np.int64), pa.nulls(0, pa.int64()), np.empty(0, np.int64))]
        for n in np.unique(dims).tolist():
            some = table if (dims == n).all() else table.filter(pa.array(dims == n))
            parts = [_matrix(part, kind) for part in some["vec"].chunks if len(part)]
            ids, chunk, copies = (some[c].to_numpy() for c in ("id", "chunk", "copies"))
            links, edges = linked(parts, (chunk == second) & (first != second), tuple(within), copies, cosine)
            hit = np.flatnonzero(links)
            a = np.array([ids[x] for x, _ in edges], np.int64)
            b = np.array([ids[y] for _, y in edges], np.int64)
            found.append((ids[hit], pa.nulls(len(hit), pa.int64()), links[hit]))
            found.append((a, pa.array(b, pa.int64()), np.zeros(len(a), np.int64)))
        give_back()
        ids, others, links = zip(*found, strict=True)
        return pa.table({"id": np.concatenate(ids), "other": pa.concat_arrays(others), "links": np.concatenate(links)})

    found = tasks.repartition(len(pairs), "task").groupBy("task").applyInArrow(work, "id long, other long, links long")
    found = stored(found, "found")
    counts = found.where("other IS NULL").groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    known = (
        classes.join(counts, "id", "left")
        .join(labels, "id", "left")
        .select(
            "class",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return every.join(known, "class", "left").select(
        F.col("id").alias(key),
        F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def checking_sql(cosine: float = 0.95) -> str:
    """Links and components in DuckDB by comparing all pairs; for small tables."""
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), sized AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM usable WHERE list_dot_product(e, e) > 0
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sized a JOIN sized b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {cosine}
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.y FROM reached r JOIN links l ON l.x = r.other
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counted AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM embeddings v LEFT JOIN counted c ON c.x = v.vec_id LEFT JOIN least l ON l.vec_id = v.vec_id
"""
