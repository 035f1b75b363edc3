"""Removal of byte strings that stood earlier, by longest previous factors.

A window is a run of `length` bytes. It selects one k-gram in it, the one with the least hash (the first of ties), so equal
windows select equal k-grams at equal places. Around each selected k-gram lies a segment: all windows that selected it. A
repeated window only has to be looked for among segments of the same k-gram.

1. K-grams are dealt by their hash. One met once is done. Equal segments collapse to the earliest, and every later copy is
   repeated as a whole; copies within a slice of input collapse before the shuffle.
2. Where a k-gram has different segments, these are cut out of the texts. A window that holds the k-gram has half of its other
   bytes on one side at least, so a segment falls into two parts, each dealt by the k-gram with the bytes on that side.
3. Parts that meet are put in suffix order. The nearest suffixes before and after that have a smaller position tell how much of
   a suffix stood earlier, its longest previous factor. A window is a later copy if that is `length` or more.
4. Parts that meet are worked on in shards of bounded size. Where they take several, what is first in its shard is dealt by
   content once more, and the earliest of each stays.

The steps are one chain of shuffles without a branch: what is already known to be repeated travels along, and the texts
are shuffled once for both joins. Positions are ordered by (key, start) in the input; nothing is judged on what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline.llm.columns import RangeHash, flat, mixed, slices
from yieldline.llm.names import apart_from_input

K = 32
# Bytes of text at once; the hashes take some 80 bytes for each.
SLICE = 1 << 20
# Parts of a shard that are all of one meeting.
MOST_PARTS = 2000
# Bytes of parts put in suffix order at once.
SORTED_BYTES = 1 << 19
# Bits for `before` and `more` in a packed place.
BITS = 7


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values the place of the least, the first of ties. Values tie if their upper bits do."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    bits = max(24, len(values).bit_length())
    mask = np.uint64((1 << bits) - 1)
    packed = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    packed[: len(values)] = (values & ~mask) | np.arange(len(values), dtype=np.uint64)
    # A run is the end of one block and the start of the next.
    blocks = packed.reshape(-1, width)
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    left = np.minimum.accumulate(blocks, axis=1).reshape(-1)[width - 1 : width - 1 + n]
    return (np.minimum(left, right) & mask).astype(np.int64)


def selected(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Per selected k-gram: row, place in the row, bytes from segment to k-gram, windows after the first, hashes of
    k-gram and segment."""
    hashes = RangeHash(data)
    at = np.arange(max(len(data) - K + 1, 0))
    grams = hashes(at, at + K)
    place = _least_places(grams, length - K + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    windows = np.flatnonzero(np.arange(length, length + len(place)) <= offsets[row + 1])
    place, row = place[windows], row[windows]
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(place)) - 1 if len(first) else first
    a, b, p = windows[first], windows[last], place[first]
    return row[first], p - offsets[row[first]], p - a, b - a, grams[p], hashes(a, b + length)


def _segments(docs: DataFrame, length: int) -> DataFrame:
    """p, content, key, place of each segment. place packs the k-gram's place, `before` and `more`; it is negative (and p a hash of
    the key) for a segment that the same slice holds earlier."""
    schema = "p long, content long, key long, place long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, offsets = flat(batch.column(1))
            row, pos, before, more, grams, content = selected(data, offsets, length)
            key = batch.column(0).to_numpy(zero_copy_only=False)[row]
            shape = (before << BITS) | more
            order = np.lexsort((pos, key, shape, content, grams))
            g, c, s, k, p = (x[order] for x in (grams, content, shape, key, pos))
            copy = np.zeros(len(order), bool)
            copy[1:] = (g[1:] == g[:-1]) & (c[1:] == c[:-1]) & (s[1:] == s[:-1])
            # The same place of a repeated row is no copy.
            first = np.maximum.accumulate(np.where(copy, 0, np.arange(len(order))))
            copy &= (k != k[first]) | (p != p[first])
            place = (p << (2 * BITS)) | s
            to = np.where(copy, mixed(k.view(np.uint64)), g)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to.view(np.int64)), pa.array(c.view(np.int64)), pa.array(k), pa.array(np.where(copy, -1 - place, place))],
                names=["p", "content", "key", "place"],
            )

    return docs.select("key", "text").mapInArrow(work, schema)


def _met(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From segments sorted by p, content, shape, key, place: key, kind, a, b.

    Kind 0: bytes a to b are repeated. Kind 1: the segment with place a and shape b is the first of its content, and its k-gram
    has other contents. Only the last row and the one still waiting for a second content are held between batches.
    """
    last, waiting = None, None
    for batch in batches:
        p, content, key, place = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        known = place < 0
        copies = -1 - place[known]
        keys, kinds, a, b = [key[known]], [], [], []
        keep = ~known
        p, content, key, place = p[keep], content[keep], key[keep], place[keep]
        shape = place & ((1 << 2 * BITS) - 1)
        repeats = [copies]
        if len(p):
            gram = np.ones(len(p), bool)
            gram[1:] = p[1:] != p[:-1]
            kind = gram.copy()
            kind[1:] |= (content[1:] != content[:-1]) | (shape[1:] != shape[:-1])
            if last is not None:
                gram[0] = p[0] != last[0]
                kind[0] = gram[0] or content[0] != last[1] or shape[0] != last[2]
            # The first of a content, by row; -1 for rows whose content began in an earlier batch.
            start = np.maximum.accumulate(np.where(kind, np.arange(len(p)), -1))
            same = (start >= 0) & (key == key[start]) & (place == place[start])
            if last is not None:
                same |= (start < 0) & (key == last[3]) & (place == last[4])
            later = ~same
            keys.append(key[later])
            repeats.append(place[later])
            firsts = np.flatnonzero(kind)
            alone = gram[firsts]  # the first content of its k-gram
            followed = np.append(~alone[1:], False)
            candidates = firsts[~alone | followed]
            more_to_come = len(firsts) and alone[-1]
            if waiting is not None and len(firsts) and not alone[0]:
                keys.append(np.array([waiting[0]]))
                kinds.append((np.array([waiting[1] >> 2 * BITS]), np.array([waiting[1] & ((1 << 2 * BITS) - 1)])))
            keys.append(key[candidates])
            kinds.append((place[candidates] >> 2 * BITS, shape[candidates]))
            if len(firsts):
                waiting = (key[firsts[-1]], place[firsts[-1]]) if more_to_come else None
            held = start[-1]
            origin = (key[held], place[held]) if held >= 0 else (last[3], last[4])
            last = (p[-1], content[-1], shape[-1], *origin)
        done = np.concatenate(repeats)
        begin = (done >> 2 * BITS) - ((done >> BITS) & ((1 << BITS) - 1))
        a = np.concatenate([begin, *(x for x, _ in kinds)])
        b = np.concatenate([begin + (done & ((1 << BITS) - 1)) + length, *(x for _, x in kinds)])
        flag = np.zeros(len(a), np.int8)
        flag[len(done) :] = 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys)), pa.array(flag), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))],
            names=["key", "kind", "a", "b"],
        )


def _merged(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of the same row that touch or overlap become one."""
    if not len(rows):
        return rows, a, b
    order = np.lexsort((a, rows))
    rows, a, b = rows[order], a[order], b[order]
    # Ends so far, made comparable across rows.
    width = int(b.max()) + 1
    reach = np.maximum.accumulate(rows * width + b)
    new = np.ones(len(rows), bool)
    new[1:] = rows[1:] * width + a[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], a[first], reach[last] - rows[first] * width


def _parts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, found) to parts of segments (sub, key, start, bytes) and known ranges (bytes null)."""
    half = (length - K) // 2
    names = ["sub", "key", "start", "end", "part"]
    for batch in slices(batches, "text", 4 * SLICE):
        lists = batch.column(2)
        parents = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        found = lists.flatten()
        kind, a, b = (found.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        key = batch.column(0).to_numpy(zero_copy_only=False)
        rows, starts, ends = _merged(parents[kind == 0], a[kind == 0], b[kind == 0])
        spread = mixed(mixed(key[rows].view(np.uint64)) + starts.astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(spread), pa.array(key[rows]), pa.array(starts), pa.array(ends), pa.nulls(len(rows), pa.binary())], names=names
        )
        data, offsets = flat(batch.column(1))
        whole = data.tobytes()
        subs, owners, places, stops, pieces = [], [], [], [], []
        chosen = np.flatnonzero(kind == 1)
        for row, p, shape in zip(parents[chosen].tolist(), a[chosen].tolist(), b[chosen].tolist(), strict=True):
            at = int(offsets[row])
            first = p - (shape >> BITS)
            last = first + (shape & ((1 << BITS) - 1))
            for low, high, x, y, side in (
                (first, min(last, p - half), p - half, p + K, b"l"),
                (max(first, p - half + 1), last, p, p + K + half, b"r"),
            ):
                if low <= high:
                    digest = hashlib.blake2b(whole[at + x : at + y], digest_size=8, key=side).digest()
                    subs.append(int.from_bytes(digest, "little", signed=True))
                    owners.append(row)
                    places.append(low)
                    stops.append(high + length)
                    pieces.append(whole[at + low : at + high + length])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(subs, pa.int64()),
                pa.array(key[np.array(owners, np.int64)]),
                pa.array(places, pa.int64()),
                pa.array(stops, pa.int64()),
                pa.array(pieces, pa.binary()),
            ],
            names=names,
        )


def nearest_smaller(values: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each entry the least of `common` on the way back to the nearest entry before it with a smaller value; 0 if there is none.

    common[i] belongs to the step from i - 1 to i. All entries look back at once and follow each other's steps.
    """
    at = np.arange(len(values)) - 1
    least = common.astype(np.int64, copy=True)
    going = np.flatnonzero((at >= 0) & (values[at] >= values))
    while len(going):
        over = at[going]
        least[going] = np.minimum(least[going], least[over])
        at[going] = at[over]
        going = going[(at[going] >= 0) & (values[at[going]] >= values[going])]
    least[at < 0] = 0
    return least


def longest_previous_factors(positions: np.ndarray, common: np.ndarray) -> np.ndarray:
    """How much of each suffix stood earlier. Entries are in suffix order: the place of the suffix in the order of the texts, and how
    many bytes it has in common with the entry before it.

    The suffixes nearest in suffix order that have a smaller position, before and after, are the ones that agree longest.
    """
    if not len(positions):
        return np.empty(0, np.int64)
    after = np.append(common[1:], 0)
    return np.maximum(nearest_smaller(positions, common), nearest_smaller(positions[::-1], after[::-1])[::-1])


def later_windows(parts: list[bytes], keys: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and place in it of every window that equals one with a smaller (key, position) in the same group.

    The suffix array covers all places with `length` bytes left in their part. Ranks start from eight bytes and are doubled up to
    `length`, which is as far as a previous factor has to be known; the longest previous factor tells what is a later copy.
    """
    sizes = np.array([len(t) for t in parts], np.int64)
    data = np.frombuffer(b"".join(parts) + bytes(8), np.uint8)
    total = int(sizes.sum())
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(parts)), sizes)
    within = np.arange(total) - begins[owner]
    room = sizes[owner] - within
    rank = np.zeros(total, np.uint64)
    for i in range(8):
        rank = (rank << np.uint64(8)) | np.where(room > i, data[i : i + total], 0).astype(np.uint64)
    rank = np.unique(rank, return_inverse=True)[1] + 1
    covered, levels = 8, []
    while covered < length:
        levels.append((covered, rank))
        step = min(covered, length - covered)
        second = np.zeros(total, np.int64)
        far = np.flatnonzero(room > step)
        second[far] = rank[far + step]
        rank = np.unique(rank * (total + 2) + second, return_inverse=True)[1] + 1
        covered += step
    windows = np.flatnonzero(room >= length)
    part = owner[windows]
    position = starts[part] + within[windows]
    suffixes = windows[np.lexsort((position, keys[part], rank[windows], groups[part]))]
    part = owner[suffixes]
    position = starts[part] + within[suffixes]
    # Places in the order of the texts; a place that two parts cover is one place.
    order = np.lexsort((position, keys[part]))
    new = np.ones(len(order), np.int64)
    new[1:] = (keys[part][order][1:] != keys[part][order][:-1]) | (position[order][1:] != position[order][:-1])
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(new)
    common = _common_prefixes(suffixes, rank, levels, length)
    common[1:][groups[part[1:]] != groups[part[:-1]]] = 0
    later = longest_previous_factors(places, common) >= length
    return part[later], within[suffixes[later]]


def _common_prefixes(suffixes: np.ndarray, rank: np.ndarray, levels: list[tuple[int, np.ndarray]], length: int) -> np.ndarray:
    """How many bytes each suffix has in common with the one before it, `length` at most, as far as ranks tell: in whole steps of
    the levels, least bytes first. Exact where it is `length`."""
    common = np.zeros(len(suffixes), np.int64)
    if len(suffixes) < 2:
        return common
    x, y = suffixes[:-1], suffixes[1:]
    done = np.zeros(len(x), np.int64)
    for covered, ranks in reversed(levels):
        fits = done + covered <= length
        i, j = x + np.where(fits, done, 0), y + np.where(fits, done, 0)
        done += np.where(fits & (ranks[i] == ranks[j]), covered, 0)
    common[1:] = np.where(rank[x] == rank[y], length, np.minimum(done, length - 1))
    return common


def _ordered(batches: Iterator[pa.RecordBatch], length: int, most: int = MOST_PARTS) -> Iterator[pa.RecordBatch]:
    """Parts sorted by sub to rows p, key, start, end, known. Unknown ones are single windows still to be compared."""
    held: list[tuple] = []  # rows of groups that are not yet worked on, in order of sub
    size, crowded = 0, None
    for batch in batches:
        subs, keys, starts, ends = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        part = batch.column(4)
        null = part.is_null().to_numpy(zero_copy_only=False)
        if null.any():
            yield _ranges(mixed(keys[null].view(np.uint64)).view(np.int64), keys[null], starts[null], ends[null], True)
        rows = np.flatnonzero(~null)
        sub_of = subs[rows].tolist()
        for i, sub, bytes_ in zip(rows.tolist(), sub_of, part.filter(pa.array(~null)).to_pylist(), strict=True):
            if held and held[-1][0] != sub and size >= SORTED_BYTES:
                yield from _compared(held, length)
                held, size = [], 0
            if sub == crowded or len(held) >= most and held[-most][0] == sub:
                if sub != crowded:
                    whole = [x for x in held if x[0] == sub]
                    held = held[: len(held) - len(whole)]
                    yield from _compared(held, length)
                    held, size, crowded = [], 0, sub
                    yield from _shard(whole, length)
                held.append((sub, keys[i], starts[i], bytes_))
                if len(held) >= most:
                    yield from _shard(held, length)
                    held = []
                continue
            if crowded is not None:
                yield from _shard(held, length)
                held, size, crowded = [], 0, None
            held.append((sub, keys[i], starts[i], bytes_))
            size += len(bytes_)
    yield from _shard(held, length) if crowded is not None else _compared(held, length)


def _ranges(p: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, known: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(p), pa.array(keys), pa.array(starts), pa.array(ends), pa.array(np.full(len(p), known))],
        names=["p", "key", "start", "end", "known"],
    )


def _columns(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    subs, keys, starts, parts = zip(*rows, strict=True)
    return np.array(subs, np.int64), np.array(keys, np.int64), np.array(starts, np.int64), list(parts)


def _known(part: np.ndarray, within: np.ndarray, keys: np.ndarray, starts: np.ndarray, length: int) -> pa.RecordBatch:
    rows, a, b = _merged(part, within, within + length)
    spread = mixed(mixed(keys[rows].view(np.uint64)) + (starts[rows] + a).astype(np.uint64)).view(np.int64)
    return _ranges(spread, keys[rows], starts[rows] + a, starts[rows] + b, True)


def _compared(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """Later copies within each group of parts that meet."""
    if len(rows) < 2:
        return
    subs = np.array([r[0] for r in rows], np.int64)
    alone = np.ones(len(subs), bool)
    alone[1:] &= subs[1:] != subs[:-1]
    alone[:-1] &= subs[:-1] != subs[1:]
    rows = [r for r, x in zip(rows, alone.tolist(), strict=True) if not x]
    if rows:
        subs, keys, starts, parts = _columns(rows)
        yield _known(*later_windows(parts, keys, starts, subs, length), keys, starts, length)


def _shard(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """A shard of many parts that meet: later copies within it, and the first window of each content, to be settled across shards."""
    if not rows:
        return
    subs, keys, starts, parts = _columns(rows)
    part, within = later_windows(parts, keys, starts, subs, length)
    yield _known(part, within, keys, starts, length)
    sizes = np.array([len(t) for t in parts], np.int64)
    begins = np.cumsum(sizes) - sizes
    first = np.arange(int(sizes.sum())) - np.repeat(begins, sizes) <= np.repeat(sizes - length, sizes)
    first[begins[part] + within] = False
    at = np.flatnonzero(first)
    owner = np.repeat(np.arange(len(parts)), sizes)[at]
    hashes = RangeHash(np.frombuffer(b"".join(parts), np.uint8))
    content = mixed(hashes(at, at + length) ^ mixed(subs[owner].view(np.uint64)))
    position = starts[owner] + at - begins[owner]
    yield _ranges(content.view(np.int64), keys[owner], position, position + length, False)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges sorted by known, p, key, start: the known ones, and of equal windows all but the first."""
    last = None
    for batch in batches:
        p, key, start, end = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        known = batch.column(4).to_numpy(zero_copy_only=False)
        out = known.copy()
        rows = np.flatnonzero(~known)
        if len(rows):
            q, k, s = p[rows], key[rows], start[rows]
            run = np.ones(len(rows), bool)
            run[1:] = q[1:] != q[:-1]
            if last is not None:
                run[0] = q[0] != last[0]
            first = np.maximum.accumulate(np.where(run, np.arange(len(rows)), -1))
            later = (k != k[first]) | (s != s[first])
            if last is not None:
                later[first < 0] = (k[first < 0] != last[1]) | (s[first < 0] != last[2])
            out[rows] = later
            last = (q[-1], k[first[-1]], s[first[-1]]) if first[-1] >= 0 else last
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, start, end)], names=["key", "start", "end"])


def repeated_ranges(docs: DataFrame, length: int) -> DataFrame:
    """key, start, end: bytes of `docs` (key not null, text, ...) covered by windows that start earlier too. May overlap."""
    if not 2 * K <= length < K + (1 << BITS):
        raise ValueError(f"length must be from {2 * K} to {K + (1 << BITS) - 1}")
    shape = F.col("place").bitwiseAND((1 << 2 * BITS) - 1)
    dealt = _segments(docs, length).repartition("p").sortWithinPartitions("p", "content", shape, "key", "place")
    met = dealt.mapInArrow(lambda b: _met(b, length), "key long, kind byte, a long, b long")
    per_key = met.groupBy("key").agg(F.collect_list(F.struct("kind", "a", "b")).alias("found"))
    rest = [c for c in docs.columns if c not in ("key", "text")]
    cut = docs.join(per_key, "key").select("key", "text", "found", *rest)
    parts = cut.mapInArrow(lambda b: _parts(b, length), "sub long, key long, start long, end long, part binary")
    parts = parts.repartition("sub").sortWithinPartitions("sub")
    ordered = parts.mapInArrow(lambda b: _ordered(b, length), "p long, key long, start long, end long, known boolean")
    settled = ordered.repartition("p").sortWithinPartitions("known", "p", "key", "start")
    return settled.mapInArrow(_settled, "key long, start long, end long")


ADDED = ["n_bytes", "n_removed", "n_spans", "kept"]


@apart_from_input
def remove_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans (maximal removed runs) and kept (binary, the remaining bytes).

    Texts are taken as UTF-8 bytes. A byte goes if a string of `length` bytes over it starts earlier too: in a document
    of smaller key, or earlier in the same one; overlapping copies count. Null and empty texts have 0 bytes. A row
    without a key is neither compared nor changed. Rows repeated with one key and text are one document and get the
    same result. Columns of the names added are replaced; all others stay.
    """
    base = docs.drop(*ADDED)
    done = _without_repeated(base, key, text, length, "both")
    return done.select(*_restored(base, key, text, F.when(~F.col("rest.__null"), F.col("text"))), *ADDED)


def measure_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """The key and what `remove_repeated` adds, without the texts themselves."""
    done = _without_repeated(docs.select(key, text), key, text, length, "kept")
    return done.select(F.col("key").alias(key), *ADDED)


@apart_from_input
def drop_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """`docs` with the removed bytes taken out of `text`; bytes of characters that were cut are left out too.

    A null text stays null. Columns and rows stay.
    """
    done = _without_repeated(docs, key, text, length, "text")
    return done.select(*_restored(docs, key, text, F.when(~F.col("rest.__null"), F.col("text"))))


def _restored(base: DataFrame, key: str, text: str, new: Column) -> list[Column]:
    return [
        F.col("key").alias(c) if c == key else new.alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in base.columns
    ]


def _without_repeated(base: DataFrame, key: str, text: str, length: int, give: str) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, then `kept` (bytes) with the old `text` if `give` is "both", alone if it is "kept", or
    the new `text` if it is "text"; and `rest`, the other columns."""
    others = [c for c in base.columns if c not in (key, text)]
    packed = base.select(
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(F.col(text).isNull().alias("__null"), *[F.col(f"`{c}`") for c in others]).alias("rest"),
    )
    # Both joins see the same rows of texts, so these are shuffled once.
    named = packed.where("key IS NOT NULL")
    found = repeated_ranges(named, length).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    none = F.lit(None).cast(found.schema["ranges"].dataType).alias("ranges")
    without = packed.where("key IS NULL").select("key", "text", "rest", none)
    joined = named.join(found, "key", "left").select("key", "text", "rest", "ranges").unionByName(without)
    names = ["key", "n_bytes", "n_removed", "n_spans", *{"both": ["kept", "text"], "kept": ["kept"], "text": ["text"]}[give], "rest"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 * SLICE):
            lists = batch.column(2)
            per_row = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ranges = lists.flatten()
            a, b = (ranges.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            rows, a, b = _merged(np.repeat(np.arange(batch.num_rows), per_row), a, b)
            data, offsets = flat(batch.column(1))
            gone = np.zeros(len(data) + 1, np.int32)
            np.add.at(gone, offsets[rows] + a, 1)
            np.add.at(gone, offsets[rows] + b, -1)
            left = np.cumsum(gone)[:-1] == 0
            ends = np.concatenate([[0], np.cumsum(left)])[offsets]
            n_bytes = np.diff(offsets)
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[left].tobytes())]
            kept = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            columns = {
                "key": batch.column(0),
                "n_bytes": pa.array(n_bytes, pa.int64()),
                "n_removed": pa.array(n_bytes - np.diff(ends), pa.int64()),
                "n_spans": pa.array(np.bincount(rows, minlength=batch.num_rows), pa.int64()),
                "kept": kept,
                "text": batch.column(1),
                "rest": batch.column(3),
            }
            if give == "text":
                columns["text"] = pa.array([x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    counts = [F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = joined.select("key", "text", *counts, F.lit(b"").alias("kept"), "rest").select(names).schema
    return joined.select("key", "text", "ranges", "rest").mapInArrow(work, schema)


def checking_sql(length: int = 100) -> str:
    """The digest of op8 in DuckDB, by grouping every window; for small tables. Bytes are pairs of hex digits."""
    return f"""
WITH coded AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
  SELECT doc_id, i, unhex(substr(h, 2 * i + 1, {2 * length})) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM coded WHERE length(h) >= {2 * length})
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), steps AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {length}, true) AS new FROM later
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM steps
), spans AS (
  SELECT doc_id, run, min(i) AS a, max(i) + {length} AS b FROM numbered GROUP BY doc_id, run
), before AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM spans
), cut AS (
  SELECT c.doc_id, count(*) AS n, sum(b - a) AS removed,
         string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM before s JOIN coded c ON c.doc_id = s.doc_id GROUP BY c.doc_id
)
SELECT c.doc_id, length(c.h) // 2 AS n_bytes, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed, coalesce(k.n, 0) AS n_spans,
       sha256(unhex(coalesce(k.kept, c.h))) AS kept_sha256
FROM coded c LEFT JOIN cut k ON k.doc_id = c.doc_id
"""
