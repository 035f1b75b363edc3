"""Near duplicates by word shingles: a grouped prefix join, exact for any threshold.

1. Documents with equal sets are a class. A shingle that no other class has is in no overlap, so a class with too many of them
   links with nothing. This is seen on three in eight shingles first, which leaves few classes, and then on all of theirs.
2. Shingles that lie in exactly the same classes are one item with a weight, so a passage is an item however long it is. Items
   are ordered by their number of classes, rare ones first; every class's prefix is so much of its weight that two classes
   that link share an item of it. Counts are exact, and nothing is broadcast.
3. Classes of equal prefix and size are a group. Groups that share prefix items are paired, pairs that share too little are
   dropped, and only then members are expanded and verified on whole texts. What is connected already is not compared
   again: first each group is tried with the hub that it shares most with, round by round with other hubs, then each class with
   the one most alike of some hubs, then whatever is still apart.
4. An item that many groups have is not paired as it is. Classes that link share two items of somewhat longer prefixes, three
   of still longer ones, and so on: the item's list is dealt out by a second item, long ones of these lists by a third,
   for as long as that makes fewer rows than pairing would. So texts of common paragraphs meet where they share nearly all.
   A pair of a list is a row only if the parities of both classes' shingles leave room for a link.

Counts are combined before they are shuffled, and tables that rows are joined with are written first, so that adaptive
execution can split a shingle or an item that many classes have. A lost executor costs its own tasks only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldline.llm.columns import give_back, mixed, slices
from yieldline.llm.components import components, discard, stored
from yieldline.llm.shingles import SLICE, shingle_sets

# At most so many rounds in which groups are tried with hubs before all that is apart is paired, as long as one in so many of
# the pairs tried links, and so many hubs of an item from which each class tries the one most alike. They decide speed only.
ROUNDS, WORTH, HUBS = 2, 5, 4
# Bits by which most texts of no class are told before they are shuffled are 2 to this at most, and those of a part. Speed only.
MOST_MARKS, PART_MARKS = 28, 15
# Words of 64 parities that a class has. Speed only.
PARITIES = 16
# An item or list of so many groups or classes is paired as it is, and so many items are taken together at most. Speed only.
SHORT, LEVELS = 8, 4
# Classes whose items a task looks at together.
CLASSES = 128


def _keys(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))


def _fingerprints(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Two 64-bit sums over each set that do not depend on its order."""
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    out = []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(flat ^ mixed(np.array([salt], np.uint64))), dtype=np.uint64)])
        out.append((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64))
    return out


def set_sizes(docs: DataFrame, words: int) -> DataFrame:
    """id, n, fa, fb: size and fingerprints of each document's set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column(1), words)
            sizes = pa.array([len(s) for s in sets], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *map(pa.array, _fingerprints(sets))], names=["id", "n", "fa", "fb"])

    return docs.mapInArrow(work, "id long, n int, fa long, fb long")


def some_shingles(docs: DataFrame, words: int) -> DataFrame:
    """h, c: three in eight shingles, chosen by their hash, with the class they are in.

    A class that shares nothing then has three eighths of its shingles here for its own, where a quarter rules out any link.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column(0), words)
            classes, first = np.unique(_fingerprints(sets)[0], return_index=True)
            some = [sets[i][sets[i] % 8 < 3] for i in first.tolist()]
            owners = np.repeat(classes, [len(s) for s in some])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(some).view(np.int64)), pa.array(owners)], names=["h", "c"])

    return docs.select("text").mapInArrow(work, "h long, c long")


def _prefix_length(percent: int) -> Column:
    return F.expr(f"n - ceil({percent} * n / 100.0) + 1")


def may_link(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """`classes` less those that are seen to have more shingles of their own than a class that links can have."""
    alone = some_shingles(docs, words).groupBy("h").agg(F.min("c").alias("fa"), F.max("c").alias("top")).where("fa = top")
    known = alone.groupBy("fa").agg(F.count(F.lit(1)).alias("own"))
    return classes.join(known, "fa", "left").where(F.coalesce("own", F.lit(0)) < _prefix_length(percent)).drop("own")


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, of each of 64 * PARITIES hash values whether an odd number of members has it, as bits of a row of integers.

    Two sets differ in at least as many members as in parities.
    """
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    place = mixed(flat) % np.uint64(64 * PARITIES)
    word = np.repeat(np.arange(len(sets)) * PARITIES, [len(s) for s in sets]) + (place >> np.uint64(6)).astype(np.int64)
    out = np.zeros(len(sets) * PARITIES, np.uint64)
    np.bitwise_xor.at(out, word, np.uint64(1) << (place & np.uint64(63)))
    return out.view(np.int64).reshape(len(sets), PARITIES)


def _marks(ids: DataFrame) -> np.ndarray:
    """Bits, some sixteen for each of `ids` and MOST_MARKS at most, of which those at the place of an id are set."""
    bits = 1 << min(MOST_MARKS, max(PART_MARKS, (16 * ids.count()).bit_length()))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    parts = ids.groupBy((place / F.lit(1 << PART_MARKS)).cast("int").alias("part")).agg(F.bitmap_construct_agg(place % (1 << PART_MARKS)).alias("bits"))
    marks = np.zeros(bits // 8, np.uint8)
    for part in parts.toLocalIterator():
        first = part["part"] << (PART_MARKS - 3)
        marks[first : first + (1 << (PART_MARKS - 3))] = np.frombuffer(part["bits"], np.uint8)
    return marks


def class_texts(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """node, n, text, bits: one text of each class, and parities of its shingles. A key that has several texts counts with the
    one that is of the class.

    Texts whose key has no mark are of no class; the others, among them all that are wanted, are shuffled.
    """
    wanted = classes.select(F.col("rep").alias("id"), "node", "n", "fa", "fb")
    marks = _marks(wanted)
    sent = docs.sparkSession.sparkContext.broadcast(marks)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(2).to_numpy() % (8 * len(sent.value))
            some = (sent.value[place >> 3] >> (place & 7)) & 1
            kept = batch.select(["id", "text"]).filter(pa.array(some.astype(bool)))
            for part in slices([kept], "text", SLICE):
                sets = shingle_sets(part.column(1), words)
                bits = parities(sets)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * PARITIES), pa.array(bits.ravel()))
                found = [pa.array(f) for f in _fingerprints(sets)]
                yield pa.RecordBatch.from_arrays([*part.columns, *found, lists], names=["id", "text", "fa", "fb", "bits"])

    rows = docs.select("id", "text", F.xxhash64("id").alias("place"))
    rows = rows.mapInArrow(marked, "id long, text string, fa long, fb long, bits array<long>")
    # A node's rows have one key and lie together after the join.
    return rows.join(wanted, ["id", "fa", "fb"]).dropDuplicates(["id", "fa", "fb", "node"]).select("node", "n", "text", "bits")


def all_shingles(texts: DataFrame, words: int) -> DataFrame:
    """h, node, n of all shingles of the classes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            sets = shingle_sets(batch.column(2), words)
            sizes = [len(s) for s in sets]
            flat = np.concatenate(sets).view(np.int64)
            columns = [flat, *(np.repeat(np.asarray(batch.column(i)), sizes) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "node", "n"])

    return texts.mapInArrow(work, "h long, node long, n int")


def depths(weights: list[int], own: int, slack: int) -> tuple[list[int], int]:
    """For each of a class's items the least l whose l-prefix has it, and the largest l with a prefix.

    A class that links misses `slack` of its weight at most, `own` of which no other class has. The l-prefix is the shortest
    beginning whose weight without its l - 1 heaviest items is more than that, so that a class that links has l items of it.
    """
    out, most = [0] * len(weights), 0
    for level in range(1, LEVELS + 1):
        heaviest: list[int] = []
        weight, end = own, None
        for i, w in enumerate(weights):
            weight += w
            heapq.heappush(heaviest, w)
            if len(heaviest) > level - 1:
                heapq.heappop(heaviest)
            if weight - sum(heaviest) > slack:
                end = i + 1
                break
        if end is None:
            break
        most = level
        for i in range(end):
            out[i] = out[i] or level
    return out, most


def prefixes(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """node, n, item, weight, place, depth, after, reach, most: the items of each class's prefixes, rarest first.

    depth: the least l whose l-prefix has the item; the plain prefix has those of depth 1. after: weight of the plain prefix from
    the item's second shingle on. reach: weight of the plain prefix with the shingles that only this class has. most: the
    largest l with a prefix. Classes with too little in common with all others together have no rows.
    """
    entries = all_shingles(texts, words)
    lists = entries.groupBy("h").agg(
        F.count(F.lit(1)).alias("classes"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    lists = stored(lists.where("classes > 1"), "lists")
    items = entries.join(lists, "h").groupBy("node", "n", "classes", "x", "y").agg(F.count(F.lit(1)).alias("weight"))
    each = F.sort_array(F.collect_list(F.struct("classes", F.xxhash64("classes", "x", "y").alias("item"), "weight")))
    whole = items.groupBy("node", "n").agg(each.alias("items"), F.sum("weight").alias("common"))
    whole = whole.where(F.col("common") * 100 >= percent * F.col("n"))
    whole = whole.select("node", "n", "common", F.col("items.item").alias("item"), F.col("items.weight").alias("weight"))
    schema = "node long, n int, item long, weight long, place int, depth int, after long, reach long, most int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, CLASSES) for whole in batches for at in range(0, whole.num_rows, CLASSES)):
            rows: list[tuple] = []
            for node, n, common, ids, weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                depth, most = depths(weights, n - common, n - -(-percent * n // 100))
                left = sum(w for w, d in zip(weights, depth, strict=True) if d == 1)
                reach = n - common + left
                for place, (item, w, d) in enumerate(zip(ids, weights, depth, strict=True)):
                    if d:
                        rows.append((node, n, item, w, place, d, left - 1 if d == 1 else 0, reach, most))
                    left -= w
            kinds = [f.split()[1] for f in schema.split(", ")]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            types = [pa.int32() if k == "int" else pa.int64() for k in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in schema.split(", ")])
        give_back()

    return whole.mapInArrow(work, schema)


def grouped(prefix: DataFrame) -> DataFrame:
    """node, n, reach, leader, members: classes with the same prefix and size are a group, led by the least of them."""
    heads = prefix.where("depth = 1").groupBy("node", "n", "reach").agg(F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"))
    groups = heads.groupBy("n", "reach", "x", "y").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members"))
    return heads.join(stored(groups, "groups"), ["n", "reach", "x", "y"]).select("node", "n", "reach", "leader", "members")


def shared_items(prefix: DataFrame, members: DataFrame) -> DataFrame:
    """item, g, n, reach, weight, after: prefix items that two groups or more have. A group stands for all its members."""
    leaders = members.where("node = leader").select("node")
    rows = prefix.where("depth = 1").join(leaders, "node", "left_semi").withColumnRenamed("node", "g")
    several = rows.groupBy("item").agg(F.min("g").alias("low"), F.max("g").alias("top")).where("low < top").select("item")
    return rows.join(stored(several, "several"), "item", "left_semi").select("item", "g", "n", "reach", "weight", "after")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of `pairs` (a, b) whose whole shingle sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", SLICE // 2):
            good = []
            for x, y in zip(shingle_sets(batch.column(2), words), shingle_sets(batch.column(3), words), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(mask) for i in (0, 1)], names=["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("n").alias("n_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("n").alias("n_b"))
    joined = pairs.select("a", "b").join(one, "a").join(other, "b").where(_near(percent)).select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(compare, "a long, b long")


def _near(percent: int) -> Column:
    return F.expr(f"least(n_a, n_b) * 100L >= greatest(n_a, n_b) * {percent}L")


# Number of differing parities of two classes.
DIFFER = " + ".join(f"bit_count(bits_a[{i}] ^ bits_b[{i}])" for i in range(PARITIES))


def _room(percent: int) -> Column:
    """Whether two classes that differ in all shingles whose parities differ, and in no others, link. Those that link do."""
    return F.expr(f"(n_a + n_b - ({DIFFER})) * {100 + percent}L >= (n_a + n_b) * {2 * percent}L")


def _needed(percent: int) -> Column:
    """How much weight the prefixes of two classes that link share at least: what is left of the overlap when all that lies
    behind the prefix that ends first is common."""
    return F.expr(f"ceil({percent} * (n_a + n_b) / {100 + percent}.0 - 1e-9) - greatest(n_a - reach_a, n_b - reach_b)")


def _side(rows: DataFrame, side: str, *more: str) -> DataFrame:
    renamed = [F.col("g").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "reach", *more)]]
    return rows.select("item", *renamed)


def _joined(labelled: DataFrame, links: DataFrame, rounds: int | None = None) -> DataFrame:
    """`labelled` (node, component, ...) with the components that `links` connect made one, or with `rounds` most of them. Looks at
    links between components only."""
    ends = labelled.select("node", "component")
    edges = links.join(ends.toDF("a", "c_a"), "a").join(ends.toDF("b", "c_b"), "b").where("c_a <> c_b")
    moved = components(edges.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")), rounds).select(F.col("id").alias("component"), F.col("component").alias("to"))
    after = labelled.join(moved, "component", "left").withColumn("component", F.coalesce("to", "component"))
    return stored(after.select(labelled.columns), "labelled")


def _spread(labelled: DataFrame) -> DataFrame:
    """g, low, top, size: least and greatest component among the members of each group, and the least one's number of classes."""
    sizes = labelled.groupBy(F.col("component").alias("low")).agg(F.count(F.lit(1)).alias("size"))
    spread = labelled.groupBy(F.col("leader").alias("g")).agg(F.min("component").alias("low"), F.max("component").alias("top"))
    return spread.join(sizes, "low").select("g", "low", "top", "size")


def _hub_pairs(shared: DataFrame, spread: DataFrame, percent: int, turn: int = 0) -> DataFrame:
    """Each group with the hub that it shares most with, if that is half as much as a link needs.

    An item's hub is one of its groups in the largest component, another one in each turn but mostly the same one for the items
    of like groups; groups of other components are tried with it. So there is a row for each item of a group. Some links are
    not tried here; they are found among what stays apart.
    """
    rows = shared.join(spread, "g")
    hub = F.min(F.struct((-F.col("size")).alias("size"), "low", F.xxhash64("g", F.lit(turn)).alias("turn"), "g", "n", "reach"))
    hubs = rows.groupBy("item").agg(hub.alias("hub"), F.min("low").alias("least"), F.max("top").alias("top")).where("least < top")
    hubs = stored(hubs.select("item", "hub"), "hubs")
    met = _side(rows, "a", "weight", "low").join(hubs, "item").where("a <> hub.g AND low_a <> hub.low")
    met = met.select("a", "n_a", "reach_a", F.col("hub.g").alias("b"), F.col("hub.n").alias("n_b"), F.col("hub.reach").alias("reach_b"), "weight_a")
    counted = met.groupBy("a", "b", "n_a", "n_b", "reach_a", "reach_b").agg(F.sum("weight_a").alias("weight"))
    likely = counted.where(_near(percent) & (2 * F.col("weight") >= _needed(percent)))
    return likely.groupBy("a").agg(F.max_by("b", F.struct("weight", -F.col("b"))).alias("b"))


def _likely_pairs(prefix: DataFrame, labelled: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Each class with the one whose parities differ least from its own, of HUBS hubs of each of its prefix items in the largest
    component there, if it is in another one and both may link.

    So a class that links with many of a component is joined to it by a pair, before all that is apart is paired.
    """
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    places = stored(labelled.select("node", "component").join(sizes, "component"), "places")
    rows = prefix.where("depth = 1").select("item", "node").join(places, "node")
    hub = [F.min(F.struct((-F.col("size")).alias("size"), "component", F.xxhash64("node", F.lit(k)).alias("turn"), "node")) for k in range(HUBS)]
    hubs = rows.groupBy("item").agg(
        F.min("component").alias("least"), F.max("component").alias("top"), *[h.alias(f"hub{k}") for k, h in enumerate(hub)]
    )
    each = F.array_distinct(F.array(*[f"hub{k}.node" for k in range(HUBS)])).alias("hubs")
    hubs = stored(hubs.where("least < top").select("item", F.col("hub0.component").alias("to"), each), "hubs")
    met = rows.join(hubs, "item").where("component <> to").select(F.col("node").alias("a"), F.explode("hubs").alias("b")).distinct()
    known = texts.select("node", "n", "bits")
    both = met.join(known.toDF("a", "n_a", "bits_a"), "a").join(known.toDF("b", "n_b", "bits_b"), "b").where(_near(percent) & _room(percent))
    return both.groupBy("a").agg(F.min_by("b", F.struct(F.expr(f"({DIFFER}) / (n_a + n_b)"), "b")).alias("b"))


def still_apart(shared: DataFrame, spread: DataFrame) -> DataFrame:
    """Rows of items whose groups are not all in one component, with `long`: whether the item has many groups."""
    rows = shared.join(spread, "g")
    apart = rows.groupBy("item").agg(F.min("low").alias("least"), F.max("top").alias("greatest"), F.count(F.lit(1)).alias("groups"))
    apart = stored(apart.where("least < greatest").select("item", (F.col("groups") > SHORT).alias("long")), "apart")
    return stored(rows.join(apart, "item"), "apart-rows")


def meetings(apart: DataFrame, percent: int) -> DataFrame:
    """A row for each item without many groups, of two groups of alike size that are not in one component.

    Half of the weight that a link needs is enough evidence, so an item counts only if so much comes after it in both
    prefixes: of a pair's common items that leaves out the last ones, the most frequent, and no more than that half.
    """
    unpaired = apart.groupBy("g").agg(F.sum(F.when(F.col("long"), F.col("weight")).otherwise(0)).alias("unpaired"))
    rows = apart.where("NOT long").join(unpaired, "g")
    half = F.floor(_needed(percent) / 2)
    met = _side(rows, "a", "weight", "after", "low", "top", "unpaired").join(_side(rows, "b", "after", "low", "top", "unpaired"), "item")
    unlike = F.expr("a < b AND NOT (low_a = top_a AND low_b = top_b AND low_a = low_b)")
    return met.where(unlike & _near(percent) & (F.least("after_a", "after_b") >= half))


def group_pairs(apart: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups that are not in one component and may share as much prefix weight as a link needs: what they share of
    items without many groups, and at most all of the others."""
    met = meetings(apart, percent)
    counted = met.groupBy("a", "b", "n_a", "n_b", "reach_a", "reach_b", "unpaired_a", "unpaired_b").agg(F.sum("weight_a").alias("weight"))
    weight = F.col("weight") + F.least("unpaired_a", "unpaired_b")
    return counted.where(weight >= _needed(percent) - F.floor(_needed(percent) / 2)).select("a", "b")


def _met_in(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of alike size and different components with the same list that may link; of a long list, those of a
    stuck class and any other. Classes in a list's largest component need not look for others, as others look for them; of
    two others one looks.

    Every pair that links passes in the list of the first item that both have: it has no list before, and enough weight from
    there on.
    """
    names = {"node": "", "component": "c_", "n": "n_", "bits": "bits_", "rest": "rest_", "before": "before_"}
    # All of a short list meet as 0; in a long one stuck classes look for all as 1, and all look for stuck ones as 2.
    looks = F.explode(F.expr("CASE WHEN NOT long THEN array(0) WHEN stuck THEN array(1, 2) ELSE array(2) END")).alias("kind")
    found = F.explode(F.expr("CASE WHEN NOT long THEN array(0) WHEN stuck THEN array(1, 2) ELSE array(1) END")).alias("kind")
    x = rows.where("component <> largest").select("list", looks, "largest", *[F.col(c).alias(f"{to}a") for c, to in names.items()])
    y = rows.select("list", found, *[F.col(c).alias(f"{to}b") for c, to in names.items()])
    apart = F.expr("c_a <> c_b AND (a < b OR c_b = largest) AND coalesce(before_a <> before_b, true)")
    enough = F.expr(f"least(rest_a, rest_b) * {100 + percent}L >= (n_a + n_b) * {percent}L")
    met = x.join(y, ["list", "kind"]).where(apart & _near(percent) & enough & _room(percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def pairs_of_long_lists(apart: DataFrame, prefix: DataFrame, labelled: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share an item which many groups have, and as many more as it takes to make their list short.

    A list is dealt out by the items that its classes have ahead if that makes less than half of the rows that pairing it
    makes, which is counted first. A class without an l-prefix cannot be dealt out to l items and is paired with its list.
    rest: a class's weight from the item on; before: the last of these items that it has before.
    """
    items, bits = apart.where("long").select("item").distinct(), texts.select("node", "bits")
    rows = prefix.where("depth = 1").join(items, "item", "left_semi").join(labelled.select("node", "component"), "node")
    before = F.lag("item").over(Window.partitionBy("node").orderBy("place")).alias("before")
    rest = F.expr("n - reach + after + 1").alias("rest")
    rows = stored(rows.select(F.col("item").alias("list"), "node", "n", "component", "place", "most", rest, before), "long")
    pairs = rows.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in range(2, LEVELS + 2):
        if rows.isEmpty():
            break
        later = prefix.where(F.col("depth") <= level).select("node", F.col("place").alias("next"), "item")
        ahead = later.groupBy("node").agg(F.collect_list("next").alias("ahead"))
        sized = rows.join(ahead, "node").withColumn("ahead", F.size(F.filter("ahead", lambda x: x > F.col("place"))))
        parts = sized.groupBy("list", "component").agg(F.count(F.lit(1)).alias("rows"), F.sum("ahead").alias("ahead"))
        lists = parts.groupBy("list").agg(
            F.sum("rows").alias("rows"), F.sum("ahead").alias("ahead"), F.max_by("component", "rows").alias("largest"), F.count(F.lit(1)).alias("parts")
        )
        lists = stored(lists.where("parts > 1").select("list", "rows", "ahead", "largest"), "lists")
        long = lists.where(F.expr(f"rows > {SHORT} AND 8 * ahead < rows * rows") & F.lit(level <= LEVELS))
        dealt = rows.join(long.select("list"), "list", "left_semi").where(F.col("most") >= level).join(later, "node").where("next > place")
        dealt = stored(dealt, "dealt")
        each = dealt.groupBy("list", "item").agg(F.count(F.lit(1)).alias("m")).groupBy("list").agg(F.sum(F.expr("m * m + 2 * m")).alias("after"))
        worth = stored(lists.join(each, "list").where("2 * after < rows * rows").select("list", F.lit(True).alias("long")), "worth")
        rows = rows.join(lists.select("list", "largest"), "list").join(worth, "list", "left").withColumn("long", F.coalesce("long", F.lit(False)))
        known = stored(rows.join(bits, "node").withColumn("stuck", F.col("most") < level), "known")
        pairs = pairs.unionByName(stored(_met_in(known, percent), "pairs"))
        discard(known)
        going = dealt.join(worth.select("list"), "list", "left_semi")
        rows = going.select(F.xxhash64("list", "item").alias("list"), "node", "n", "component", F.col("next").alias("place"), "most", "rest", "before")
        rows = stored(rows, "long")
    return pairs


def _members_apart(pairs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Pairs of classes of different components: of paired groups, and within a group."""
    each = labelled.select("leader", "node", "component")
    x = each.select(F.col("leader").alias("a"), F.col("node").alias("x"), F.col("component").alias("c_x"))
    y = each.select(F.col("leader").alias("b"), F.col("node").alias("y"), F.col("component").alias("c_y"))
    across = pairs.join(x, "a").join(y, "b").where("c_x <> c_y")
    inside = labelled.where("members > 1").select(F.col("leader").alias("a"), F.col("node").alias("x"), F.col("component").alias("c_x"))
    inside = inside.join(y.withColumnRenamed("b", "a"), "a").where("x < y AND c_x <> c_y")
    return across.select("x", "y").unionByName(inside.select("x", "y")).toDF("a", "b")


def components_of(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """node, component: for classes that may link, the component that links reach, named by one of its classes."""
    prefix = stored(prefixes(texts, words, percent), "prefixes")
    members = stored(grouped(prefix), "members")
    shared = stored(shared_items(prefix, members), "shared")

    def linked(pairs: DataFrame) -> DataFrame:
        return stored(verified(pairs, texts, words, percent), "links")

    labelled, known = members.withColumn("component", F.col("node")), []
    tried = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    for turn in range(ROUNDS):
        tried = stored(tried.unionByName(_hub_pairs(shared, _spread(labelled), percent, turn)), "tried")
        found, most = linked(tried), tried.count()
        links = found.count()
        if links:
            labelled = _joined(labelled, found, 1)
            known.append(found)
        if links * WORTH < most or not links:
            break
        tried = tried.limit(0)
    found = linked(stored(_likely_pairs(prefix, labelled, texts, percent), "tried"))
    if not found.isEmpty():
        labelled = _joined(labelled, found, 1)
        known.append(found)
    apart = still_apart(shared, _spread(labelled))
    pairs = stored(group_pairs(apart, percent), "pairs")
    among = _members_apart(pairs, labelled).unionByName(pairs_of_long_lists(apart, prefix, labelled, texts, percent)).distinct()
    labelled = _joined(labelled, reduce(DataFrame.unionByName, known, linked(among))).select("node", "component")
    discard(prefix, shared, members, pairs, apart)
    return labelled


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """Per document: key, n_shingles, component_id.

    Two documents link when 100 * intersection >= percent * union of their sets of `words`-word shingles;
    component_id is the smallest key that links reach. Null and empty texts have no shingles and link with nothing. A
    row without a key gets n_shingles and a null component, and links with nothing. Rows of one key are one document, each
    returned with its own n_shingles; it links with what any of their texts links with. An empty table gives no rows. Other
    columns are not read.

    Shingles are compared as 64-bit hashes.
    """
    rows = _keys(docs, key, text)
    sets = stored(set_sizes(rows, words), "sets")
    real = sets.where("id IS NOT NULL AND n > 0")
    classes = real.groupBy("n", "fa", "fb").agg(F.min("id").alias("rep"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    left = stored(may_link(rows.where("id IS NOT NULL"), classes, words, percent), "may-link")
    texts = stored(class_texts(rows, left, words), "texts")
    found = components_of(texts, words, percent)
    labelled = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    one = F.struct("n", "fa", "fb")
    repeated = real.groupBy("id").agg(F.min(one).alias("least"), F.max(one).alias("most")).where("least <> most").select("id")
    repeated = stored(repeated, "repeated")
    if not repeated.isEmpty():
        same = real.join(repeated, "id").join(classes, ["n", "fa", "fb"])
        least = same.groupBy("id").agg(F.min("node").alias("b"))
        labelled = _joined(labelled, same.select("id", F.col("node").alias("a")).join(least, "id").select("a", "b"))
    discard(texts, left)

    least = labelled.groupBy("component").agg(F.min("rep").alias("least"))
    answer = labelled.join(least, "component").select("n", "fa", "fb", "least")
    return sets.join(answer, ["n", "fa", "fb"], "left").select(
        F.col("id").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """`docs` without all but the first document (smallest key) of each group of near duplicates.

    Rows without a key stay; repeated rows of a kept key all stay.
    """
    found = near_duplicates(docs, key, text, words, percent).where(F.col(key) != F.col("component_id"))
    return docs.join(found.select(key), key, "left_anti").select(docs.columns)


def checking_sql(words: int = 5, percent: int = 75) -> str:
    """Sizes and components in DuckDB, by joining whole shingle sets; for small tables."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    return rf"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s FROM listed)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes i ON i.doc_id = x JOIN sizes j ON j.doc_id = y WHERE 100 * c >= {percent} * (i.n + j.n - c)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id
"""
