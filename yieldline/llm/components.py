"""Connected components by alternating stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.session import new_folder
from yieldline.sources.tables import remove_folder


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts the lineage and gives exact sizes."""
    folder = new_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def discard(*frames: DataFrame) -> None:
    """Delete tables that `stored` wrote and that nothing reads any more."""
    for frame in frames:
        for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            remove_folder(frame.sparkSession, folder)


def _toward_least(edges: DataFrame, only_larger: bool) -> DataFrame:
    """For each node: link its neighbours (only the larger ones, or itself and the smaller ones) to the least of them.

    Links to larger ones may be repeated, but there are no more of them than edges.
    """
    if only_larger:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.join(least, "a").where("b > a AND b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """id, component (the smallest id that links reach) of every id in `links` (columns a and b).

    Links to itself and links with a null are ignored; repeated links count once. Rounds grow with the logarithm of a
    component's width. A node's neighbours are combined map-side before they meet.

    With `rounds`, so many rounds and no look whether they were enough: nodes of one component are still linked, but some that
    are linked may have different ones, so all links have to be looked at again later.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored(edges, "links"), None
    if rounds is not None:
        for _ in range(rounds):
            edges = stored(_toward_least(_toward_least(edges, True), False), "links")
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")))
        return ends.groupBy("id").agg(F.min("component").alias("component"))
    while True:
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == before or not found[0]:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        before = found
        edges = stored(_toward_least(_toward_least(edges, True), False), "links")
