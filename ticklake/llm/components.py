"""Connected components of a table of links, as rounds of joins and aggregates.

Each partition first reduces its links with a local union-find; then the
large-star and small-star rounds of Kiveris et al. ("Connected Components in
MapReduce and Beyond", 2014) run until the links are stars around the smallest
node of each component. Every round is written out, so a lost executor costs
one round at most. Hubs are aggregated before the shuffle and AQE splits their
side of the joins; nothing is gathered on the driver but a number a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

LINK = "a long, b long"
LOCAL_NODES = 1_000_000  # nodes a task holds at a time


class UnionFind:
    """Plain union-find over longs; the root of a set is its smallest member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (p := up.get(root, root)) != root:
            root = p
        while (p := up.get(x, x)) != root and p != x:
            up[x], x = root, p
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            lo, hi = (a, b) if a < b else (b, a)
            self.up[hi] = lo
            self.up.setdefault(lo, lo)


def local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of a task by (node, smallest node reachable within the task)."""
    def stars(uf: UnionFind) -> pa.RecordBatch:
        nodes = np.fromiter(uf.up, np.int64, len(uf.up))
        roots = np.fromiter((uf.find(int(x)) for x in nodes), np.int64, len(nodes))
        far = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(roots[far])], ["a", "b"])

    uf = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            uf.union(a, b)
        if len(uf.up) >= LOCAL_NODES:
            yield stars(uf)
            uf = UnionFind()
    yield stars(uf)


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller one at most, and what it points to has none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").count() == 0


def stars(links: DataFrame, a: str = "a", b: str = "b", rounds: int | None = None, rows: int | None = None) -> tuple[DataFrame, bool]:
    """Links (a, b) from larger to smaller nodes that connect what `links` connect, written; and whether they are stars
    around the smallest nodes. With `rounds` they may not be there yet after so many. `rows`: how many links there are,
    if that is known; as few as one task holds at a time need no rounds."""
    far = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    if rows is not None and rows < LOCAL_NODES // 2:
        return saved(far.coalesce(1).mapInArrow(local_stars, LINK), "links"), True
    cur = saved(far.repartition("a").mapInArrow(local_stars, LINK), "links")
    # links so few that AQE left them to one task are stars already
    done = len(cur.inputFiles()) <= 1 and cur.count() < LOCAL_NODES // 2
    while not done and rounds != 0:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.where("a <> b").select("a", "b").distinct()
        # every link now points from the larger to the smaller node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = saved(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        rounds = None if rounds is None else rounds - 1
        done = rounds != 0 and _are_stars(cur)
    return cur, done


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest
    node reachable. Nulls, self-links, repeated and reversed links are allowed; no links: no rows."""
    return nodes(stars(links, a, b)[0])


def nodes(cur: DataFrame) -> DataFrame:
    """(node, component) of stars."""
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
