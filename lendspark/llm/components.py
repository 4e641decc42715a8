"""Connected components of an edge table by union-find inside tasks and
star rounds between them.  Nothing but one counter reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


class UnionFind:
    """Path-halving union-find whose root is the smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.parent
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the edges of blocks of a task by (node, smallest node joined to it)."""
    for pdf in parts:
        uf = UnionFind()
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            uf.union(a, b)
        nodes = [x for x in uf.parent if uf.find(x) != x]
        yield pd.DataFrame({"u": nodes, "v": [uf.find(x) for x in nodes]}, dtype="int64")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(u long, v long) -> (node, component): the smallest node reachable,
    for every node of an edge with two different ends.

    A round first contracts what a task holds (bounded by its Arrow batches),
    then makes large stars (each larger neighbour of a node points to the
    node's smallest neighbour) and small stars (each smaller one does).  The
    sums are partial aggregates and the joins are ones that adaptive execution
    can split, so a hub with a third of all edges is spread over tasks.
    Empty input gives an empty result; nulls and loops are ignored.
    """
    now = stored(edges.where("u <> v").select("u", "v").mapInPandas(_forest, "u long, v long").distinct(), "forest")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # large: u points to a smaller node; small stars link the other smaller neighbours to the least one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
