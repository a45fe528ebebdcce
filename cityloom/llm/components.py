"""Connected components of a link table, in written rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import materialise


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` of type long): ``root`` is the smallest node
    that can be reached, the node itself included.

    Rounds of large and small stars, each written to the shared folder, until the links are one star per
    component; their number grows with the logarithm of the longest path. Neighbours are never gathered in
    one task: a node's smallest neighbour is an aggregate, which is joined back to its links. Links of a node
    with itself are allowed; rows with a null end are ignored.
    """
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), label)

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return row[0], row[1]

    before = None
    now = mark(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a OR a = b").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.distinct(), label)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), label)
        before, now = now, mark(edges)
    rooted = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rooted.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(
        F.min("root").alias("root")
    )


class Forest:
    """Union-find over array positions, for links that come in batches."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.parent[x]
        while True:
            up = self.parent[root]
            if np.array_equal(up, root):
                return root
            root = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.find(a), self.find(b)
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """A star per tree: (member, root) for every member that is not its root."""
        all_roots = self.find(np.arange(len(self.parent)))
        member = np.flatnonzero(all_roots != np.arange(len(self.parent)))
        return member, all_roots[member]
