"""Connected components of a link table, without collecting links anywhere.

Links are first contracted inside each task (union-find over one batch at a time), then
large-star and small-star steps alternate until every node points straight at the smallest
node of its component.  Each step is an aggregate (map-side combined, so a hub sends one row
per task) and an equi-join of two staged tables, which AQE can split at a hub.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.staging import stage

_MAX_ROUNDS = 60


class Forest:
    """Union-find over hashable nodes; the smallest node of a set is its root."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def link(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        lo, hi = (a, b) if a < b else (b, a)
        self.parent[hi] = lo
        return True

    def stars(self) -> tuple[list, list]:
        nodes = [x for x in self.parent if self.find(x) != x]
        return nodes, [self.find(x) for x in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forest = Forest()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if a != b:
                forest.link(a, b)
        u, v = forest.stars()
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                         names=["u", "v"])


def connected_components(links: DataFrame) -> DataFrame:
    """``links``: two bigint columns.  Returns ``(node, component)`` for every linked node,
    ``component`` being the smallest node reachable; nodes without a link to another node do
    not appear.  Null ends are ignored; an empty table gives an empty result."""
    a, b = links.columns[:2]
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = edges.where("u is not null and v is not null and u <> v")
    edges = stage(edges.mapInArrow(_contract, "u long, v long"), "links")
    seen = None
    for _ in range(_MAX_ROUNDS):
        # large-star: each larger neighbour of u points at the smallest node around u
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"),
                                                            F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), "star-min")
        large = stage(both.join(low, "u").where("v > u").select(F.col("v").alias("u"),
                                                                F.col("m").alias("v"))
                      .where("u <> v").distinct(), "large-star")
        # small-star: u and its smaller neighbours point at the smallest of them
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "star-min")
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v"))
        edges = stage(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(),
                      "small-star")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                 F.lit(0))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
