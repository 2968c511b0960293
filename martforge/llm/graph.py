"""Connected components as Spark joins: links and components stay distributed, unless they are few."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import materialize


#: Up to so many edges (16 bytes each) a round's minima are broadcast.
BROADCAST_EDGES = 1_000_000
#: So few edges (8 MB) are settled at once on the driver, where each round would cost several jobs.
DRIVER_EDGES = 500_000


def settled(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges (u, v), ascending, and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v, root = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while len(u):
        u, v = np.maximum(x := root[u], y := root[v]), np.minimum(x, y)
        apart = u != v
        u, v = u[apart], v[apart]
        np.minimum.at(root, u, v)
        while (root != (up := root[root])).any():
            root = up
    return nodes, nodes[root]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component`` of every node that has a link to another; the component is its smallest node.

    More than ``DRIVER_EDGES`` alternate two steps until only stars are left: every node hands its larger neighbours to the smallest one it
    knows, then its smaller neighbours and itself. Each round is written to the shared scratch folder, so a lost
    executor costs one round at most. A hub is merged by partial aggregation and split by the skew join.
    Self links and nulls are ignored; no links give an empty result.
    """
    edge = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edge = materialize(edge, "components")
    edges = edge.count()
    if 0 < edges <= DRIVER_EDGES:
        few = edge.toArrow()
        found = settled(few.column("u").to_numpy(), few.column("v").to_numpy())
        return materialize(edge.sparkSession.createDataFrame(pa.table(found, ["node", "component"])), "components")
    # a round keeps or lowers the number of edges but for one a node; few of them are joined without a shuffle
    near = F.broadcast if edges <= BROADCAST_EDGES else (lambda frame: frame)
    for _ in range(rounds):
        # Stars only: each child has one parent, and no parent is a child.
        ends = (edge.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
                .unionByName(edge.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
                .groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")))
        if ends.filter("child + parent > 1").isEmpty():
            return edge.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(near(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(near(least), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))).distinct()
        edge = materialize(small, "components")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def more_components(links: DataFrame, known: DataFrame | None) -> DataFrame:
    """``connected_components`` of new links (a, b) and of those that made ``known`` (node, component), which it replaces:
    earlier links are not read again."""
    if known is not None:
        links = links.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return connected_components(links)
