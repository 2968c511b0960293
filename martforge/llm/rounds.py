"""Comparing the members of many overlapping groups in rounds, without all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm import materialize
from martforge.llm.graph import more_components

#: So many pairs are compared in one round without looking for shorter ways.
FEW = 50_000
#: Broadcast at most so many class keys (8 bytes each); beyond it they are joined by shuffle.
BROADCAST_KEYS = 2_000_000


def near(keys: DataFrame, at_most: int) -> DataFrame:
    """Broadcast if there are few enough of them."""
    return F.broadcast(keys) if at_most <= BROADCAST_KEYS else keys


def in_mixed_groups(members: DataFrame) -> DataFrame:
    """The rows of groups (``token``) that hold several components (``comp``)."""
    group = Window.partitionBy("token")
    return (members.withColumn("_x", F.min("comp").over(group)).withColumn("_y", F.max("comp").over(group))
            .filter("_x <> _y").drop("_x", "_y"))


def linked_in_rounds(members: DataFrame, fits: Callable[[str, str], Column], similar: Callable[[DataFrame], DataFrame],
                     label: str) -> DataFrame:
    """Links (a, b) that reach the same components as all similar pairs of members that share a group.

    ``members`` has token, node, n and what ``fits(hub alias, member alias)`` needs; ``similar`` keeps the similar of
    the pairs (a, b). In each round the first members of a group by (n, node) - 1, then 4, 16, ... - are paired with
    its later ones, and are then done with. Members of one component are never paired: more links would not change
    it. As soon as all pairs left are few (one for two rows, or ``FEW``) they are taken at once. So a group of many
    copies costs a star, and a group of many unlike members the pairs that any exact join compares, in a logarithmic
    number of rounds.
    """
    members = materialize(in_mixed_groups(members.withColumn("comp", F.col("node"))), f"{label}-members")
    links: list[DataFrame] = []
    known = None
    for step in count():
        size = (members.groupBy("token", "comp").agg(F.count(F.lit(1)).cast("double").alias("c")).groupBy("token")
                .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))  # same: pairs of one component
                .agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs"), F.sum("n").alias("rows")).first())
        if not size["rows"]:
            break
        every = size["pairs"] <= max(size["rows"] / 2, FEW)
        at = F.row_number().over(Window.partitionBy("token").orderBy("n", "node"))
        hubs = members if every else members.withColumn("_at", at).filter(F.col("_at") <= 4 ** step).drop("_at")
        later = F.struct("h.n", "h.node") < F.struct("p.n", "p.node")
        pairs = (members.alias("p").join(hubs.alias("h"), "token")
                 .filter(later & (F.col("p.comp") != F.col("h.comp")) & fits("h", "p"))
                 .select(F.col("h.node").alias("a"), F.col("p.node").alias("b")).distinct())
        links.append(materialize(similar(materialize(pairs, f"{label}-pairs")), f"{label}-links"))
        if every:
            break
        known = more_components(links[-1], known)
        left = (members.join(hubs.select("token", "node"), ["token", "node"], "left_anti")
                .join(known.withColumnRenamed("component", "known"), "node", "left"))
        members = materialize(in_mixed_groups(left.withColumn("comp", F.coalesce("known", "comp")).drop("known")),
                              f"{label}-members")
    none = members.sparkSession.createDataFrame([], "a long, b long")
    return reduce(DataFrame.unionByName, links) if links else none
