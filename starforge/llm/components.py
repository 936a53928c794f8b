"""Connected components of an undirected edge table, by alternating stars and
leaves that leave the rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b; any ordered type);
    the root is the smallest node of the component.

    A node with one smaller neighbour and no larger one is a leaf: it leaves with
    that neighbour as its parent and takes its root from it in the end, so a
    finished star leaves the rounds at once.  In what remains each round hangs
    every node's larger neighbours under its smallest neighbour (large star), then
    its smaller ones too (small star), until no edge is left: rounds grow with the
    logarithm of the longest path.

    Minima are aggregated before the shuffle.  All joins are between written
    tables, with no grouping in between, so that AQE splits the edges of a hot
    node on either side.  Edges are never collected.  NULL ends and loops are no
    edges; an empty table gives an empty result."""
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .distinct(), "edges")
    left = []                               # (u, v): leaves of each round and their parents
    while True:
        none = F.lit(None).cast(e.schema["v"].dataType)
        ends = e.select(F.col("u").alias("node"), F.col("v").alias("s"), F.lit(False).alias("above")).unionByName(
            e.select(F.col("v").alias("node"), none.alias("s"), F.lit(True).alias("above")))
        near = cut(ends.groupBy("node").agg(F.min("s").alias("m"), F.max("s").alias("most"),
                                            F.max("above").alias("above")), "ends")
        leaf = (F.col("m") == F.col("most")) & ~F.col("above")
        marked = cut(e.join(near, e["u"] == near["node"]).select("u", "v", leaf.alias("leaf")), "marked")
        left.append(marked.filter("leaf").select("u", "v"))
        rest = marked.filter("not leaf").select("u", "v")
        if rest.isEmpty():
            break
        near = near.filter("m is not null").select("node", "m")
        large = cut(rest.join(near, rest["v"] == near["node"], "left")
                    .select("u", F.coalesce("m", "v").alias("v")), "large")
        low = cut(large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")), "low")
        small = large.join(low, large["u"] == low["node"])
        to = F.explode(F.array("u", "v"))
        e = cut(small.select(to.alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "edges")
    known = left.pop().toDF("node", "root")
    for level in reversed(left):            # a parent left in a later round, or is a root
        up = known.toDF("v", "root")
        known = cut(known.unionByName(level.join(up, "v", "left").select(
            F.col("u").alias("node"), F.coalesce("root", "v").alias("root"))), "roots")
    return known.unionByName(known.select("root").distinct().select(F.col("root").alias("node"), "root"))


def local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each one's component, by repeated minima over links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
