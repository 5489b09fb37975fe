"""Connected components of a graph given as pairs of integers.

Every task first contracts the edges that it has at hand, a bounded number at a time: their own components become stars
around their smallest nodes, whatever part of the graph they are. Then alternating large-star and small-star steps: each
step lets every node hand its neighbours to the smallest of them, so paths shorten by halves and each component ends
as a star around its smallest node. Minima are partial aggregates; a hub's many edges stay on the edge side of a join, which
adaptive execution splits. The graph is done when every node has one parent and no parent has one: that is one
aggregate, so a graph of small components costs no round at all. Each round is written to the shared folder, so a lost
executor repeats one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmatch.llm.common import materialize

#: Edges that a task contracts at a time.
EDGES = 1 << 20


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of each node but the smallest ones."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)  # the roots learn of each other, so whole trees move
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def _contracted(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def star() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            u, v = contract(t.column(0).to_numpy(), t.column(1).to_numpy())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= EDGES:
                yield star()
                held, size = [], 0
        if size:
            yield star()

    return edges.mapInArrow(run, "u bigint, v bigint")


def _open(edges: DataFrame) -> bool:
    """Whether some node has several parents, or a parent and children."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").limit(1).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has a link to another node."""
    edges = links.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v")).where("u <> v")
    edges = materialize(_contracted(edges).distinct(), "edges")
    while _open(edges):
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("m", "x"))
        # Large star: the larger neighbours of x go to its smallest neighbour, or to x itself. An edge (u, v) is
        # seen from v here (u > v); from u it would only give back v's side.
        large = edges.join(low, edges["v"] == low["x"]).select("u", F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: a node's smaller neighbours, and the node, go to the smallest of them.
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(_contracted(moved.union(least)).distinct(), "edges")
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.union(edges.select("v", "v").distinct())
