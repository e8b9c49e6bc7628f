"""Connected components of a graph of integers, by labels that spread to neighbours and jump.

Each round every node takes the least label among its neighbours (a partial minimum before the
shuffle, so a hub costs no more than other nodes), then the label of the node it points to. Both
joins are between written tables, so that Spark can split a hub's rows. Nothing is collected but
one checksum a round, which says whether labels still change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import materialize


class Forest:
    """Union-find over places, many links at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while (more := self.parent[up] != up).any():
            up = np.where(more, self.parent[up], up)
        self.parent[at] = up
        return up

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            i, j = self.roots(i), self.roots(j)
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))


def _contract(batches):
    """The spanning forest of a partition's links."""
    pairs = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not pairs:
        return
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    forest = Forest(len(nodes))
    forest.join(place[: len(a)], place[len(a) :])
    parent = forest.roots(np.arange(len(nodes)))
    child = np.flatnonzero(parent != np.arange(len(nodes)))
    yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[child]), "b": pa.array(nodes[parent[child]])})


def contracted(edges: DataFrame, together: int = 16) -> DataFrame:
    """Fewer links with the same components: the forest of each ``together`` partitions, which has
    less links than nodes however many links it is made from."""
    n = edges.rdd.getNumPartitions()
    return edges.coalesce(max(1, -(-n // together))).mapInArrow(_contract, "a long, b long")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes: node long, rank long (what is minimised); edges: a, b, both nodes. Returns the nodes
    that have edges, with ``least``: the smallest rank in their component."""
    return component_labels(nodes, edges).select("node", F.col("label.rank").alias("least"))


def component_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """As connected_components, with ``label``: the smallest (rank, node) of the component."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).union(edges.select("a", F.col("a").alias("b"))).union(edges.select(F.col("b").alias("a"), "b")).distinct(), "links")
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = materialize(nodes.join(ends, "node", "left_semi").select("node", F.struct("rank", "node").alias("label")), "labels")
    seen = None
    while True:
        spread = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label"))
        spread = materialize(spread, "labels")
        target = spread.select(F.col("node").alias("to"), F.col("label").alias("further"))
        labels = materialize(spread.join(target, F.col("label.node") == F.col("to")).select("node", F.least("label", "further").alias("label")), "labels")
        now = labels.agg(F.expr("bit_xor(xxhash64(node, label.node))")).first()[0]
        if now == seen:
            return labels
        seen = now
