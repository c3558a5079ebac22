"""Connected components of a graph in tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.runtime import cut

#: Edges that one task may settle: 16 bytes each.
ONE_TASK = 1 << 20


def labels_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the ends of the edges: the larger of two labels is hung below the smaller, then chains of labels are shortened."""
    node, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(node))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return node, node[label]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if got:
        a, b = (np.concatenate([x.column(i).to_numpy() for x in got]) for i in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in labels_of(a, b)], ["node", "component"])


def connected_components(nodes: DataFrame, edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): the least node each node is connected with.

    nodes: (node BIGINT); edges: (a, b), in any direction, repeated or not; loops do not matter, and ends must be
    nodes. Up to one_task edges are settled by one task. More take rounds of joins: labels spread along edges and
    jump to the label of their label; chains and stars settle in rounds that grow with the logarithm of their size,
    and no shape takes more rounds than its longest shortest path. Each round is written to the shared folder.
    """
    edges = cut(edges.select("a", "b").filter("a <> b"))
    own = nodes.select("node").distinct()
    if edges.count() <= one_task:
        found = cut(edges.coalesce(1).mapInArrow(_labelled, "node bigint, component bigint"))
        return own.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(own.select("node", F.col("node").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("c")), "b").groupBy("a").agg(F.min("c").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a"), "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jumped = spread.join(spread.select(F.col("node").alias("label"), F.col("label").alias("farther")), "label", "left").select("node", "old", F.least("label", F.coalesce("farther", "label")).alias("label"))
        labels = cut(jumped)
        if not labels.filter("old <> label").take(1):
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
