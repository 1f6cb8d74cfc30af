"""Connected components by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import cut


#: Edges, at 16 bytes each, that one task may hold.
ONE_TASK = 1 << 20


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the places a[i] and b[i]: ``root`` holds the smallest place of each
    component found so far."""
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if held:
        u, v = (np.concatenate(c) for c in zip(*held, strict=True))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = np.arange(len(nodes))
        unite(root, at[:len(u)], at[len(u):])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], names=["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """Columns node and root: the smallest node that each node of ``edges``
    (columns a, b) reaches.  Nodes without an edge have no row.

    Up to ONE_TASK edges are united in one task; more are contracted in rounds.

    A large star links the larger neighbours of a node to the smallest one, a
    small star the smaller ones; both keep components and end in stars around
    the smallest nodes.  A step is one aggregate, which is combined before the
    shuffle, and one join on the node, which Spark splits where it is skewed;
    no node's neighbours are gathered."""
    cur = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    cur = cut(cur)
    if cur.count() <= ONE_TASK:
        return cur.coalesce(1).mapInArrow(_united, "node long, root long")
    mark = None
    while True:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        seen = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("v")).first()
        if seen == mark:
            break
        mark = seen
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(cur.select("v", "v").distinct())
