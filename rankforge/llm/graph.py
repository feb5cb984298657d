"""Connected components of an edge table.

Each Arrow batch first shrinks its edges to a spanning forest, then large-star
and small-star rounds (Kiveris et al. 2014) run as joins and grouped minima
until nothing changes.  A node with very many edges is pre-aggregated by the
grouped minimum; the join side that carries its edges can be split by AQE.
Every round is a reliable checkpoint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, partitions, sweep

#: Edges that a partition of the edge table holds at least.
_EDGES = 100_000


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable from each of the nodes 0..n-1 over edges a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        live = low != high
        if not live.any():
            break
        a, b, low, high = a[live], b[live], low[live], high[live]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _shrink(batches):
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = forest(inv[:len(a)], inv[len(a):], len(nodes))
        own = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["hi", "lo"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has
    an edge to another one.  Nodes are longs, without nulls."""
    e = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo")
    e = cut_lineage(e.mapInArrow(_shrink, "hi long, lo long").distinct())
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("hi", "lo"), 20))).first()
        if now == before or not now[0]:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")) \
                .union(e.select("lo", "lo").distinct())
        before = now
        sweep(e.sparkSession)                               # the files of the round before
        e = e.coalesce(max(1, min(partitions(e.sparkSession), now[0] // _EDGES)))
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo") \
            .union(low.select("hi", "m"))
        e = cut_lineage(small.distinct())
