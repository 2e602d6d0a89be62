"""Connected components of a link table, labelled by the smallest id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlab.llm.shared import keep, map_arrow

#: Links that one task contracts.
CONTRACTED = 1 << 20


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, each id tied to the smallest of its group there."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    x, y = (np.concatenate(c) for c in zip(*parts))
    ids, back = np.unique(np.concatenate([x, y]), return_inverse=True)
    root = list(range(len(ids)))
    for i, j in zip(back[:len(x)].tolist(), back[len(x):].tolist()):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        while root[j] != j:
            root[j] = root[root[j]]
            j = root[j]
        root[max(i, j)] = min(i, j)  # ids are sorted: the smaller place is the smaller id
    root = np.array(root)
    while (root[root] != root).any():
        root = root[root]
    tied = np.flatnonzero(root != np.arange(len(ids)))
    yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[root[tied]])], names=["a", "b"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component for every id (a long) that is linked to another one.

    Each task first contracts a bounded number of links by itself. Where that
    takes more than one task, alternating large-star and small-star rounds
    follow: every round ties a node to the smallest id that it sees, in joins
    and pre-aggregated minima, until every node is tied to one that is tied to
    nothing. A round's links are written to the shared folder. No neighbour
    list is ever gathered, so a node may have any number of links."""
    own = keep(links.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).where("a > b").distinct(), "links")
    tasks = max(1, -(-own.count() // CONTRACTED))
    edges = keep(map_arrow(own.coalesce(tasks), _contracted, "a long, b long"), "links")
    while tasks > 1 and (not _one_each(edges)
                         or not edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()):
        # large star: neighbours above a node are tied to the smallest id around it
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(edges.join(least, "a").select("a", F.col("m").alias("b"))).where("a > b").distinct())
        # small star: neighbours below a node are tied to the smallest of them
        large = keep(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = keep(small, "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _one_each(edges: DataFrame) -> bool:
    """Whether no node is tied to two others."""
    return edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
