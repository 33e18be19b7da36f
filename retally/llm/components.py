"""Connected components of a graph of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from retally.llm.common import kept, ready

#: Links a task unites at once; only memory depends on it.
AT_ONCE = 2_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the same components as the links: every node but the smallest of a component, and that smallest one."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def stars() -> pa.RecordBatch:
        columns = forest(*(np.concatenate([np.asarray(batch.column(i)) for batch in held]) for i in (0, 1)))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= AT_ONCE:
            yield stars()
            held, size = [], 0
    if size:
        yield stars()


def _gathered(edges: DataFrame) -> DataFrame:
    """Links united in the tasks that hold them, then by their larger node: few links of one node are left to meet in a task."""
    united = lambda df: df.mapInArrow(_united, "a long, b long")
    return united(united(edges).repartition("a"))


def _unsettled(state: DataFrame) -> DataFrame:
    """Nodes with two parents, or with a parent and children."""
    ends = state.select(F.col("a").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(
        state.select(F.col("b").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
    return ends.groupBy("id").agg(F.sum("child").alias("child"), F.max("parent").alias("parent")).where("child > 1 OR (child > 0 AND parent > 0)")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``(id, component)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    Every link points from a larger node to a smaller one.  Tasks replace the links they hold by stars, first where the links are,
    then dealt out by the larger node, so a node's many links are few before they meet, and the many links to one small node
    are never gathered.  Where a star's centre has a link itself, links skip it (to its least parent) and the tasks unite
    again.  Each step lowers ends of links, so it comes to an end: when only separate stars are left, they are the components.
    Each step is a written table.  Loops, repeated edges and either direction are fine; nodes without an edge to another
    do not appear.
    """
    ready(edges.sparkSession)
    edges = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    state, number = kept(_gathered(edges), f"{folder}/0"), 0
    while not _unsettled(state).isEmpty():
        number += 1
        parent = state.groupBy("a").agg(F.min("b").alias("c")).withColumnRenamed("a", "b")
        skipped = state.join(parent.hint("merge"), "b", "left").select("a", F.coalesce("c", "b").alias("b"))
        state = kept(_gathered(skipped), f"{folder}/{number}")
    return state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
