"""Connected components and adjacency over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.plans.store import drop_cut, materialise

MOST_ROUNDS = 60
#: Edges that one task joins in its memory (16 bytes each); a graph with more is contracted first.
TASK_EDGES = 500_000


def _collapse(edges: DataFrame) -> DataFrame:
    """node, root: each node follows its least neighbour to a local minimum, by pointer doubling, two jumps a write."""
    ends = edges.select("a", "b").union(edges.select("b", "a"))
    labels = materialise(ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    for _ in range(MOST_ROUNDS):
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        twice = jump.select("root", F.col("far").alias("mid")).join(labels.select(F.col("node").alias("mid"), F.col("root").alias("end")), "mid").select("root", F.col("mid").alias("far"), "end")
        after = materialise(labels.join(twice, "root").select("node", F.col("end").alias("root"), (F.col("end") != F.col("root")).alias("moved")), "labels")
        drop_cut(labels)
        labels = after.select("node", "root")
        if not after.filter("moved").limit(1).count():
            return labels
    raise RuntimeError("labels did not settle")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root (least node) of the edges of one task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([find(x) for x in nodes.tolist()], pa.int64())], names=["node", "root"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (least node of the component) for every node of the edges.

    Each round collapses the trees of least neighbours into their local minima and keeps only edges between different
    minima, so edges and nodes shrink by a constant factor or more; a chain takes a logarithmic number of steps. What is
    left when there are TASK_EDGES or fewer is joined by one task in bounded memory. What a round gives is written to the
    shared folder, and what the next one replaces is deleted.
    """
    left = materialise(edges.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b")).filter("a <> b").distinct(), "edges")
    whole = None
    for _ in range(MOST_ROUNDS):
        if left.count() <= TASK_EDGES:
            break
        labels = _collapse(left)
        near, far = labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        lifted = left.join(near, "a").join(far, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        fewer = materialise(lifted.distinct(), "edges")
        drop_cut(left)
        left = fewer
        whole = labels if whole is None else _lifted(whole, labels)
    else:
        raise RuntimeError("components did not settle")
    rest = left.coalesce(1).mapInArrow(_joined, "node long, root long")
    if whole is None:
        return rest
    whole = _lifted(whole, materialise(rest, "labels"))
    least = whole.groupBy("root").agg(F.least(F.min("node"), F.col("root")).alias("least"))
    return whole.join(least, "root").select("node", F.col("least").alias("root"))


def _lifted(whole: DataFrame, labels: DataFrame) -> DataFrame:
    """whole (node, root) with the roots that labels has for its roots."""
    up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
    return materialise(whole.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")


def adjacency(relations: DataFrame, source: str = "source_ref", target: str = "target_ref", kind: str = "relationship_type") -> DataFrame:
    """source, kind, sorted distinct targets."""
    return relations.groupBy(source, kind).agg(F.sort_array(F.collect_set(target)).alias("targets"))
