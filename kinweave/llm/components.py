"""Connected components of an edge table, by union-find inside partitions and minimum labels between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import forget, stored

#: Union-find works on so many edges at once and passes on at most one edge for each of their nodes.
BLOCK_EDGES = 500_000


def forest(edges: DataFrame) -> DataFrame:
    """The edges, less those that close a cycle within a block of a partition: same components, u > v."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = p
            return x

        def flush() -> pa.RecordBatch:
            pairs = [(x, root(x)) for x in list(parent) if root(x) != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["u", "v"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > BLOCK_EDGES:
                yield flush()
        yield flush()

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (u, v); component is the smallest node that is reachable.

    Each round hands every node the smallest label among its neighbours and then follows the label's own
    label, so that long paths shrink by doubling. No edge or label goes to the driver but a count.
    """
    edges = stored(forest(edges))
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("component")))
    for _ in range(most_rounds):
        old = labels
        near = both.join(labels.withColumnRenamed("node", "u"), "u").groupBy(F.col("v").alias("node")).agg(F.min("component").alias("least"))
        near = stored(near)
        step = stored(labels.join(near, "node", "left").select("node", "component", F.least("component", "least").alias("label")))
        jump = stored(step.select(F.col("node").alias("label"), F.col("label").alias("further")))
        new = stored(step.join(jump, "label", "left").select("node", F.least("label", "further").alias("component"), (F.col("component") != F.least("label", "further")).alias("changed")))
        changed = new.where("changed").limit(1).count()
        forget(old, near, step, jump)
        labels = new
        if not changed:
            return labels.select("node", "component")
    raise RuntimeError("labels still change after the allowed rounds")
