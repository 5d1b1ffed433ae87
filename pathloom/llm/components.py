"""Connected components of a graph given by its edges, by contraction in Spark.

Defined results: equal edges and loops count for nothing more; a vertex without an edge has no label; without
edges there are no labels. Vertices must not be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathloom.llm.shared import map_arrow, written

#: Edges that one task joins up by itself, some megabytes; more are contracted by all tasks.
ONE_TASK = 100_000


def connect(edges: DataFrame) -> DataFrame:
    """vertex, label of every vertex of the edges (x, y); the label is the smallest vertex of its component. `edges` is read more than once.

    Every round points each vertex to its smallest neighbour, follows pointers twice over, and goes on
    with the edges between different targets, so the graph shrinks by half at least.
    """
    rounds = []
    edges = edges.select("x", "y")
    while True:
        if edges.count() <= ONE_TASK:
            rounds.append(written(_united(edges), "pointers"))
            break
        both = edges.union(edges.select(F.col("y"), F.col("x"))).toDF("u", "v")
        to = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("v"))
        to = written(to, "pointers")
        for _ in range(2):
            ahead = to.toDF("v", "w")
            to = written(to.join(ahead, "v", "left").select("u", F.coalesce("w", "v").alias("v")), "pointers")
        rounds.append(to)
        ahead = to.toDF("x", "to_x")
        left = edges.join(ahead, "x").join(ahead.toDF("y", "to_y"), "y").where("to_x <> to_y")
        edges = written(left.select(F.least("to_x", "to_y").alias("x"), F.greatest("to_x", "to_y").alias("y")).distinct(), "edges")
    if len(rounds) == 1:
        return rounds[0].toDF("vertex", "label")
    label = rounds[0].toDF("vertex", "label")
    for to in rounds[1:]:
        label = label.join(to.toDF("label", "further"), "label", "left").select("vertex", F.coalesce("further", "label").alias("label"))
    return written(label, "labels")


def _united(edges: DataFrame) -> DataFrame:
    """u, v: the smallest vertex of every vertex's component, of at most ONE_TASK edges, by union-find in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while parent.setdefault(v, v) != v:
                parent[v] = parent[parent[v]]
                v = parent[v]
            return v

        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
        vertices = list(parent)
        yield pa.RecordBatch.from_arrays([pa.array(vertices, pa.int64()), pa.array([root(v) for v in vertices], pa.int64())], ["u", "v"])

    return map_arrow(edges.repartition(1), work, "u long, v long")
