"""Connected components by distributed union-find: local forests, merged hierarchically."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.runtime import materialize

#: A task merges forests of at most about this many edges.
TASK_EDGES = 1_000_000


def _find(parent: dict, x):
    top = x
    while (up := parent.get(top, top)) != top:
        top = up
    while (up := parent.get(x, x)) != top and up != x:
        parent[x] = top
        x = up
    return top


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of a partition's edges: (u, v) with v the smallest node of u's tree."""
    parent: dict = {}
    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = _find(parent, u), _find(parent, v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    if parent:
        kids = list(parent)
        tops = [_find(parent, k) for k in kids]
        for at in range(0, len(kids), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(kids[at : at + 50_000], schema.field(0).type), pa.array(tops[at : at + 50_000], schema.field(1).type)], schema=schema)


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the smallest node of its component.

    Each partition reduces its edges to a forest, which has at most one edge for a node. The forests are merged in
    fewer and fewer tasks while they fit; where they don't, each edge goes to the tasks of both its ends, which joins at
    least the trees that share a node, and this repeats until the forest is flat. Null ends and loops are dropped.
    """
    kind = edges.schema["u"].dataType
    schema = T.StructType([T.StructField("u", kind), T.StructField("v", kind)])
    plain = edges.select("u", "v").filter("u is not null and v is not null and u <> v")
    forest = materialize(plain.mapInArrow(_forest, schema), "forest")
    n = forest.count()
    while n > task_edges:
        ends = forest.select(F.explode(F.array("u", "v")).alias("at"), "u", "v")
        parts = max(1, -(-2 * n // task_edges))
        merged = materialize(ends.repartition(parts, "at").select("u", "v").mapInArrow(_forest, schema).distinct(), "forest")
        roots = merged.select(F.col("v").alias("u")).distinct()
        loose = merged.join(roots, "u", "left_semi").count() + merged.count() - merged.select("u").distinct().count()
        forest, n = merged, merged.count()
        if not loose:
            break
    if n <= task_edges:
        forest = materialize(forest.coalesce(1).mapInArrow(_forest, schema), "forest")
    return forest.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(forest.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
