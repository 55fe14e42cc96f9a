"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise

#: Edges up to which one task joins them (16 bytes each); beyond it rounds of joins do the same.
TASK_EDGES = 100_000


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(x, x), parent.setdefault(y, y)
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.array([root(i) for i in nodes], np.int64))], ["node", "component"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each node of ``edges`` can reach.

    A few edges (their number is checked) are joined in one task. For more, each round every node takes the smallest
    label among its neighbours' and its own, then the label of its label, so that chains shorten by doubling. Labels
    are written each round; a frequent node's messages are combined before the shuffle. An empty table gives no rows.
    """
    plain = materialise(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).distinct(), "plain")
    if plain.count() <= TASK_EDGES:
        out = materialise(plain.repartition(1).mapInArrow(_in_one_task, "node long, component long"), "labels")
    else:
        out = materialise(_by_rounds(plain, "a", "b"), "labels")
    discard(plain)
    return out


def _by_rounds(edges: DataFrame, a: str, b: str) -> DataFrame:
    both = materialise(edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst"))).where("src <> dst").distinct(), "edges")
    loops = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node"), F.col(a).alias("component")).distinct()
    labels = materialise(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("component")), "labels")
    last = labels
    while True:
        heard = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy("src").agg(F.min("component").alias("heard")).withColumnRenamed("src", "node")
        taken = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("component"))
        onward = taken.select(F.col("node").alias("component"), F.col("component").alias("onward"))
        moved = materialise(taken.join(onward, "component", "left").select("node", "old", F.least("component", F.coalesce("onward", "component")).alias("component")), "labels")
        discard(last)
        last, labels = moved, moved.select("node", "component")
        if moved.where("old <> component").isEmpty():
            return labels.unionByName(loops.join(labels, "node", "left_anti"))


def joined(labels: DataFrame | None, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``labels`` (node, component; None for none) after more edges: whole components are joined as single nodes."""
    if labels is None:
        return components(edges, a, b)
    named = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
    between = edges.join(named(a), a, "left").join(named(b), b, "left").select(F.coalesce(f"{a}_component", a).alias("a"), F.coalesce(f"{b}_component", b).alias("b"))
    merged = components(between)
    every = labels.unionByName(merged.select("node", F.col("node").alias("component")).join(labels, "node", "left_anti"))
    onward = merged.select(F.col("node").alias("component"), F.col("component").alias("onward"))
    out = materialise(every.join(onward, "component", "left").select("node", F.coalesce("onward", "component").alias("component")), "joined")
    discard(labels, merged)
    return out
