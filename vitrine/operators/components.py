"""Connected components of an undirected graph: stars within tasks, then hooking and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.session import cut_lineage, cut_counted, met

# Edges one task holds at a time.
TASK_EDGES = 500_000


def jump(parents: DataFrame) -> DataFrame:
    """Follow (node, root) pointers to their ends; each round halves the depth."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        moved = parents.join(met(up), "root", "left").select("node", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved"))
        moved, n = cut_counted(moved, F.count_if("_moved"))
        parents = moved.drop("_moved")
        if not n:
            return parents


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the component of each of n numbered nodes."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a task as (a, b): each node but the smallest of its component in the task, and that smallest one."""
    found = [batch for batch in batches if len(batch)]
    if found:
        edges = pd.concat(found)
        names, numbered = np.unique(np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()]), return_inverse=True)
        root = roots(numbered[:len(edges)], numbered[len(edges):], len(names))
        inner = np.flatnonzero(root != np.arange(len(root)))
        yield pd.DataFrame({"a": names[inner], "b": names[root[inner]]})


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) with root the smallest node of the component.

    Tasks first replace the edges they hold, at most about TASK_EDGES, by stars, again with fewer tasks as long as that halves them; edges
    that one task holds are then solved. What is left of more is hooked: every
    round points each node at its smallest neighbour, follows the pointers, and contracts the edges to what still joins different
    roots. A node with very many edges only feeds a map-side combined minimum.
    """
    edges = edges.select("a", "b").filter("a <> b")
    edges, n = cut_counted(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), F.count(F.lit(1)))
    if not n:
        return nodes.select("node", F.col("node").alias("root"))
    schema = edges.schema
    while True:
        tasks = -(-n // TASK_EDGES)
        before = n
        edges, n = cut_counted(edges.repartition(tasks).mapInPandas(stars, schema), F.count(F.lit(1)))
        if tasks == 1:
            solved = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.select("node").join(met(solved), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        if n > before / 2:
            return hooked(nodes, edges)


def hooked(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Components by hooking and pointer jumping alone."""
    labels = nodes.select("node", F.col("node").alias("root"))
    both, n = cut_counted(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), F.count(F.lit(1)))
    while n:
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).filter("root < node")
        pointers = jump(hooks)
        step = pointers.select(F.col("node").alias("root"), F.col("root").alias("_to"))
        labels = cut_lineage(labels.join(met(step), "root", "left").select("node", F.coalesce("_to", "root").alias("root")))
        for end in ("a", "b"):
            to = pointers.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
            both = both.join(met(to), end, "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
        both, n = cut_counted(both.select("a", "b").filter("a <> b").distinct(), F.count(F.lit(1)))
    return labels


def number_in_order(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add 0-based positions of the rows in the order of `column`.

    Rows are range-partitioned and counted per partition, so numbering is as
    distributed as the sort; only one count per partition is gathered.
    """
    placed = cut_lineage(df.orderBy(column)).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the sort: bounded by the cluster's settings, not the data.
    starts, total = [], 0
    for row in sorted(counts.collect()):
        starts.append((row["_part"], total))
        total += row["_n"]
    if not starts:
        return placed.select(*df.columns, F.col("_at").alias(name))
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_start") + F.col("_at")).alias(name))
