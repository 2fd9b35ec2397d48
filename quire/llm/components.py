"""Connected components of an edge table, by contraction.

In each round every node joins the neighbour that a hash of the round puts first, edges are renamed after
those and the ones that became loops go. A constant share of the nodes goes in each round on average. All
joins have one row a node on one side, so that a node with very many edges can be split by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

SMALL = 200_000  # edges that one task may finish: the bound of what it holds


def local_labels(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    top = np.arange(len(nodes))
    while True:
        x, y = top[a], top[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[top]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
        while (top != top[top]).any():
            top = top[top]


def _finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in parts if b.num_rows]
    if held:
        nodes, labels = local_labels(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], ["id", "label"])


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(id, component) for each node of edges (u bigint, v bigint): the smallest node it is linked with,
    over whatever number of edges. Nulls and loops are no edges."""
    e = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    steps: list[DataFrame] = []
    spent = [e]
    while (n := e.count()) > small:
        first = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = e.select("u", first("v").alias("x")).unionByName(e.select(F.col("v").alias("u"), first("u").alias("x")))
        step = both.groupBy("u").agg(F.min("x").alias("x")).select(F.col("u").alias("id"), F.least(first("u"), "x").getField("id").alias("parent"))
        step = written(step, "parents")
        steps.append(step)
        a, b = step.toDF("u", "pu"), step.toDF("v", "pv")
        e = written(e.join(a, "u").join(b, "v").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).where("u <> v").distinct(), "edges")
        spent += [step, e]
    # n is at most ``small`` here, so this one task holds a bounded number of edges.
    labels = e.coalesce(1).mapInArrow(_finish, "id bigint, label bigint") if n else e.sparkSession.createDataFrame([], "id bigint, label bigint")
    for step in reversed(steps):
        labels = step.join(labels.toDF("parent", "up"), "parent", "left").select("id", F.coalesce("up", "parent").alias("label"))
    if not steps:
        out = written(labels.toDF("id", "component"), "components")
    else:
        labels = written(labels, "labels")
        spent.append(labels)
        least = labels.groupBy("label").agg(F.min("id").alias("component"))
        out = written(labels.join(least, "label").select("id", "component"), "components")
    discard(*spent)
    return out
