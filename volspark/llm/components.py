"""Connected components of an edge table, by alternating star contraction.

Each round rewires every vertex to the smallest vertex it can see (large star
on the larger neighbours, small star on the smaller ones), so long chains
shrink in logarithmically many rounds. A round is two aggregations and two
joins between tables on shared storage: lost executors cost one step at most,
and the join of a vertex with very many edges is one that Spark can split (its
inputs are plain scans). Edges, vertices and labels never reach the driver,
only two numbers per round do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.session import keep

MAX_ROUNDS = 100


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace each batch's edges by (vertex, smallest vertex it reaches in the batch)."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(a):
            continue
        ids, pos = np.unique(np.concatenate([a, b]), return_inverse=True)
        left, right = pos[:len(a)], pos[len(a):]
        root = np.arange(len(ids))
        while True:
            low = np.minimum(root[left], root[right])
            new = root.copy()
            np.minimum.at(new, root[left], low)
            np.minimum.at(new, root[right], low)
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        away = root != np.arange(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[away]), pa.array(ids[root[away]])],
                                         names=["a", "b"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every vertex of ``edges``; component = smallest id reachable.

    ``edges``: two long columns, any direction, repeats and self-loops allowed;
    rows with a null end are ignored. No edges give an empty result. Vertices
    without an edge to another vertex are absent.
    """
    edges = (edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
             .where("a <> b"))
    edges = keep(edges.mapInArrow(_forest, "a long, b long").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: neighbours above u go to the least vertex around u
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = keep(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .where("u <> v").distinct(), "large-star")
        # small star: u and its neighbours below go to the least of them (edges point down)
        low = keep(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = keep(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.coalesce(
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        if now == before:
            return edges.toDF("id", "component").union(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
