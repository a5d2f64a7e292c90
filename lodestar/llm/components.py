"""Connected components of an edge table, by alternating large stars and small stars.

Every round is a few joins and aggregations on tables in the shared folder; no node's neighbours meet
in one task, and nothing but counts reaches the driver. Up to SMALL edges, counted first, one task
joins them with a union-find instead: that many fit in a few megabytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


SMALL = 400_000


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges of one task."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = sorted(parent)
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "component"])


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked with the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked with the least of them; here every edge has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, small: int = SMALL) -> DataFrame:
    """(node, component) of every node of edges (a, b): component is the least node that it reaches."""
    at = common.written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    mark = _mark(at)
    if mark[0] <= small:
        return common.written(at.coalesce(1).mapInArrow(_united, "node long, component long"), "components")
    while True:
        at = common.written(_small(_large(at)), "edges")
        now = _mark(at)
        if now == mark:
            break
        mark = now
    return at.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
