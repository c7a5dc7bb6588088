"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataflow.llm.arrow import in_arrow
from strataflow.llm.scratch import discard, stored

#: Edges up to which a graph is gone through in one task, within some 200 MB; larger ones go round by round.
FEW_EDGES = 1_000_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` of a graph (columns ``u``, ``v``) of a size that was checked, by union-find."""
    kind = edges.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x: object) -> object:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        made = None
        for batch in batches:
            made = batch.schema.field(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = list(parent)
        for at in range(0, len(nodes), 100_000):
            part = nodes[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, made), pa.array([root(x) for x in part], made)], names=["node", "component"])

    return edges.select("u", "v").coalesce(1).transform(in_arrow, run, f"node {kind}, component {kind}")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", few_edges: int = FEW_EDGES) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node with an edge to another node.

    Up to ``few_edges`` edges, which are counted first, one task finds them. Beyond, alternating large-star
    and small-star steps: each step hangs a node's neighbours on the
    smallest one, by a partially aggregated minimum and a join, never by gathering a node's
    neighbours in one place. Edges halve in depth each round, so that rounds grow with the
    logarithm of the longest chain; each round is a table in the shared folder, which the next replaces. The driver sees a
    count and a checksum a round. Nulls and loops are left out; an empty table gives none.
    """

    def by_smallest(pairs: DataFrame) -> DataFrame:
        """Each pair (u, v) with the smallest v of u."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(low, "u")

    graph = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges")
    if graph.count() <= few_edges:
        out = stored(_in_one_task(graph), "components")
        discard(graph)
        return out
    mark = None
    while True:
        both = graph.select("u", "v").union(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = by_smallest(both).select(F.col("v").alias("u"), F.least("m", "u").alias("m"), F.col("u").alias("centre")).filter("u > centre").select("u", F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        low = by_smallest(large)
        small = low.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        last, graph = graph, stored(small.distinct(), "edges")
        discard(last)
        now = graph.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = graph.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = graph.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    out._stored_at = graph._stored_at  # for whoever has no more use for it
    return out
