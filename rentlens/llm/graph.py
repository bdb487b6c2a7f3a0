"""Connected components of an edge table: forests per task, then alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import materialise

EDGES_PER_TASK = 500_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one task as stars around the smallest node of each of its components."""
    boss: dict = {}

    def root(x):
        while boss.setdefault(x, x) != x:
            boss[x] = boss[boss[x]]
            x = boss[x]
        return x

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                boss[max(a, b)] = min(a, b)
    if schema is not None:
        ends = [(x, r) for x in list(boss) if (r := root(x)) != x]
        yield pa.record_batch([pa.array([e[i] for e in ends], schema.field(i).type) for i in (0, 1)], schema=schema)


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per ``u`` the smallest of itself and its partners."""
    return materialise(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``: then the edges are the components."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of an orderable type -> ``node, label``: each node of an edge with the smallest node it is joined to.

    First the edges, dealt evenly into tasks of about ``EDGES_PER_TASK``, become forests of stars. What is left between
    the tasks goes in rounds that link every larger neighbour to the smallest one (large star), then every node to its
    smallest neighbour (small star), until each component is a star. The number of rounds grows with the logarithm of
    the longest chain. Each round's edges are written, and both sides of its joins are written tables, so adaptive
    execution can split a hub's rows. Self-edges and null ends are ignored; an empty table has no nodes.
    """
    edges = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialise(edges, "edges")
    tasks = edges.count() // EDGES_PER_TASK + 1
    edges = materialise(edges.repartition(tasks).mapInArrow(_forests, edges.schema), "forests")
    while tasks > 1 and not _is_star_forest(edges):
        both = materialise(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both-ways")
        large = both.join(_lowest(both), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.filter(F.col("u") != F.col("v")).distinct(), "large-star")
        if _is_star_forest(large):
            edges = large
            break
        lowest = _lowest(large)
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        edges = materialise(small.filter(F.col("u") != F.col("v")).distinct(), "small-star")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
