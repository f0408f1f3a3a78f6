"""Connected components of a link table, by alternating stars (MapReduce style)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import in_tasks, stored


def _stars(edges: DataFrame, towards_all: bool) -> DataFrame:
    """Hang neighbours of each node on the least of them: the larger ones, or the others."""
    if towards_all:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u")
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hung.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v"))


def _contracted(links: DataFrame) -> DataFrame:
    """The links of each partition as one link per node to the least node it reaches there."""
    def work(batches):
        root: dict = {}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                root.setdefault(a, a)
                root.setdefault(b, b)
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
        ends = [(x, find(x)) for x in root]
        ends = [(x, y) for x, y in ends if x != y]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in ends], kind), pa.array([y for _, y in ends], kind)], ["u", "v"])

    name = links.dtypes[0][1]
    kind = {"string": pa.string(), "bigint": pa.int64()}[name]
    return in_tasks(links, work, f"u {name}, v {name}")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): every node that has a link, with the least node it can reach.

    Ends are longs or strings. Links go both ways; repeated links and links of a node to itself
    are harmless; null ends are ignored. Links are first contracted within their partitions.
    Each round writes a table; rounds grow with the logarithm of the nodes.
    """
    pair = F.col(a), F.col(b)
    edges = stored(_contracted(links.where(pair[0] != pair[1]).select(pair[0].alias("u"), pair[1].alias("v"))).distinct())
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        edges = stored(_stars(_stars(edges, True), False).distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
