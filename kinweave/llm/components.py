"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    side = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return side.unionByName(least.select("u", F.col("m").alias("v")))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of the nodes of all edges of a task, by union-find; the smaller root stays one."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = above[y]
            x = y
        return x

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            a, b = root(u), root(v)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "root": pa.array(map(root, nodes), pa.int64())})


def components(edges: DataFrame, few: int = 0) -> DataFrame:
    """(node, root) of every node of an edge, root being the smallest node of its component.

    ``edges`` has longs u and v, without nulls. Stars are contracted by turns towards larger and
    smaller neighbours, which takes a number of rounds in the logarithm of the component's size. Each
    round is written to the shared checkpoint folder; no task holds all neighbours of a node. Up to ``few`` distinct
    edges are joined in one task instead, as each round costs several shuffles, whatever the number of edges.
    """
    spread = lambda df: df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v")).distinct()
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = settle(spread(edges))
    seen = state(now)
    if seen[0] <= few:
        return now.coalesce(1).mapInArrow(_joined, "node long, root long")
    while seen[0]:
        now = settle(_small_star(_large_star(now)).distinct())
        new = state(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
