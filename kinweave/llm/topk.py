"""Exact top-k inner products, pruned by segment means and deviations from coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.llm.common import settle

#: Blocks of rows that candidates are dealt into, at least and by their number of rows; rows of a block of queries at most.
BLOCKS, BLOCK_ROWS, QUERY_ROWS = 64, 1 << 18, 1 << 16
#: Queries and candidates compared at once inside a task.
QUERY_BLOCK, ROW_BLOCK = 512, 4096
#: Segments of a vector at each resolution.
RESOLUTIONS = (4, 8, 16, 32)
#: A resolution that spares less than this share of pairs is tried on one in so many blocks only, as it costs more than it spares.
WORTH, RETRY = 0.1, 8
#: Survivors above this share of a block are computed by one matrix product.
DENSE = 0.5
#: Largest sum that doubles hold exactly.
EXACT = 2.0**53


def scaled(df: DataFrame, scale: int) -> DataFrame:
    """vec_id and the vector of floor(scale * x), without null vectors or null, NaN or infinite components."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    whole = F.forall("x", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    return (
        df.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("x").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)))
        .select("vec_id", F.transform("x", lambda v: F.floor(v * float(scale)).cast("double")).alias("x"))
    )


def _summaries(m: np.ndarray) -> list[np.ndarray]:
    """For each resolution, a row of segment means and deviations, times the root of the segment's length.

    For vectors q and x, the squared distance is at least the sum over segments of
    ``n * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2)``; with the squared lengths known, that
    is the upper bound ``sum n * (mean_q * mean_x + dev_q * dev_x)`` of their inner product.
    """
    out = []
    for parts in RESOLUTIONS:
        edges = np.unique(np.linspace(0, m.shape[1], min(parts, max(1, m.shape[1])) + 1).astype(int))
        n = np.diff(edges)
        if m.shape[1] == 0:
            out.append(np.zeros((len(m), 2)))
            continue
        mean = np.add.reduceat(m, edges[:-1], axis=1) / n
        square = np.add.reduceat(m * m, edges[:-1], axis=1) / n
        dev = np.sqrt(np.maximum(square - mean * mean, 0))
        out.append(np.hstack([mean, dev]) * np.sqrt(np.hstack([n, n])))
    return out


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``q`` and ``x`` as whole numbers; beyond what doubles hold exactly, with Python's integers, held to 64 bits."""
    most = (np.abs(q).max(initial=0)) * (np.abs(x).max(initial=0)) * max(1, q.shape[-1])
    if most < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: [[int(v) for v in row] for row in m]
    a, b = whole(q), whole(x)
    held = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    return np.array([[held(sum(i * j for i, j in zip(r, t, strict=True))) for t in b] for r in a], dtype=np.int64).reshape(len(a), len(b))


class Search:
    """Running best k of each query over blocks of candidates.

    ``floor`` has for each query a score that k candidates are known to reach (-inf: none known).
    ``computed`` and ``pairs`` count the products computed exactly and all of them.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.q, self.k = ids, vectors, k
        self.levels = _summaries(vectors)
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf) if floor is None else floor.astype(float)
        self.spared, self.turn = [1.0] * len(self.levels), 0
        self.computed = self.pairs = 0

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        width = self.q.shape[1]
        x = np.pad(x, ((0, 0), (0, max(0, width - x.shape[1]))))[:, :width]  # components that no query has add nothing
        self.turn += 1
        wanted = [i for i, s in enumerate(self.spared) if s >= WORTH or self.turn % RETRY == 1]
        levels = _summaries(x) if wanted else []
        for lo in range(0, len(self.ids), QUERY_BLOCK):
            at = slice(lo, lo + QUERY_BLOCK)
            alive = self.ids[at, None] != ids[None, :]
            self.pairs += alive.size
            for i in wanted:
                before = alive.mean()
                bound = self.levels[i][at] @ levels[i].T
                alive &= bound + 1e-9 * (1 + np.abs(bound)) >= self.least[at, None]
                if np.isfinite(self.least[at]).any() and before:
                    self.spared[i] = 1 - alive.mean() / before
                if not alive.any():
                    break
            self._settle(at, ids, x, alive)

    def _settle(self, at: slice, ids: np.ndarray, x: np.ndarray, alive: np.ndarray) -> None:
        """Compute the survivors exactly and keep the best."""
        scores = _exact(self.q[at], x) if alive.mean() > DENSE else None
        self.computed += alive.size if scores is not None else int(alive.sum())
        for i in np.flatnonzero(alive.any(axis=1)).tolist():
            j = at.start + i
            rows = np.flatnonzero(alive[i]) if scores is None else np.flatnonzero(alive[i] & (scores[i] >= self.least[j]))
            score = scores[i][rows] if scores is not None else _exact(self.q[j : j + 1], x[rows])[0]
            if len(rows) > self.k:  # all that reach the k-th best score, ties included
                near = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
                rows, score = rows[near], score[near]
            own = np.concatenate([self.found[j][0], ids[rows]])
            score = np.concatenate([self.found[j][1], score])
            order = np.lexsort((own, -score))[: self.k]
            self.found[j] = own[order], score[order]
            if len(order) == self.k:
                self.least[j] = max(self.least[j], self.found[j][1][-1])

    def rows(self) -> dict[str, np.ndarray]:
        sizes = [len(f[0]) for f in self.found]
        join = lambda k: np.concatenate([f[k] for f in self.found] or [np.empty(0, np.int64)])
        return {"query_id": np.repeat(self.ids, sizes), "vec_id": join(0), "score": join(1)}


def _arrays(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors; shorter vectors end in zeros, which add nothing to a product."""
    lists = rows["x"].combine_chunks()
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends[:-1], sizes)] = flat
    return rows["vec_id"].to_numpy().astype(np.int64), out


def _searched(asked: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best k of each pair of a block of queries and a block of candidates, one pair a task."""

    def find(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(queries) or not len(candidates):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        search = Search(*_arrays(queries), k, np.array([-np.inf if f is None else f for f in queries["floor"].to_pylist()]))
        for lo in range(0, len(candidates), ROW_BLOCK):
            search.add(*_arrays(candidates.slice(lo, ROW_BLOCK)))
        return pa.table(search.rows())

    pair = ["part", "block"]
    fresh = [df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (asked, vectors)]  # both sides may stem from one table
    return fresh[0].groupBy(*pair).cogroup(fresh[1].groupBy(*pair)).applyInArrow(find, "query_id long, vec_id long, score long")


def _longs(*values: int) -> list[Column]:
    return [F.lit(v).cast("long") for v in values]


def top_k(df: DataFrame, k: int = 5, scale: int = 256, every: int = 50) -> DataFrame:
    """The k highest integer inner products of each query vector with the vectors of other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Result: query_id, rank (from 1),
    vec_id, score; ties go to the smaller vec_id. Null vectors, and vectors with null or non-finite
    components, take no part, nor do rows without an id; a vector that is shorter than another
    counts as if it ended in zeros. Rows that repeat an id are each a candidate, and one query
    (the least of their vectors) stands for them; a query is never matched with a row of its own id. Sums
    beyond 64 bits are held to the nearest 64-bit value. Other columns are not read. An empty table gives no rows.

    Candidates are dealt by row number into blocks of even size, so no id or vector swells one, and queries
    into as few parts as fit a task; each pair of a part and a block is searched in one task. The first block
    is searched before the others and gives each query a score to beat, so that bounds prune from the start.
    """
    number = F.monotonically_increasing_id()  # of written rows
    vectors = settle(scaled(df, scale)).withColumn("row", number)
    asked = settle(vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))).withColumn("row", number)
    blocks = max(BLOCKS, -(-vectors.count() // BLOCK_ROWS))
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part")
    dealt = vectors.select("vec_id", "x", block)
    asked = asked.select("vec_id", "x", part)
    every_part = F.explode(F.sequence(*_longs(0, parts - 1))).alias("part")
    candidates = lambda which: dealt.where(which).select("vec_id", "x", "block", every_part)
    ahead = settle(_searched(asked.select("*", _longs(0)[0].alias("block"), F.lit(None).cast("long").alias("floor")), candidates("block = 0"), k))
    floors = ahead.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    others = F.explode(F.sequence(*_longs(1, blocks - 1))).alias("block")
    ready = asked.join(floors, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "x", "part", "floor", others)
    found = ahead.unionByName(_searched(ready, candidates("block > 0"), k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
