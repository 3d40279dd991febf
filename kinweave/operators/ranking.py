"""Ranked candidates without a shuffle of pairs: blocks of S1 entities meet blocks of the pool in tasks of their own."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinweave.operators import blocking
from kinweave.operators.similarity import FIELDS, PROXIES

#: Most pool rows of a country that one task holds, as numbers of the tokens that its S1 rows have too.
POOL_ROWS = 500_000
#: Most S1 rows of a task.
S1_ROWS = 50_000
#: S1 blocks of all countries together, in which each gets its share, one at least; more where blocks would exceed S1_ROWS. As each block receives its
#: country's pool, what is shuffled grows with the rows up to then.
BLOCKS = 8
#: Pool rows that are turned into numbers at once; their texts are most of what a worker holds.
PIECE = 10_000
#: Pairs that leave a task at once, so that neither side ever holds all of a block's.
PAIRS = 20_000
#: Ids sampled for each range of pool ids.
SAMPLE = 100
#: Between the tokens of a list, none of which has one; lists travel as texts, a third of the size of Spark's arrays.
LINE = "\n"
RESULT = "s1_id string, cand_id string, name_cos double, addr_cos double, proxy double, cand_rank int"
LEVELS = "s1_id string, p int, score double, n long"
#: Proxies over columns of arrays.
_ARRAYS = {"mean": PROXIES["mean"], "max": np.maximum}


def _round9(x: np.ndarray) -> np.ndarray:
    """Nine decimals, halves up, as SQL's round."""
    scaled = x * 1e9
    low = np.floor(scaled)
    return (low + (scaled - low >= 0.5)) / 1e9


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, in their order of place; of equal ones those of the lower places."""
    if len(score) <= k:
        return np.arange(len(score))
    edge = np.partition(score, len(score) - k)[len(score) - k]
    taken = score > edge
    taken[np.flatnonzero(score == edge)[: k - int(taken.sum())]] = True
    return np.flatnonzero(taken)


def _array(table: pa.Table, name: str) -> pa.Array:
    chunks = table[name].chunks
    return pa.concat_arrays(chunks) if chunks else pa.array([], table.schema.field(name).type)


def _lists(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column, or of a column of joined lists, and their number in each row; a null list is empty."""
    column = _array(table, name)
    column = column if pa.types.is_list(column.type) else pc.split_pattern(column, LINE)
    return column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


class _Coded:
    """A column of lists: the S1 rows' values by number and where each row's start; of the pool's values those that S1 has too, by number, as pieces come."""

    def __init__(self, left: pa.Table, name: str):
        self.name = name
        values, self.left_sizes = _lists(left, name)
        coded = pc.dictionary_encode(values)
        self.codes, self.starts, self.dictionary = coded.indices.to_numpy(zero_copy_only=False), _starts(self.left_sizes), coded.dictionary
        self.pieces = []

    def add(self, right: pa.Table) -> np.ndarray:
        """Which of the piece's values S1 has."""
        values, sizes = _lists(right, self.name)
        found = pc.fill_null(pc.index_in(values, value_set=self.dictionary), -1).to_numpy(zero_copy_only=False)
        kept = np.flatnonzero(found >= 0)
        lengths = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        self.pieces.append([x.astype(np.int32) for x in (found[kept], lengths, sizes)])
        return kept

    def close(self) -> None:
        none = np.zeros(0, dtype=np.int32)
        self.found, self.lengths, self.sizes = ([np.concatenate([none, *x]) for x in zip(*self.pieces)]) if self.pieces else (none, none, none)
        self.other_starts, self.dense = _starts(self.lengths), np.zeros(len(self.dictionary))
        self.pieces = self.dictionary = None


@dataclass(frozen=True)
class Extras:
    """Columns of both sides to compare in the pairs that are kept.

    ``bags``, arrays of distinct tokens without line feeds, give common_<c>, n_<c>_1 and n_<c>_2; ``same`` gives same_<c> (1, 0, or null where a side is
    null); ``numbers``, integers, and ``texts`` give <c>_1 and <c>_2.
    """

    bags: tuple[str, ...] = ()
    same: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return [*self.bags, *self.same, *self.numbers, *self.texts]

    def schema(self) -> str:
        names = [x for c in self.bags for x in (f"common_{c}", f"n_{c}_1", f"n_{c}_2")] + [f"same_{c}" for c in self.same]
        whole = "".join(f", {x} int" for x in names + [f"{c}_{n}" for c in self.numbers for n in (1, 2)])
        return whole + "".join(f", {c}_{n} string" for c in self.texts for n in (1, 2))


class _Block:
    """A block of S1 entities and one of the pool, which comes in pieces in the order of its ids."""

    def __init__(self, left: pa.Table, extras: Extras):
        self.fields = [f for f in FIELDS if f"{f}_tokens" in left.column_names]
        self.extras_of, self.coded = extras, {"keys": _Coded(left, "keys")}
        self.coded |= {c: _Coded(left, c) for c in [*[f"{f}_tokens" for f in self.fields], *extras.bags]}
        self.weights = _lists(left, "weights")[0].to_numpy(zero_copy_only=False)
        self.own_weights = {f: _lists(left, f"{f}_weights")[0].to_numpy(zero_copy_only=False) for f in self.fields}
        self.other_weights: dict = {f: [np.zeros(0)] for f in self.fields}
        self.values = {c: pc.dictionary_encode(_array(left, c)) for c in extras.same}
        self.same = {c: [pc.fill_null(x.indices, -1).to_numpy(zero_copy_only=False)] for c, x in self.values.items()}
        self.kept = ["entity_id", *([] if not self.fields else ["blank"]), *extras.numbers, *extras.texts]
        self.left = self._copied(left, [c for c in (*self.kept, "p", "edge", "quota") if c in left.column_names])
        self.right: pa.Table | list = [self._copied(left, self.kept).slice(0, 0)]

    @staticmethod
    def _copied(rows: pa.Table, columns: list[str]) -> pa.Table:
        """Columns in memory of their own, as slices of a message would keep all of it."""
        return rows.select(columns).take(pa.array(np.arange(rows.num_rows)))

    def add(self, right: pa.Table) -> None:
        self.coded["keys"].add(right)
        for f in self.fields:
            kept = self.coded[f"{f}_tokens"].add(right)
            self.other_weights[f].append(_lists(right, f"{f}_weights")[0].to_numpy(zero_copy_only=False)[kept])
        for c in self.extras_of.bags:
            self.coded[c].add(right)
        for c, x in self.values.items():
            column = _array(right, c)
            found = pc.fill_null(pc.index_in(column, value_set=x.dictionary), -2).to_numpy(zero_copy_only=False)
            self.same[c].append(np.where(pc.is_null(column).to_numpy(zero_copy_only=False), -1, found).astype(np.int32))
        self.right.append(self._copied(right, self.kept))

    def close(self) -> _Block:
        """The block, when all of the pool's pieces are there."""
        self.right = pa.concat_tables(self.right).combine_chunks()
        self.other_weights = {f: np.concatenate(x) for f, x in self.other_weights.items()}
        self.same = {c: (x[0], np.concatenate([np.zeros(0, dtype=np.int32), *x[1:]])) for c, x in self.same.items()}
        for c in self.coded.values():
            c.close()
        keys, n = self.coded["keys"], self.right.num_rows
        order = np.argsort(keys.found, kind="stable")
        self.postings = np.repeat(np.arange(n, dtype=np.int32), keys.lengths)[order]
        self.posting_starts = _starts(np.bincount(keys.found, minlength=len(keys.dense)))
        self.sums, self.last = np.zeros(n), np.zeros(n, dtype=np.int64)
        if self.fields:
            self.blank = [_array(t, "blank").to_numpy(zero_copy_only=False) for t in (self.left, self.right)]
        pa.default_memory_pool().release_unused()
        return self

    def evidence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the pool that share a key with the i-th S1 row, in order, and their evidence."""
        every, keys = [], self.coded["keys"]
        for at in range(keys.starts[i], keys.starts[i + 1]):
            k = keys.codes[at]
            rows = self.postings[self.posting_starts[k] : self.posting_starts[k + 1]]
            self.sums[rows] += self.weights[at]  # a row has a key once
            every.append(rows)
        rows = np.concatenate(every) if every else np.zeros(0, dtype=np.int32)
        places = np.arange(len(rows))
        self.last[rows] = places
        rows = np.sort(rows[self.last[rows] == places])
        score = _round9(self.sums[rows])
        self.sums[rows] = 0
        return rows, score

    def dots(self, c: str, i: int, rows: np.ndarray, own: np.ndarray | None = None, others: np.ndarray | None = None) -> np.ndarray:
        """Inner products of the i-th S1 row and rows of the pool over a column's values: how many they share, without weights."""
        x = self.coded[c]
        at = slice(x.starts[i], x.starts[i + 1])
        x.dense[x.codes[at]] = 1 if own is None else own[at]
        n = x.lengths[rows]
        ends = np.cumsum(n, dtype=np.int64)
        there = np.arange(ends[-1] if len(ends) else 0) + np.repeat(x.other_starts[rows] - (ends - n), n)
        product = x.dense[x.found[there]]
        sums = np.bincount(np.repeat(np.arange(len(rows)), n), weights=product if others is None else product * others[there], minlength=len(rows))
        x.dense[x.codes[at]] = 0
        return sums

    def cosines(self, f: str, i: int, rows: np.ndarray) -> np.ndarray:
        return _round9(self.dots(f"{f}_tokens", i, rows, self.own_weights[f], self.other_weights[f]))

    def extras(self, i: int, rows: np.ndarray) -> list[np.ndarray]:
        """Of the i-th S1 row and rows of the pool: how many members each bag has in common; whether values are the same, -1 where one is null."""
        same = [np.where((a[i] < 0) | (b[rows] == -1), -1, a[i] == b[rows]) for a, b in self.same.values()]
        return [self.dots(c, i, rows) for c in self.extras_of.bags] + same

    def extra_columns(self, i: np.ndarray, rows: np.ndarray, found: list[np.ndarray]) -> dict:
        out, extras = {}, self.extras_of
        for c, common in zip(extras.bags, found):
            sizes = {f"n_{c}_1": self.coded[c].left_sizes[i].astype(np.int32), f"n_{c}_2": self.coded[c].sizes[rows]}
            out |= {f"common_{c}": common.astype(np.int32)} | sizes
        for c, same in zip(extras.same, found[len(extras.bags) :]):
            out[f"same_{c}"] = pa.array(same.astype(np.int32), mask=same < 0)
        for c in [*extras.numbers, *extras.texts]:
            out |= {f"{c}_1": self.left[c].take(pa.array(i)), f"{c}_2": self.right[c].take(pa.array(rows))}
        return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Table]]:
    """Block, side and rows of one block and side: S1 rows whole, the pool's PIECE or so at once."""
    at, held = ("", 0), []
    for batch in batches:
        changes = pc.dictionary_encode(batch["block"]).indices.to_numpy(zero_copy_only=False) * 2 + batch["side"].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(changes)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for start, end in zip(cuts, cuts[1:]):
            rows = batch.slice(start, end - start)
            key = (rows["block"][0].as_py(), rows["side"][0].as_py())
            if held and (key != at or (at[1] == 1 and sum(x.num_rows for x in held) >= PIECE)):
                yield *at, pa.Table.from_batches(held)
                held = []
            at = key
            held.append(rows)
    if held:
        yield *at, pa.Table.from_batches(held)


def _blocks(batches: Iterator[pa.RecordBatch], extras: Extras) -> Iterator[_Block]:
    """Blocks of rows that are ordered by block, side and id; a pool without S1 rows is passed over."""
    block, at = None, ""
    for name, side, rows in _pieces(batches):
        if side == 0:
            if block is not None:
                yield block.close()
            block, at = _Block(rows, extras), name
        elif name == at:
            block.add(rows)
    if block is not None:
        yield block.close()


def _levels(most: int) -> Callable:
    """Of each S1 row the evidence levels of its ``most`` best candidates of a range, and how many are at each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, Extras()):
            p, n, out = block.left["p"][0].as_py(), block.left.num_rows, [[], [], []]
            for i in range(n):
                rows, score = block.evidence(i)
                value, times = np.unique(score[_best(score, most)], return_counts=True)
                for to, x in zip(out, (np.full(len(value), i), value, times)):
                    to.append(x)
                if i + 1 == n or sum(map(len, out[0][-64:])) >= PAIRS or len(out[0]) >= 1024:
                    at, value, times = (np.concatenate(x) for x in out)
                    columns = {"s1_id": block.left["entity_id"].take(pa.array(at)), "p": np.full(len(at), p, dtype=np.int32), "score": value.astype(float), "n": times.astype(np.int64)}
                    yield from pa.table(columns).combine_chunks().to_batches()
                    out = [[], [], []]

    return run


def _ranked(most: int, proxy: str, k: int, extras: Extras) -> Callable:
    """Of each S1 row the ``most`` candidates by evidence (those over its edge and its quota at the edge, where it has them), then the k by proxy."""

    def table(block: _Block, out: list) -> Iterator[pa.RecordBatch]:
        i, rows, ranks, name, addr, likeness, *found = (np.concatenate(x) for x in out)
        ids = {"s1_id": block.left["entity_id"].take(pa.array(i)), "cand_id": block.right["entity_id"].take(pa.array(rows))}
        values = {"name_cos": name, "addr_cos": addr, "proxy": likeness, "cand_rank": ranks.astype(np.int32)}
        return pa.table(ids | values | block.extra_columns(i, rows, found)).combine_chunks().to_batches(PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, extras):
            edges, quotas = (block.left[c].to_numpy() if c in block.left.column_names else None for c in ("edge", "quota"))
            new = lambda: [[] for _ in range(6 + len(extras.bags) + len(extras.same))]
            out, held = new(), 0
            for i in range(block.left.num_rows if block.right.num_rows else 0):
                rows, score = block.evidence(i)
                if edges is not None:
                    taken = score > edges[i]
                    taken[np.flatnonzero(score == edges[i])[: max(int(quotas[i]), 0)]] = True
                    rows = rows[taken]
                elif most > 0:
                    rows = rows[_best(score, most)]
                name, addr = block.cosines("name", i, rows), block.cosines("addr", i, rows)
                likeness = _round9(_ARRAYS[proxy](name, np.where(block.blank[0][i] | block.blank[1][rows], name, addr)))
                best = _best(likeness, k)
                best = best[np.argsort(-likeness[best], kind="stable")]
                for to, x in zip(out, (np.full(len(best), i), rows[best], np.arange(len(best)), name[best], addr[best], likeness[best], *block.extras(i, rows[best]))):
                    to.append(x)
                held += len(best)
                if held >= PAIRS:
                    yield from table(block, out)
                    out, held = new(), 0
            if held:
                yield from table(block, out)
            vars(block).clear()  # before the next one is filled

    return run


def _of_tables(f: Callable, schema: str) -> Callable:
    """The same for a block whose two sides are there as tables."""
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "long": pa.int64()}
    none = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(","))]).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = pc.sort_indices(right, [("entity_id", "ascending")])
        pieces = (right.take(order.slice(at, PIECE)) for at in range(0, right.num_rows, PIECE))
        sides = (x for t in ([left], pieces) for y in t for x in y.combine_chunks().to_batches())
        made = list(f(sides))
        return pa.Table.from_batches(made) if made else none

    return run


def _joined(c: Column) -> Column:
    """A list of tokens as one text; null for none."""
    return F.when(F.size(c) > 0, F.array_join(c, LINE))


def _side_columns(extras: Extras) -> list[Column]:
    each = [(_joined(F.map_keys(f"{f}_v")).alias(f"{f}_tokens"), F.map_values(f"{f}_v").alias(f"{f}_weights")) for f in FIELDS]
    blank = F.coalesce(F.col("addr_n") == "", F.lit(True)).alias("blank")
    return [blank, *[c for pair in each for c in pair], *[_joined(F.col(c)).alias(c) for c in extras.bags], *extras.same, *extras.numbers, *extras.texts]


def _ranges(pool: DataFrame, pool_rows: int) -> dict[str, list[str]]:
    """Of each country with more than ``pool_rows`` rows the first ids of its ranges 1 and up, from a hashed sample of about SAMPLE ids a range."""
    sizes = {r["country"]: r["n"] for r in pool.groupBy("country").agg(F.count("*").alias("n")).where(F.col("n") > pool_rows).collect() if r["country"] is not None}
    drawn = F.pmod(F.xxhash64("entity_id"), F.lit(max(1, pool_rows // SAMPLE))) == 0
    ids: dict = {c: [] for c in sizes}
    for r in pool.select("country", "entity_id").where(F.col("country").isin(list(sizes)) & drawn).orderBy("entity_id").collect() if sizes else []:
        ids[r["country"]].append(r["entity_id"])
    numbers = {c: -(-n // pool_rows) for c, n in sizes.items()}
    return {c: sorted({ids[c][len(ids[c]) * k // n] for k in range(1, n)}) for c, n in numbers.items() if ids[c]}


def rank(
    s1: DataFrame, pool: DataFrame, kept: DataFrame, s1_vectors: DataFrame, pool_vectors: DataFrame, most: int, proxy: str, k: int, extras: Extras = Extras(), pool_rows: int = POOL_ROWS, s1_rows: int = S1_ROWS, finish: Callable[[DataFrame], DataFrame] = lambda pairs: pairs
) -> DataFrame:
    """The k best pairs of each S1 entity by proxy, of its ``most`` best by evidence: s1_id, cand_id, name_cos, addr_cos, proxy, cand_rank, and what ``extras`` names.

    The same rows as prefilter, cosines and rank_by_proxy over all pairs, which are not listed: a task has a block
    of S1 entities of a country and its pool, and works one S1 entity at a time. The pool comes row by row and is held as numbers; pairs leave
    as they are found. Only what survives leaves the task, and 0 or less keeps all. A country's pool of more than ``pool_rows`` rows is split by id. Then a first
    pass counts the evidence levels of each block, from which follow the level at which an entity's candidates end and how many each range
    has there, in the order of ids; so no candidate is lost or added. ``finish`` works on the pairs of each task, before those of several ranges meet.
    """
    k = k if k > 0 else (1 << 31) - 2
    bounds = _ranges(pool, pool_rows)
    at = lambda c, there: reduce(lambda e, x: F.when(F.col("country") == x[0], there(x[1])).otherwise(e), bounds.items(), c)
    part = at(F.lit(0), lambda ids: reduce(lambda a, b: a + b, [(F.col("entity_id") >= b).cast("int") for b in ids], F.lit(0)))
    total = s1.agg(F.count("*").alias("_all"))
    sizes = s1.groupBy("country").agg(F.count("*").alias("_n")).join(F.broadcast(total))
    shares = F.greatest(F.floor(BLOCKS * F.col("_n") / F.col("_all")), F.ceil(F.col("_n") / s1_rows), F.lit(1)).cast("int")
    blocks = F.broadcast(sizes.select("country", shares.alias("blocks")))

    weighed = blocking.keys(s1).join(kept, blocking.KEY).groupBy("entity_id").agg(
        F.array_sort(F.collect_list(F.struct(F.concat_ws(":", "family", "value").alias("key"), blocking.weight().alias("w")))).alias("e")
    )
    block = F.concat_ws(":", "p", "g", "country").alias("block")
    left = s1.join(weighed, "entity_id").join(s1_vectors, "entity_id", "left").join(blocks, "country")
    left = left.withColumns({"g": F.pmod(F.hash("entity_id"), F.col("blocks")), "p": F.explode(F.sequence(F.lit(0), at(F.lit(0), lambda ids: F.lit(len(ids)))))})
    left = left.select(block, F.lit(0).alias("side"), "p", "entity_id", _joined(F.col("e")["key"]).alias("keys"), F.col("e")["w"].alias("weights"), *_side_columns(extras))
    right = pool.join(pool_vectors, "entity_id", "left").join(blocks, "country").withColumn("k", blocking.key_array())
    right = right.withColumns({"g": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "p": part})
    keys = F.transform("k", lambda x: F.concat_ws(":", x["family"], x["value"]))
    right = right.select(block, F.lit(1).alias("side"), "p", "entity_id", _joined(keys).alias("keys"), *_side_columns(extras))

    def work(a: DataFrame, b: DataFrame, f: Callable, schema: str) -> DataFrame:
        if extras.texts:
            a, b = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (a, b))  # both come from one table
            return a.groupBy("block").cogroup(b.groupBy("block")).applyInArrow(_of_tables(f, schema), schema)
        both = a.unionByName(b, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "side", "entity_id")
        return both.mapInArrow(f, schema)

    if bounds and most > 0:
        by = ["block", "side", "p", "entity_id", "keys"]
        leveled = work(left.select(*by, "weights"), right.select(*by), _levels(most), LEVELS)
        all_of, level = Window.partitionBy("s1_id"), Window.partitionBy("s1_id", "score")
        leveled = leveled.withColumns({"there": F.sum("n").over(level), "through": F.sum("n").over(all_of.orderBy(F.desc("score")))})
        before = F.coalesce(F.sum("n").over(level.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        above = F.col("through") - F.col("there")
        edges = leveled.withColumn("quota", most - above - before).where((above < most) & (F.col("through") >= most))
        edges = edges.groupBy(F.col("s1_id").alias("entity_id")).agg(F.max("score").alias("edge"), F.map_from_entries(F.collect_list(F.struct("p", "quota"))).alias("quotas"))
        left = left.join(edges, "entity_id", "left").withColumns({"edge": F.coalesce("edge", F.lit(-1.0)), "quota": F.coalesce(F.col("quotas")[F.col("p")], F.lit(0)).cast("long")}).drop("quotas")
    found = finish(work(left, right, _ranked(most, proxy, k, extras), RESULT + extras.schema()))
    return blocking.top_k(found.drop("cand_rank"), "proxy", k) if bounds else found
