"""Gradient-boosted trees by the rules of Spark's GBTClassifier, all rounds in one job.

Spark's own trainer runs several jobs a round. Here one barrier stage holds the rows, as bins of their
features, for as long as the training lasts. The tasks send sums by node and bin to the first of them over
sockets; that one chooses the splits and tells the others. All sums are of whole numbers, so that the trees
depend neither on the number of tasks nor on the order of rows.
"""

from __future__ import annotations

import json
import secrets
import socket
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spark's number of bins, and about so many rows from which their edges are chosen (Spark: 10,000). All rows are trained on.
BINS, EDGE_ROWS = 32, 20_000
#: Fewer rows than this get no further task.
TASK_ROWS = 50_000
#: Bins of features that are counted together, as one number; rows counted at once.
JOINT, CHUNK = 1 << 10, 1 << 17
#: Bits of the largest weight, of the largest weighted residual, and below the point of a weighted loss.
WEIGHT_BITS, RESIDUAL_BITS, LOSS_BITS = 30, 30, 20
#: Seconds that a task waits for another one.
PATIENCE_S = 1800
#: Classes of rows: label 0 or 1, and 2 more for a row that decides when to stop.
STOPS = 2
NODES = "tree int, node int, feature int, threshold double, gain double, prediction double, total double"


def edges(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Thresholds between the bins of one feature, as Spark places them."""
    found, at = np.unique(values, return_inverse=True)
    counts = np.bincount(at, weights)
    between = (found[:-1] + found[1:]) / 2
    if len(between) < BINS:
        return between
    stride, out, goal = counts.sum() / BINS, [], counts.sum() / BINS
    sums = np.cumsum(counts)
    for i in range(1, len(found)):
        if abs(sums[i - 1] - goal) < abs(sums[i] - goal):
            out.append(between[i - 1])
            goal += stride
    return np.array(out)


def _grouped(sizes: list[int]) -> list[list[int]]:
    """Features that are counted together: their bins make JOINT numbers at most."""
    groups: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [g for g in groups if np.prod([sizes[j] for j in g]) * sizes[i] <= JOINT]
        fits[0].append(i) if fits else groups.append([i])
    return groups


class _Peers:
    """Sums over the tasks of the stage, made by the first one, and its word to the others."""

    def __init__(self, context: BarrierTaskContext | None):
        self.rank, self.others, tasks = 0, [], 1
        if context is None:
            return
        self.rank, infos = context.partitionId(), context.getTaskInfos()
        tasks = len(infos)
        listener, token = socket.socket(), secrets.token_hex(16)
        if self.rank == 0:
            listener.bind(("", 0))
            listener.listen(tasks)
            listener.settimeout(PATIENCE_S)
        port, token = context.allGather(f"{listener.getsockname()[1]} {token}" if self.rank == 0 else "")[0].split()
        if self.rank:
            self.others = [socket.create_connection((infos[0].address.rsplit(":", 1)[0], int(port)), PATIENCE_S)]
            self.others[0].sendall(token.encode())
        while self.rank == 0 and len(self.others) < tasks - 1:
            peer = listener.accept()[0]
            peer.settimeout(PATIENCE_S)
            if secrets.compare_digest(self._read(peer, len(token)), token.encode()):
                self.others.append(peer)
            else:
                peer.close()
        listener.close()
        for peer in self.others:
            peer.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    @staticmethod
    def _read(peer: socket.socket, size: int) -> bytearray:
        out = bytearray(size)
        view, at = memoryview(out), 0
        while at < size:
            got = peer.recv_into(view[at:])
            if not got:
                raise ConnectionError("another task of the training ended")
            at += got
        return out

    def total(self, mine: np.ndarray) -> np.ndarray:
        """The sum of all tasks' whole numbers at the first task; the own ones elsewhere."""
        if self.rank:
            self.others[0].sendall(np.ascontiguousarray(mine))
            return mine
        out = mine.copy()
        for peer in self.others:
            out += np.frombuffer(self._read(peer, mine.nbytes), np.int64).reshape(mine.shape)
        return out

    def told(self, word: np.ndarray) -> np.ndarray:
        """The first task's numbers, in the shape of the own ones."""
        if self.rank:
            return np.frombuffer(self._read(self.others[0], word.nbytes), word.dtype).reshape(word.shape)
        for peer in self.others:
            peer.sendall(np.ascontiguousarray(word))
        return word

    def close(self) -> None:
        for peer in self.others:
            peer.close()


def _drawn(keys: np.ndarray, draw: int, share: float) -> np.ndarray:
    """Whether a row is in the sample of a round: its key's hash is under the share."""
    if share >= 1:
        return np.ones(len(keys), bool)
    h = keys ^ np.uint32(draw * 0x9E3779B9 & 0xFFFFFFFF)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    return (h ^ (h >> np.uint32(16))) < np.uint32(min(share * 2**32, 2**32 - 1))


class _Trainer:
    """One task's rows, and the rounds over them. codes: by group of features, the joint bins; kinds: classes of rows."""

    def __init__(self, codes: list[np.ndarray], kinds: np.ndarray, keys: np.ndarray, s: dict, peers: _Peers):
        self.s, self.peers, self.groups = s, peers, s["groups"]
        order = np.argsort(kinds >= STOPS, kind="stable")  # those that decide when to stop come last
        self.kinds, self.keys, self.codes = kinds[order], keys[order], []
        while codes:
            self.codes.append(codes.pop(0)[order])
        self.n, self.fit = len(kinds), int((kinds < STOPS).sum())
        self.thresholds: list[np.ndarray] = s["thresholds"]
        self.sizes = [len(t) + 1 for t in self.thresholds]
        self.starts = np.cumsum([0, *self.sizes])
        self.owner = np.repeat(np.arange(len(self.sizes)), [x - 1 for x in self.sizes])
        self.ends = np.concatenate([self.starts[f] + np.arange(x - 1) for f, x in enumerate(self.sizes)] or [np.zeros(0, int)]).astype(int)
        self.unit = 2.0**RESIDUAL_BITS / (4 * max(s["weight"], 1.0))
        self.weights = np.array([1.0, s["weight"]])
        self.weight_unit = 2.0 ** (WEIGHT_BITS - np.ceil(np.log2(max(s["weight"], 1.0))))
        self.units = np.rint(np.array([0.0, *self.weights]) * self.weight_unit)  # of rows not drawn, of label 0, of label 1

    def counted(self, nodes: np.ndarray, level: int, drawn: np.ndarray, residuals: np.ndarray) -> np.ndarray:
        """Sums of residuals and of weights by node of the level and bin of each feature."""
        first, width = (1 << level) - 1, 1 << level
        out = np.zeros((width, self.starts[-1], 2), np.int64)
        for a in range(0, self.fit, CHUNK):
            part = slice(a, min(a + CHUNK, self.fit))
            at = nodes[part].astype(np.int64) - first
            at[at < 0] = width  # a leaf above
            sums = (residuals[part].astype(np.float64), self.units[drawn[part]])
            for group, codes in zip(self.groups, self.codes, strict=True):
                shape = [self.sizes[f] for f in group]
                joint = int(np.prod(shape))
                index = at * joint + codes[part]
                for k, x in enumerate(sums):
                    cube = np.bincount(index, x, (width + 1) * joint)[: width * joint].reshape(width, *shape)
                    for i, f in enumerate(group):
                        alone = cube.sum(axis=tuple(j + 1 for j in range(len(group)) if j != i))
                        out[:, self.starts[f] : self.starts[f + 1], k] += np.rint(alone).astype(np.int64)
        return out

    def chosen(self, sums: np.ndarray, level: int, draw: int, tree: dict[str, np.ndarray]) -> None:
        """Write the best split of each node of the level, and the predictions below, to the tree."""
        first = (1 << level) - 1
        cum = np.cumsum(sums, axis=1)
        before = np.concatenate([np.zeros((len(sums), 1, 2), np.int64), cum], axis=1)[:, self.starts[:-1]]
        left = (cum[:, self.ends] - before[:, self.owner]).astype(float)
        whole = cum[:, self.starts[1] - 1].astype(float)
        scale = np.array([1 / self.unit, 1 / self.weight_unit])
        left, whole = left * scale, whole * scale
        right = whole[:, None] - left
        if level == 0:
            tree["prediction"][0] = whole[0, 0] / whole[0, 1] if whole[0, 1] else 0.0
        columns = self.s["columns"]
        for i in range(len(sums)):
            node, w = first + i, whole[i, 1]
            if not w or (level and tree["feature"][(node - 1) // 2] < 0):
                continue
            valid = (left[i, :, 1] > 0) & (right[i, :, 1] > 0)
            if self.s["each"] < self.s["features"]:
                some = np.random.default_rng([self.s["seed"], draw, node]).choice(self.s["features"], self.s["each"], replace=False)
                valid &= np.isin(columns, some)[self.owner]
            if not valid.any():
                continue
            least = whole[i, 0] ** 2 / w
            safe = lambda side: np.where(valid, side[i, :, 0] ** 2 / np.where(valid, side[i, :, 1], 1.0), 0.0)
            gain = np.where(valid, safe(left) + safe(right) - least, -1.0)
            best = int(np.argmax(gain))
            if gain[best] <= 1e-9 * w * 2.0**-10:  # no more than the rounding of residuals makes
                continue
            f = int(self.owner[best])
            tree["feature"][node], tree["bin"][node], tree["gain"][node], tree["total"][node] = f, best - (self.starts[f] - f), gain[best] / w, w
            for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
                tree["prediction"][child] = side[i, best, 0] / side[i, best, 1]

    def routed(self, nodes: np.ndarray, level: int, tree: dict[str, np.ndarray]) -> None:
        """Move the rows of the level's split nodes to their children."""
        first, width = (1 << level) - 1, 1 << level
        of = {f: (g, i) for g, group in enumerate(self.groups) for i, f in enumerate(group)}
        most = max(int(np.prod([self.sizes[f] for f in group])) for group in self.groups)
        step = np.zeros((width + 1, most), nodes.dtype)  # by node and joint bin: 0 stays, 1 left, 2 right
        group_of = np.zeros(width + 1, np.int64)
        for i in range(width):
            f = int(tree["feature"][first + i])
            if f >= 0:
                g, at = of[f]
                shape = [self.sizes[x] for x in self.groups[g]]
                bins = np.arange(int(np.prod(shape))) // int(np.prod(shape[at + 1 :])) % shape[at]
                step[i, : len(bins)] = 1 + (bins > tree["bin"][first + i])
                group_of[i] = g
        used = np.unique(group_of)
        for a in range(0, self.n, CHUNK):
            part = slice(a, min(a + CHUNK, self.n))
            at = nodes[part].astype(np.int64) - first
            at[at < 0] = width
            codes = self.codes[used[0]][part].astype(np.int64)
            for g in used[1:]:
                codes = np.where(group_of[at] == g, self.codes[g][part], codes)
            move = step.ravel()[at * most + codes]
            nodes[part] = np.where(move > 0, 2 * nodes[part] + move, nodes[part])

    def loss(self, margins: np.ndarray) -> np.ndarray:
        """The weighted log loss of the rows that decide when to stop, and their weight."""
        y = self.kinds[self.fit :] & 1
        w = self.weights[y]
        lost = 2 * np.logaddexp(0, -2 * (2.0 * y - 1) * margins[self.fit :])
        return np.array([np.rint(lost * w * 2.0**LOSS_BITS).astype(np.int64).sum(), np.rint(w * 2.0**LOSS_BITS).astype(np.int64).sum()], np.int64)

    def trees(self) -> list[dict[str, np.ndarray]]:
        s, depth, size = self.s, self.s["depth"], (2 << self.s["depth"]) - 1
        margins, out, best, least = np.zeros(self.n), [], 0, np.inf
        for m in range(s["rounds"]):
            residuals, drawn = np.zeros(self.fit, np.int32), np.zeros(self.fit, np.uint8)
            for a in range(0, self.fit, CHUNK):
                part = slice(a, min(a + CHUNK, self.fit))
                y = 2.0 * (self.kinds[part] & 1) - 1
                r = y if m == 0 else 4 * y / (1 + np.exp(np.minimum(2 * y * margins[part], 700)))
                inside = _drawn(self.keys[part], s["seed"] + m, s["share"])
                drawn[part] = np.where(inside, (self.kinds[part] & 1) + 1, 0)
                residuals[part] = np.where(inside, np.rint(r * self.weights[self.kinds[part] & 1] * self.unit), 0)
            nodes = np.zeros(self.n, np.min_scalar_type(size + 1))
            tree = {"feature": np.full(size, -1), "bin": np.zeros(size, int), "gain": np.zeros(size), "total": np.zeros(size), "prediction": np.zeros(size)}
            for level in range(depth if self.groups else 0):
                sums = self.peers.total(self.counted(nodes, level, drawn, residuals))
                if self.peers.rank == 0:
                    self.chosen(sums, level, s["seed"] + m, tree)
                here = slice((1 << level) - 1, (2 << level) - 1)
                tree["feature"][here], tree["bin"][here] = self.peers.told(np.stack([tree["feature"][here], tree["bin"][here]]))
                if (tree["feature"][here] < 0).all():
                    break
                self.routed(nodes, level, tree)
            if not self.groups:  # no feature has two values
                sums = self.peers.total(np.array([residuals.sum(dtype=np.int64), self.units[drawn].astype(np.int64).sum()]))
                tree["prediction"][0] = sums[0] / self.unit / (sums[1] / self.weight_unit) if sums[1] else 0.0
            tree["prediction"] = self.peers.told(tree["prediction"])
            out.append(tree)
            margins += (s["rate"] if m else 1.0) * tree["prediction"][nodes]
            lost, weight = self.peers.told(self.peers.total(self.loss(margins)))
            if not weight:  # no row decides when to stop
                best = m + 1
                continue
            now = lost / weight
            if m and least - now < s["tolerance"] * max(now, 0.01):
                break
            if now < least:
                best, least = m + 1, now
        return out[:best]


def _packed(s: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of features to the joint bins of each batch, in one value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = [np.searchsorted(t, batch.column(f"x{i}").to_numpy(zero_copy_only=False)) for i, t in enumerate(s["thresholds"])]
            rows = np.zeros(batch.num_rows, _record(s))
            for k, group in enumerate(s["groups"]):
                for f in group:
                    rows[f"g{k}"] = rows[f"g{k}"] * (len(s["thresholds"][f]) + 1) + bins[f]
            rows["kind"], rows["key"] = batch.column("kind").to_numpy(), batch.column("key").to_numpy().astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary())], ["rows"])

    return run


def _record(s: dict) -> np.dtype:
    return np.dtype([("key", np.uint32), *[(f"g{k}", np.uint16) for k in range(len(s["groups"]))], ("kind", np.uint8)])


def _trained(s: dict, barrier: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The packed rows of a task to the trees; the first task returns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = _record(s)
        blocks = [np.frombuffer(x.as_buffer(), record) for batch in batches for x in batch.column(0)]
        rows = np.concatenate(blocks) if blocks else np.zeros(0, record)
        blocks.clear()
        columns = [np.ascontiguousarray(rows[c]) for c in (*[f"g{k}" for k in range(len(s["groups"]))], "kind", "key")]
        del rows
        peers = _Peers(BarrierTaskContext.get() if barrier else None)
        try:
            trees = _Trainer(columns[:-2], *columns[-2:], s, peers).trees()
        finally:
            peers.close()
        if peers.rank:
            return
        for m, tree in enumerate(trees):
            f = tree["feature"]
            node = [i for i in range(len(f)) if i == 0 or f[(i - 1) // 2] >= 0]
            split = [int(f[i]) for i in node]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([m] * len(node), pa.int32()),
                    pa.array(node, pa.int32()),
                    pa.array([s["columns"][x] if x >= 0 else -1 for x in split], pa.int32()),
                    pa.array([float(s["thresholds"][x][tree["bin"][i]]) if x >= 0 else 0.0 for i, x in zip(node, split, strict=True)], pa.float64()),
                    pa.array(tree["gain"][node], pa.float64()),
                    pa.array(tree["prediction"][node], pa.float64()),
                    pa.array(tree["total"][node], pa.float64()),
                ],
                [x.split()[0] for x in NODES.split(", ")],
            )

    return run


def _model(rows: DataFrame, found: list, features: int, rate: float) -> GBTClassificationModel:
    """Spark's own model of the trees. Nodes have their predictions, gains and, where they split, weights; no impurities."""
    sc = rows.sparkSession.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml, mllib = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib
    stats, leaf, inner, cut, vector = mllib.tree.impurity.VarianceCalculator, ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, mllib.linalg.Vectors.fromJson
    none = stats(gateway.new_array(jvm.double, 3), 0)
    by_tree: dict[int, dict] = {}
    for r in found:
        by_tree.setdefault(r["tree"], {})[r["node"]] = r

    def built(nodes: dict, i: int):
        r = nodes[i]
        if r["feature"] < 0:
            return leaf(r["prediction"], 0.0, none)
        own = vector(json.dumps({"type": 1, "values": [r["total"], r["total"] * r["prediction"], 0.0]})).toArray()
        return inner(r["prediction"], 0.0, r["gain"], built(nodes, 2 * i + 1), built(nodes, 2 * i + 2), cut(r["feature"], r["threshold"]), stats(own, 0))

    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(by_tree))
    weights = gateway.new_array(jvm.double, len(by_tree))
    uid, model = ml.util.Identifiable.randomUID, ml.regression.DecisionTreeRegressionModel
    for m, nodes in sorted(by_tree.items()):
        trees[m] = model(uid("dtr"), built(nodes, 0), features)
        weights[m] = rate if m else 1.0
    return GBTClassificationModel(ml.classification.GBTClassificationModel(uid("GBTClassifier"), trees, weights, features, 2))


def tasks(rows: int, df: DataFrame) -> int:
    """Tasks that can run at once, as all of a barrier stage must; one where executors come and go, as Spark has no such stages there."""
    sc = df.sparkSession.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    jsc = sc._jsc.sc()
    return max(1, min(rows // TASK_ROWS, jsc.maxNumConcurrentTasks(jsc.resourceProfileManager().defaultResourceProfile())))


def fit(
    rows: DataFrame, columns: list[str], count: int, weight: float, rounds: int, depth: int, rate: float, share: float, each: float, seed: int, tolerance: float, partitions: int | None = None
) -> GBTClassificationModel:
    """Trees on rows with numeric columns, label (0 or 1), stops (decides when to stop) and key (an int that the sample of a round is drawn by).

    count: about the number of rows; weight: of a row of label 1; share: of rows drawn for a round; each: share of
    features tried at a node. Training ends at the first round that does not lower the loss of the stopping rows by tolerance.
    """
    kept = rows.select(*columns, "key", (F.col("label").cast("int") + F.when(F.col("stops"), STOPS).otherwise(0)).alias("kind"))
    least = -(-EDGE_ROWS * (1 << 20) // max(count, 1))
    seen = kept.where((F.col("kind") < STOPS) & (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 20)) < least)).toArrow()
    if not seen.num_rows:
        raise ValueError("no rows to fit trees on")
    weights = np.where(seen.column("kind").to_numpy() == 1, weight, 1.0)
    cuts = [edges(seen.column(c).to_numpy(), weights) for c in columns]
    used = [i for i, t in enumerate(cuts) if len(t)]
    s = {
        "columns": np.array(used, int), "thresholds": [cuts[i] for i in used], "features": len(columns), "each": int(np.ceil(each * len(columns))), "weight": float(weight),
        "rounds": rounds, "depth": depth, "rate": rate, "share": share, "seed": seed, "tolerance": tolerance,
    }
    s["groups"] = _grouped([len(t) + 1 for t in s["thresholds"]])
    n = partitions or tasks(count, rows)
    packed = kept.select(*[F.col(columns[c]).alias(f"x{i}") for i, c in enumerate(used)], "kind", "key").mapInArrow(_packed(s), "rows binary")
    found = packed.repartition(n).mapInArrow(_trained(s, n > 1), NODES, barrier=n > 1).collect()
    return _model(rows, found, len(columns), rate)
