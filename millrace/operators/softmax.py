"""Multi-class gradient boosting under one softmax loss, fitted by distributed histograms.

Each round grows one tree per class on the residuals y - p of the shared softmax. Rows are stored with their features as bin
numbers and their margins; a level of all trees of a round is one aggregation: tasks add up gradient, curvature and count by
(tree, node, feature, bin), and only these sums, whose number does not depend on the rows, reach the driver. Leaf values are
Newton steps. Trees since the last stored margins are applied again in each task; every `STORED` rounds margins are stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators.attributions import Leaf, _leaf
from millrace.plans.scratch import materialize

BINS = 64
STORED = 10
#: Small tables go through few tasks.
TASK_ROWS = 50_000


@dataclass
class Tree:
    """Nodes as in a heap: children of i are 2i + 1 and 2i + 2. `feature` is -1 at leaves; a value up to `cut` (bin up to
    `bin`) goes left. Values are already times the learning rate."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    count: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros(n, int), np.zeros(n), np.zeros(n), np.zeros(n))

    def nodes(self, cells: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The node that each row of `cells` reaches; `bounds` is `bin` for bin numbers, `cut` for values."""
        at, every = np.zeros(len(cells), int), np.arange(len(cells))
        for _ in range(int(np.log2(len(self.feature) + 1)) - 1):
            f = self.feature[at]
            right = cells[every, np.maximum(f, 0)] > bounds[at]
            at = np.where(f < 0, at, 2 * at + 1 + right)
        return at

    def leaves(self) -> list[Leaf]:
        out, stack = [], [(0, [])]
        while stack:
            i, path = stack.pop()
            if self.feature[i] < 0:
                out.append(_leaf(path, float(self.value[i])))
                continue
            for child, low, high in ((2 * i + 1, -np.inf, self.cut[i]), (2 * i + 2, self.cut[i], np.inf)):
                stack.append((child, [*path, (int(self.feature[i]), low, high, self.count[child] / self.count[i])]))
        return out


@dataclass(frozen=True)
class SoftmaxModel:
    """`rounds` holds one tree per class each; `losses` the mean training log loss before each round."""

    prior: np.ndarray
    rounds: tuple[tuple[Tree, ...], ...]
    losses: tuple[float, ...] = field(default=())

    def margins(self, values: np.ndarray) -> np.ndarray:
        out = np.tile(self.prior, (len(values), 1))
        for trees in self.rounds:
            for k, t in enumerate(trees):
                out[:, k] += t.value[t.nodes(values, t.cut)]
        return out

    def leaves(self, k: int) -> list[Leaf]:
        """Leaves of one class's trees; the prior is a leaf that every row reaches."""
        return [_leaf([], float(self.prior[k])), *(leaf for trees in self.rounds for leaf in trees[k].leaves())]


def _chances(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _drawn(rows: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Rows that take part in a round, by a hash of row, round and seed."""
    x = rows.astype(np.uint64) + np.uint64((seed * 1_000_003 + round_ + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of a common 64-bit mixer
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return (x ^ (x >> np.uint64(31))) <= np.uint64(min(int(share * 2**64), 2**64 - 1))


def _read(batch: pa.RecordBatch, n_features: int, n_classes: int):
    cells = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(-1, n_features)
    margins = np.frombuffer(b"".join(batch.column("margins").to_pylist()), np.float64).reshape(-1, n_classes).copy()
    return batch.column("row").to_numpy(), batch.column("k").to_numpy(), cells, margins


def _apply(margins: np.ndarray, cells: np.ndarray, rounds) -> np.ndarray:
    for trees in rounds:
        for k, t in enumerate(trees):
            margins[:, k] += t.value[t.nodes(cells, t.bin)]
    return margins


_TABLE = "row bigint, k int, cells binary, margins binary"
_SUMS = "tree int, cell int, g double, h double, n double"


def _stored(rows: DataFrame, rounds, n_features: int, n_classes: int) -> DataFrame:
    """The rows with the trees of `rounds` in their margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, cells, margins = _read(batch, n_features, n_classes)
            new = [m.tobytes() for m in _apply(margins, cells, rounds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.binary())], batch.schema.names)

    return materialize(rows.mapInArrow(run, _TABLE), "softmax-rows")


def _level_sums(rows: DataFrame, rounds, growing: list[Tree], level: int, round_: int, seed: int, share: float, n_features: int) -> DataFrame:
    """(tree, cell, g, h, n) of the level's nodes; cell -1 of tree -1 has log loss and count of all rows in g and n."""
    n_classes, first, wide = len(growing), 2**level - 1, 2**level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_classes, 3, wide * n_features * BINS))
        loss = count = 0.0
        for batch in batches:
            row, y, cells, margins = _read(batch, n_features, n_classes)
            p = _chances(_apply(margins, cells, rounds))
            loss -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum()
            count += len(y)
            used = _drawn(row, round_, seed, share)
            y, cells, p = y[used], cells[used], p[used]
            for k, t in enumerate(growing):
                at = t.nodes(cells, t.bin) - first
                here = at >= 0  # the others ended in leaves above
                at, c, q = at[here], cells[here], p[here, k]
                g, h = (y[here] == k) - q, q * (1 - q)
                for f in range(n_features):
                    cell = (at * n_features + f) * BINS + c[:, f]
                    for s, weight in enumerate((g, h, None)):
                        sums[k, s] += np.bincount(cell, weight, wide * n_features * BINS)
        k, cell = np.nonzero(sums[:, 2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(k, -1), pa.int32()), pa.array(np.append(cell, -1), pa.int32()), *[pa.array(np.append(sums[k, s, cell], x)) for s, x in enumerate((loss, 0.0, count))]],
            ["tree", "cell", "g", "h", "n"],
        )

    found = rows.mapInArrow(run, _SUMS)
    return found.groupBy("tree", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


def _newton(g: float, h: float, n_classes: int, rate: float) -> float:
    return rate * (n_classes - 1) / n_classes * g / h if h > 1e-150 else 0.0


def _grow(tree: Tree, sums: np.ndarray, level: int, depth: int, cuts: list[np.ndarray], n_classes: int, rate: float) -> None:
    """Split the level's nodes; `sums` is (3, nodes, features, bins). The best split lessens the squared error of the
    residuals most; on ties the lower feature, then the lower bin wins. Children get the values of leaves."""
    first = 2**level - 1
    for node in range(2**level):
        i = first + node
        if level and tree.feature[(i - 1) // 2] < 0:
            continue
        cells = sums[:, node]
        total = cells[:, 0].sum(axis=1)
        if level == 0:
            tree.count[0], tree.value[0] = total[2], _newton(total[0], total[1], n_classes, rate)
        left = np.cumsum(cells, axis=2)
        right = total[:, None, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / left[2] + right[0] ** 2 / right[2] - (total[0] ** 2 / total[2] if total[2] else 0)
        gain[(left[2] < 0.5) | (right[2] < 0.5)] = -1
        best = gain.max()
        if not best > 1e-12:
            continue
        f, b = np.unravel_index(np.argmax(gain >= best * (1 - 1e-9)), gain.shape)
        tree.feature[i], tree.bin[i], tree.cut[i] = f, b, cuts[f][b]
        for child, side in ((2 * i + 1, left), (2 * i + 2, right)):
            tree.count[child] = side[2, f, b]
            tree.value[child] = _newton(side[0, f, b], side[1, f, b], n_classes, rate)


def _cut_points(rows: DataFrame, n_features: int) -> list[np.ndarray]:
    """All values of a feature that has up to `BINS`; else quantiles with equal shares of the rows between them."""
    x = [F.get("x", F.lit(f)) for f in range(n_features)]
    kinds = rows.agg(*[F.approx_count_distinct(v, 0.01).alias(f"f{f}") for f, v in enumerate(x)]).first()
    shares = F.array(*[F.lit((b + 1) / BINS) for b in range(BINS - 1)])
    quantiles = [F.percentile_approx(v, shares, 10_000).alias(f"q{f}") for f, v in enumerate(x)]
    few = [f for f in range(n_features) if kinds[f] <= BINS * 1.1]  # collected sets are small
    found = rows.agg(*quantiles, *[F.collect_set(x[f]).alias(f"s{f}") for f in few]).first().asDict()
    sets = {f: np.unique(np.array(found[f"s{f}"], float)) for f in few}
    return [sets[f] if f in sets and len(sets[f]) <= BINS else np.unique(np.array(found[f"q{f}"], float)) for f in range(n_features)]


def fit_softmax(train: DataFrame, target: Column, n_classes: int, features: list[str], trees: int, depth: int, rate: float, subsample: float, seed: int) -> SoftmaxModel:
    """`target` numbers the classes from 0. Features must be numbers without NULL and NaN; fewer than two rows cannot be split."""
    assembled = VectorAssembler(inputCols=features, outputCol="_x").transform(train)
    rows = assembled.select(F.monotonically_increasing_id().alias("row"), target.cast("int").alias("k"), vector_to_array("_x").alias("x"))
    rows = materialize(rows, "softmax-values")
    counts = {r["k"]: r["n"] for r in rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = np.log(np.array([counts[k] for k in range(n_classes)]) / sum(counts.values()))
    cuts = _cut_points(rows, len(features))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(cuts))
            cells = np.stack([np.searchsorted(c, values[:, f]) for f, c in enumerate(cuts)], axis=1).astype(np.uint8)
            margins = [prior.tobytes()] * len(cells)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([c.tobytes() for c in cells], pa.binary()), pa.array(margins, pa.binary())], ["row", "k", "cells", "margins"])

    tasks = min(rows.rdd.getNumPartitions(), -(-sum(counts.values()) // TASK_ROWS))
    table = materialize(rows.coalesce(tasks).mapInArrow(binned, _TABLE), "softmax-rows")
    done: list[tuple[Tree, ...]] = []
    recent: list[tuple[Tree, ...]] = []
    losses = []
    for r in range(trees):
        growing = [Tree.empty(depth) for _ in range(n_classes)]
        for level in range(depth):
            sums = np.zeros((n_classes, 3, 2**level * len(cuts) * BINS))
            for s in _level_sums(table, recent, growing, level, r, seed, subsample, len(cuts)).collect():
                if s["tree"] >= 0:
                    sums[s["tree"], :, s["cell"]] = s["g"], s["h"], s["n"]
                elif level == 0:
                    losses.append(s["g"] / s["n"])
            for k, t in enumerate(growing):
                _grow(t, sums[k].reshape(3, 2**level, len(cuts), BINS), level, depth, cuts, n_classes, rate)
        recent.append(tuple(growing))
        done.append(tuple(growing))
        if len(recent) == STORED:
            table, recent = _stored(table, recent, len(cuts), n_classes), []
    return SoftmaxModel(prior, tuple(done), tuple(losses))


def with_margins(df: DataFrame, model: SoftmaxModel, features: list[str], name: str) -> DataFrame:
    """Adds the margins of all classes as an array. The trees travel as a broadcast: their size is the model's."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        values = np.array(x.tolist(), float).reshape(len(x), -1)
        return pd.Series(list(shared.value.margins(values)))

    return df.withColumn(name, margins(F.array(*[col(f).cast("double") for f in features])))
