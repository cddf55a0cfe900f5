"""Per-row feature attributions of boosted trees, and what is read off them.

For a leaf that a row reaches under conditions on m features, the Shapley value of feature j is
    v * (o_j - z_j) * integral over t in [0, 1] of prod_{k != j} (z_k (1 - t) + o_k t) dt
where o_k says whether the row meets the leaf's condition on feature k and z_k is the share of
training rows that does along the path (path-dependent expectation, arXiv:1802.03888). The
integrand is a polynomial, so a few Gauss-Legendre nodes give it exactly, and it depends on the
row only through the m bits o, so each leaf carries a table of 2^m answers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.plans.scratch import scratch_path

TABLE_BITS = 10


@dataclass(frozen=True)
class Leaf:
    """Interval (low, high] and training share per feature on the path, and the leaf value."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: float
    table: np.ndarray | None


def shapley(met: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    """Rows of condition bits (n, m) to rows of contributions (n, m)."""
    m = share.size
    nodes, weights = np.polynomial.legendre.leggauss(m // 2 + 1)
    out = np.zeros(met.shape, dtype=float)
    for x, w in zip(nodes, weights):
        t = (x + 1) / 2
        factor = share * (1 - t) + met * t
        for j in range(m):
            out[:, j] += w / 2 * np.prod(np.delete(factor, j, axis=1), axis=1)
    return value * (met - share) * out


def _leaf(path: Sequence[tuple[int, float, float, float]], value: float) -> Leaf:
    merged: dict[int, list[float]] = {}
    for feature, low, high, share in path:
        seen = merged.setdefault(feature, [-np.inf, np.inf, 1.0])
        merged[feature] = [max(seen[0], low), min(seen[1], high), seen[2] * share]
    names = np.array(list(merged), dtype=int)
    low, high, share = (np.array([r[i] for r in merged.values()]) for i in range(3))
    table = None
    if names.size <= TABLE_BITS:
        bits = (np.arange(2**names.size)[:, None] >> np.arange(names.size)) & 1
        table = shapley(bits.astype(float), share, value)
    return Leaf(names, low, high, share, value, table)


def read_leaves(spark: SparkSession, model) -> list[Leaf]:
    """Leaves of a fitted tree ensemble, values already times the tree weights.

    The size is that of the model (trees times leaves), never that of the data.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        nodes.setdefault(r["treeID"], {})[r["id"]] = r
    weights = list(model.treeWeights)
    leaves = []
    for tree, by_id in nodes.items():
        stack = [(0, [])]
        while stack:
            at, path_so_far = stack.pop()
            node = by_id[at]
            if node["leftChild"] < 0:
                leaves.append(_leaf(path_so_far, node["prediction"] * weights[tree]))
                continue
            feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            for child, low, high in ((node["leftChild"], -np.inf, cut), (node["rightChild"], cut, np.inf)):
                share = by_id[child]["rawCount"] / node["rawCount"]
                stack.append((child, [*path_so_far, (feature, low, high, share)]))
    return leaves


def base_value(leaves: Sequence[Leaf]) -> float:
    """Expected margin over the training rows."""
    return float(sum(leaf.value * np.prod(leaf.share) for leaf in leaves))


def contributions(leaves: Sequence[Leaf], rows: np.ndarray) -> np.ndarray:
    out = np.zeros(rows.shape, dtype=float)
    for leaf in leaves:
        if not leaf.features.size:
            continue
        cells = rows[:, leaf.features]
        met = (cells > leaf.low) & (cells <= leaf.high)
        if leaf.table is not None:
            part = leaf.table[met @ (1 << np.arange(leaf.features.size))]
        else:
            part = shapley(met.astype(float), leaf.share, leaf.value)
        out[:, leaf.features] += part
    return out


def attribute(df: DataFrame, models: dict[int, list[Leaf]], features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """key..., class, base_value, contributions (an array in feature order), for every row and
    class. The trees travel as a broadcast; rows stream through in Arrow batches."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((models, {c: base_value(ls) for c, ls in models.items()}))
    keyed = df.select(*[col(k) for k in key], *[col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)])
    keys = list(key)
    inputs = [f"_f{i}" for i in range(len(features))]
    schema = ", ".join(
        [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
        + ["class int", "base_value double", "contributions array<double>"]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_class, bases = shared.value
        for batch in batches:
            rows = batch[inputs].to_numpy(dtype=float)
            for c, leaves in by_class.items():
                out = batch[keys].copy()
                out["class"] = c
                out["base_value"] = bases[c]
                out["contributions"] = list(contributions(leaves, rows))
                yield out

    return keyed.mapInPandas(run, schema)


def long_form(attributed: DataFrame, features: Sequence[str], array: str = "contributions") -> DataFrame:
    """One row per feature: the array column gives way to (feature, feature_index, contribution)."""
    rest = [col(c) for c in attributed.columns if c != array]
    names = F.array(*[F.lit(f) for f in features])
    spread = attributed.select(*rest, F.posexplode(col(array)).alias("feature_index", "contribution"))
    return spread.withColumn("feature", F.get(names, F.col("feature_index")))


def top_contributions(attributed: DataFrame, features: Sequence[str], k: int = 10, array: str = "contributions") -> DataFrame:
    """The k largest contributions by size of every row, ties in feature order.

    Sorting happens inside the row's own array, so nothing is shuffled.
    """
    names = F.array(*[F.lit(f) for f in features])
    cells = F.transform(
        col(array),
        lambda x, i: F.struct(
            (-F.abs(x)).alias("size"), i.alias("feature_index"), F.get(names, i).alias("feature"), x.alias("contribution")
        ),
    )
    best = F.slice(F.array_sort(cells), 1, k)
    rest = [col(c) for c in attributed.columns if c != array]
    ranked = attributed.select(*rest, F.posexplode(best).alias("place", "cell"))
    return ranked.select(
        *[col(c) for c in attributed.columns if c != array],
        (F.col("place") + 1).alias("rank"),
        F.col("cell.feature").alias("feature"),
        F.col("cell.contribution").alias("contribution"),
    )


def global_importance(attributed: DataFrame, features: Sequence[str], max_display: int = 20, by: Sequence[str] = ("class",)) -> DataFrame:
    """by..., feature, importance: mean absolute contribution, the `max_display` largest per group."""
    sizes = long_form(attributed, features).groupBy(*by, "feature").agg(
        F.avg(F.abs("contribution")).alias("importance")
    )
    order = Window.partitionBy(*by).orderBy(F.desc("importance"), "feature")
    return sizes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_display).drop("rank")
