"""Point-in-time lookup: the latest feature row at or before each row's time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.plans.scratch import materialize
from millrace.plans.slices import range_slices

HOT_KEY_ROWS = 5_000_000
BROADCAST_KEYS = 100_000
BROADCAST_BYTES = 64 << 20


def as_of(
    spine: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    spine_ts: str,
    feature_ts: str,
    values: Sequence[str] | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Left join of each spine row with the last feature row of its key where
    `feature_ts <= spine_ts`; of several at one time the greatest counts. Times of different
    types are compared in the wider one: a date is its midnight.

    Spine and features are merged and the last feature is carried forward per key: one shuffle.
    Spine rows without key or time can match nothing and skip it. Keys that hold more rows
    than `hot_key_rows` go alone through range slices; all others keep the one shuffle.
    """
    names = list(values or [c for c in features.columns if c not in keys and c != feature_ts])
    clash = set(names) & set(spine.columns)
    if clash:
        raise ValueError(f"Feature columns already in the spine: {sorted(clash)}")
    on = [col(k) for k in keys]
    both = [F.lit(None).cast(d.schema[t].dataType) for d, t in ((spine, spine_ts), (features, feature_ts))]
    wide = spine.select(F.coalesce(*both).alias("t")).schema["t"].dataType
    known = features.select(
        *on,
        col(feature_ts).cast(wide).alias("_ts"),
        F.struct(*[col(n) for n in names]).alias("_feature"),
    )
    known = known.where(reduce(lambda a, b: a & b, [F.col("_ts").isNotNull(), *[k.isNotNull() for k in on]]))
    sizes = known.select(*on).unionAll(spine.select(*on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where((F.col("_n") > hot_key_rows) & reduce(lambda a, b: a & b, [k.isNotNull() for k in on]))
    hot = materialize(large.select(*on), "hot-keys")
    size = hot.agg(F.count(F.lit(1)).alias("n"), F.sum(sum((F.octet_length(k.cast("string")) for k in on), F.lit(16))).alias("bytes")).first()
    if not size["n"]:
        return _in_windows(spine, features, known, keys, spine_ts, names, wide)
    hot = F.broadcast(hot) if size["n"] <= BROADCAST_KEYS and size["bytes"] <= BROADCAST_BYTES else hot
    few = _in_windows(
        spine.join(hot, list(keys), "left_anti").select(*[col(c) for c in spine.columns]),
        features, known.join(hot, list(keys), "left_anti"), keys, spine_ts, names, wide,
    )
    many = _through_slices(
        spine.join(hot, list(keys), "left_semi").select(*[col(c) for c in spine.columns]),
        known.join(hot, list(keys), "left_semi"), keys, spine_ts, names,
    )
    return few.unionByName(many)


def _in_windows(
    spine: DataFrame, features: DataFrame, known: DataFrame, keys: Sequence[str], spine_ts: str, names: Sequence[str], wide
) -> DataFrame:
    """The lookup for keys that each fit one task."""
    on = [col(k) for k in keys]
    complete = reduce(lambda a, b: a & b, [col(spine_ts).isNotNull(), *[k.isNotNull() for k in on]])
    rows = spine.where(complete).select(
        *on, col(spine_ts).cast(wide).alias("_ts"), F.struct(*[col(c) for c in spine.columns]).alias("_row")
    )
    merged = known.withColumn("_side", F.lit(0)).unionByName(rows.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy(*on).orderBy("_ts", "_side", "_feature").rowsBetween(Window.unboundedPreceding, 0)
    carried = merged.withColumn("_found", F.last("_feature", ignorenulls=True).over(so_far))
    matched = carried.where(F.col("_side") == 1).select("_row.*", *[F.col("_found")[n].alias(n) for n in names])
    unmatched = spine.where(~complete).select(
        "*", *[F.lit(None).cast(features.schema[n].dataType).alias(n) for n in names]
    )
    return matched.unionByName(unmatched)


def _through_slices(
    spine: DataFrame, known: DataFrame, keys: Sequence[str], spine_ts: str, names: Sequence[str]
) -> DataFrame:
    """The same for keys too large for one task.

    Features fold to one per (key, time) and spine rows to distinct (key, time) points. The
    merged rows are cut into range slices that may split a key; each slice starts from the last
    feature of the slices before it. The answers are joined back to the spine.
    """
    on = [col(k) for k in keys]
    latest = known.groupBy(*on, "_ts").agg(F.max("_feature").alias("_feature"))
    wide = known.schema["_ts"].dataType
    points = spine.select(*on, col(spine_ts).cast(wide).alias("_ts")).where(F.col("_ts").isNotNull()).distinct()
    merged = latest.withColumn("_side", F.lit(0)).unionByName(
        points.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    cut = range_slices(merged, [*keys, "_ts", "_side"])
    within = Window.partitionBy(*on, "_slice").orderBy("_ts", "_side")
    earlier = Window.partitionBy(*on).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy(*on, "_slice").agg(
        F.max(F.when(F.col("_feature").isNotNull(), F.struct("_ts", "_feature"))).alias("_end")
    )
    carried = ends.select(*on, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    found = (
        cut.withColumn("_here", F.last("_feature", ignorenulls=True).over(within))
        .join(carried.where(F.col("_carried").isNotNull()), [*keys, "_slice"], "left")
        .withColumn("_found", F.coalesce(F.col("_here"), F.col("_carried._feature")))
    )
    answers = found.where((F.col("_side") == 1) & F.col("_found").isNotNull()).select(
        *on, "_ts", "_found"
    )
    return spine.withColumn("_ts", col(spine_ts).cast(wide)).join(answers, [*keys, "_ts"], "left").select(
        *[col(c) for c in spine.columns], *[F.col("_found")[n].alias(n) for n in names]
    )
