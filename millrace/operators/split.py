"""Stratified train/test split with an exact share per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.plans.quantiles import GATHER_LIMIT, Rank, order_statistics
from millrace.plans.scratch import materialize


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    gather_limit: int = GATHER_LIMIT,
) -> DataFrame:
    """Add `split` = "train" or "test": in each class the `round(test_size * n)` rows with the
    lowest hash of (seed, key) are the test rows.

    The class's cut-off hash is found as an order statistic, so no class is ever sorted or moved.
    Rows with equal keys stay on one side.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    if len(parts) > 1:  # lengths first, so that different keys never join to one text
        parts = [F.concat(F.when(col(k).isNull(), "-").otherwise(F.length(p).cast("string")), F.lit(":"), p) for k, p in zip(key, parts)]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    # 52 bits: as many as a double holds exactly.
    drawn = df.withColumn("_draw", F.conv(F.substring(digest, 1, 13), 16, 10).cast("double"))

    def n_test(n):
        return F.round(F.lit(test_size) * n).cast("long")

    found = order_statistics(drawn, [Rank("_draw", test_size, n_test, n_test)], [label], gather_limit=gather_limit)
    cuts = materialize(found.select(col(label).alias("_class"), F.col("first_0").alias("_cut")), "cuts")
    marked = drawn.join(cuts, col(label).eqNullSafe(F.col("_class")), "left")
    chosen = F.coalesce(F.col("_draw") <= F.col("_cut"), F.lit(False))
    return marked.select(
        *[col(c) for c in df.columns], F.when(chosen, "test").otherwise("train").alias("split")
    )
