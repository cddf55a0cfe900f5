"""Global order over any number of rows: range slices plus per-slice totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.plans.scratch import materialize


def range_slices(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with a `_slice` number that never falls as `order` rises.

    Written out once: the slice borders come from a sample, so a second evaluation could cut
    the rows elsewhere.
    """
    cut = df.repartitionByRange(*[col(c) for c in order]).withColumn("_slice", F.spark_partition_id())
    return materialize(cut, "slices")


def dense_position(df: DataFrame, order: Sequence[str], name: str, by: Sequence[str] = ()) -> DataFrame:
    """0-based position of each row in its `by` group, for rows that `order` tells apart."""
    cut = range_slices(df, [*by, *order])
    keys = [col(b) for b in by]
    sizes = cut.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*[col(c) for c in order])
    numbered = cut.withColumn("_row", F.row_number().over(within))
    return (
        numbered.join(starts, [*by, "_slice"])
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_start", "_row", "_slice")
    )
