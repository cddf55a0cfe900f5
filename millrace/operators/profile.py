"""Column profile of a table: counts, frequent values, moments, quartiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, numeric_columns, present, string_columns
from millrace.plans.quantiles import exact_quantiles

NUMBER_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")
TEXT_STATS = ("unique", "top", "freq")
SCHEMA = (
    "column string, count bigint, unique bigint, top string, freq bigint, mean double, "
    "std double, min double, p25 double, p50 double, p75 double, max double"
)


def describe_numbers(df: DataFrame) -> DataFrame:
    """Numeric columns: count, mean, sample deviation, minimum, quartiles, maximum."""
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], SCHEMA)
    measures = []
    for i, n in enumerate(names):
        x = present(df, n).cast("double")
        measures += [
            F.count(x).alias(f"_n{i}"),
            F.avg(x).alias(f"_mean{i}"),
            F.stddev_samp(x).alias(f"_std{i}"),
            F.min(x).alias(f"_min{i}"),
            F.max(x).alias(f"_max{i}"),
        ]
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75]).first()
    null = F.lit(None)

    def quartile(n: str, k: int):
        return F.lit(quartiles[n][k]).cast("double")

    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"_n{i}").alias("count"),
            null.cast("long").alias("unique"),
            null.cast("string").alias("top"),
            null.cast("long").alias("freq"),
            F.col(f"_mean{i}").alias("mean"),
            F.col(f"_std{i}").alias("std"),
            F.col(f"_min{i}").alias("min"),
            quartile(n, 0).alias("p25"),
            quartile(n, 1).alias("p50"),
            quartile(n, 2).alias("p75"),
            F.col(f"_max{i}").alias("max"),
        )
        for i, n in enumerate(names)
    ]
    return df.agg(*measures).select(F.inline(F.array(*cells)))


def describe_text(df: DataFrame) -> DataFrame:
    """String columns: count, distinct values, the most frequent value and its count (the lowest
    value on a tie)."""
    names = string_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], SCHEMA)
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("column"), col(n).alias("value")) for n in names])).alias("cell")
    ).select("cell.column", "cell.value")
    # The NULL rows keep a column without any value in the result.
    counts = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    real = F.col("value").isNotNull()
    folded = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("count"),
        F.count("value").alias("unique"),
        F.min(F.when(real, F.struct(-F.col("n"), F.col("value")))).alias("best"),
        F.max(F.when(real, F.col("n"))).alias("freq"),
    )
    return folded.select(
        "column",
        "count",
        "unique",
        F.col("best.value").alias("top"),
        "freq",
        *[F.lit(None).cast("double").alias(s) for s in NUMBER_STATS],
    )


def describe(df: DataFrame) -> DataFrame:
    """One row per numeric or string column; statistics that do not apply are NULL."""
    return describe_numbers(df).unionByName(describe_text(df))


def statistics(df: DataFrame) -> dict[str, dict]:
    """The profile as a document: column -> statistic -> value (one small row per column)."""
    order = {c: i for i, c in enumerate(df.columns)}
    rows = sorted((r.asDict() for r in describe(df).collect()), key=lambda r: order[r["column"]])
    return {r.pop("column"): r for r in rows}


def describe_long(df: DataFrame) -> DataFrame:
    """(column, stat, value) with the value as text."""
    stats = ("count", *TEXT_STATS, *NUMBER_STATS)
    cells = F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("string").alias("value")) for s in stats])
    return describe(df).select("column", F.inline(cells)).where(F.col("value").isNotNull())
