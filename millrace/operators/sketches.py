"""Mergeable column profiles: fixed-size sketches per column, stored with each part of a table and added up without a rescan.

Error bounds, at three standard errors or 99 %: distinct values within `DISTINCT_ERROR` of the true number, a quantile's rank
within `RANK_ERROR` of the one asked for, a frequent value's count within rows / `TOP_ITEMS`. Counts of rows and of
missing values, minimum, maximum and mean are exact (the mean up to rounding).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, missing, numeric_columns, present, string_columns
from millrace.operators.quality import Cardinality, NotNull, RowCount, Rule

DISTINCT_BITS = 14
DISTINCT_ERROR = 0.025
RANK_SIZE = 800
RANK_ERROR = 0.01
TOP_ITEMS = 1000
QUARTILES = (0.25, 0.5, 0.75)
_FREQUENT = "struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"
SKETCH_SCHEMA = (
    "column string, n_rows bigint, n_missing bigint, distinct binary, ranks binary, minimum double, maximum double, total double, "
    f"top {_FREQUENT}"
)


def sketch(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric or string column, in one aggregation whose state does not depend on the rows.

    NULL and NaN are missing. Frequent values are kept for strings, ranks and moments for numbers. An empty table gives empty
    sketches, a table without such columns no rows.
    """
    numbers, strings = set(numeric_columns(df)), set(string_columns(df))
    names = [c for c in (columns or df.columns) if c in numbers or c in strings]
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, n in enumerate(names):
        value = present(df, n)
        measures += [
            F.count_if(missing(df, n)).alias(f"_missing{i}"),
            F.hll_sketch_agg(value.cast("string"), DISTINCT_BITS).alias(f"_distinct{i}"),
        ]
        if n in numbers:
            x = value.cast("double")
            measures += [F.kll_sketch_agg_double(x, RANK_SIZE).alias(f"_ranks{i}"), F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"), F.sum(x).alias(f"_sum{i}")]
        else:
            measures.append(F.call_function("approx_top_k_accumulate", value, F.lit(TOP_ITEMS)).alias(f"_top{i}"))

    def cell(i: int, n: str) -> Column:
        number = n in numbers

        def kept(name: str, kind: str, here: bool) -> Column:
            return (F.col(f"_{name}{i}") if here else F.lit(None)).cast(kind).alias({"min": "minimum", "max": "maximum", "sum": "total"}.get(name, name))

        return F.struct(
            F.lit(n).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_missing{i}").alias("n_missing"),
            kept("distinct", "binary", True), kept("ranks", "binary", number), kept("min", "double", number),
            kept("max", "double", number), kept("sum", "double", number), kept("top", _FREQUENT, not number),
        )

    if not names:
        return df.sparkSession.createDataFrame([], SKETCH_SCHEMA)
    return df.agg(*measures).select(F.inline(F.array(*[cell(i, n) for i, n in enumerate(names)])))


def merge_sketches(parts: Sequence[DataFrame]) -> DataFrame:
    """One row per column over all parts. A column that a part lacks counts from the parts that have it."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("kll_merge_agg_double", F.col("ranks")).alias("ranks"),
        F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"), F.sum("total").alias("total"),
        F.sum(F.when(F.col("ranks").isNotNull(), F.col("n_rows") - F.col("n_missing"))).alias("n_numbers"),
    )


def _frequent(every: DataFrame, limit: int) -> DataFrame:
    """(column, frequent): the values with the greatest counts, for columns of strings."""
    return every.where("top IS NOT NULL").groupBy("column").agg(
        F.call_function("approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col("top"), F.lit(TOP_ITEMS)), F.lit(limit)).alias("frequent")
    )


def merged_profile(parts: Sequence[DataFrame], top: int = 5) -> DataFrame:
    """(column, n_rows, n_missing, n_distinct, minimum, p25, p50, p75, maximum, mean, frequent) from sketches of parts.

    What does not apply to a column is NULL. If a column is a number in one part and a string in another, both kinds of
    statistics are those of the parts that have them.
    """
    if not parts:
        raise ValueError("No sketches given")
    merged = merge_sketches(parts)
    some = F.col("minimum").isNotNull()
    asked = F.array(*[F.lit(float(q)) for q in QUARTILES])
    quartiles = F.when(some, F.call_function("kll_sketch_get_quantile_double", F.col("ranks"), asked))
    found = merged.withColumn("_q", quartiles).select(
        "column", "n_rows", "n_missing", F.hll_sketch_estimate("distinct").alias("n_distinct"), "minimum",
        *[F.get("_q", i).alias(f"p{round(100 * q)}") for i, q in enumerate(QUARTILES)], "maximum",
        F.when(some, F.col("total") / F.col("n_numbers")).alias("mean"),
    )
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return found.join(_frequent(every, top), "column", "left")


def evaluate_profile(profile: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, column, success, observed) of row count, completeness and cardinality rules, read off a merged profile.

    A cardinality rule fails only where the true number is outside the bounds for sure, at `DISTINCT_ERROR`; a column that the
    profile lacks fails. Column order is not in a profile.
    """
    rows = {r["column"]: r for r in profile.select("column", "n_rows", "n_missing", "n_distinct").collect()}
    out = []
    for rule in rules:
        if isinstance(rule, RowCount):
            n = max((r["n_rows"] for r in rows.values()), default=0)
            out.append((rule.name, None, n >= rule.minimum and (rule.maximum is None or n <= rule.maximum), n))
            continue
        if not isinstance(rule, (NotNull, Cardinality)):
            raise ValueError(f"A profile cannot tell {rule.name}")
        row = rows.get(rule.column)
        if row is None:
            out.append((rule.name, rule.column, False, None))
        elif isinstance(rule, NotNull):
            out.append((rule.name, rule.column, row["n_missing"] == 0, row["n_missing"]))
        else:
            low, high = row["n_distinct"] * (1 - DISTINCT_ERROR), row["n_distinct"] * (1 + DISTINCT_ERROR)
            out.append((rule.name, rule.column, high >= rule.minimum and (rule.maximum is None or low <= rule.maximum), row["n_distinct"]))
    return profile.sparkSession.createDataFrame(out, "rule string, column string, success boolean, observed bigint")
