"""Expectations over a DataFrame, all evaluated in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, missing

CRITICAL_COLUMNS = ("id", "event_date", "value")


@dataclass(frozen=True)
class RowCount:
    minimum: int = 1
    maximum: int | None = None
    name: str = "expect_table_row_count_to_be_between"


@dataclass(frozen=True)
class ColumnOrder:
    """Columns must equal this ordered list; None accepts any."""

    columns: tuple[str, ...] | None = None
    name: str = "expect_table_columns_to_match_ordered_list"


@dataclass(frozen=True)
class NotNull:
    column: str
    name: str = "expect_column_values_to_not_be_null"


@dataclass(frozen=True)
class Cardinality:
    """Distinct values between bounds; `approximate` trades exactness for a fixed-size sketch."""

    column: str
    minimum: int = 1
    maximum: int | None = None
    approximate: bool = False
    name: str = "expect_column_unique_value_count_to_be_between"


Rule = RowCount | ColumnOrder | NotNull | Cardinality


def suite(not_null: Sequence[str] = (), columns: Sequence[str] | None = None) -> list[Rule]:
    """A positive row count, the column order, and completeness of critical columns."""
    ordered = tuple(columns) if columns is not None else None
    return [RowCount(), ColumnOrder(ordered), *[NotNull(c) for c in not_null]]


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_unique) for all columns in one shuffle, repeated values combined before it."""
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.column", "cell.value")
    values = cells.where(F.col("value").isNotNull()).distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def _between(value: Column, low: int, high: int | None) -> Column:
    inside = value >= low
    return inside if high is None else inside & (value <= high)


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, in rule order."""
    have = set(df.columns)
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    exact: list[str] = []
    for i, r in enumerate(rules):
        if isinstance(r, NotNull) and r.column in have:
            aggregates.append(F.count_if(missing(df, r.column)).alias(f"_r{i}"))
        elif isinstance(r, Cardinality) and r.column in have:
            if r.approximate:
                aggregates.append(F.approx_count_distinct(col(r.column)).alias(f"_r{i}"))
            else:
                exact.append(r.column)
    totals = df.agg(*aggregates)
    if exact:
        # At most one row per rule comes back, so the counts can be joined as literals.
        unique = {r["column"]: r["n_unique"] for r in distinct_counts(df, list(dict.fromkeys(exact))).collect()}

    nothing = F.lit(None).cast("long")
    rows = F.col("_rows")
    outcome = []
    for i, r in enumerate(rules):
        column = getattr(r, "column", None)
        element, unexpected = rows, F.lit(0).cast("long")
        if column is not None and column not in have:
            success, element, unexpected = F.lit(False), nothing, nothing
        elif isinstance(r, RowCount):
            success = _between(rows, r.minimum, r.maximum)
        elif isinstance(r, ColumnOrder):
            success = F.lit(r.columns is None or list(r.columns) == df.columns)
        elif isinstance(r, NotNull):
            unexpected = F.col(f"_r{i}")
            success = unexpected == 0
        else:
            n = F.col(f"_r{i}") if r.approximate else F.lit(unique.get(column, 0)).cast("long")
            element, success = n, _between(n, r.minimum, r.maximum)
        share = F.when(element > 0, unexpected / element * 100)
        outcome.append(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(r.name).alias("expectation_type"),
                F.lit(column).cast("string").alias("column"),
                success.alias("success"),
                element.alias("element_count"),
                unexpected.alias("unexpected_count"),
                share.alias("unexpected_percent"),
            )
        )
    return totals.select(F.inline(F.array(*outcome)))


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def validate(df: DataFrame, not_null: Sequence[str] = CRITICAL_COLUMNS, rules: Sequence[Rule] | None = None) -> dict:
    """Evaluate and return {"success", "results"}; any failed rule stops the run."""
    rules = list(rules) if rules is not None else suite(not_null)
    results = evaluate(df, rules)
    rows = results.collect()  # one row per rule
    failed = [r for r in rows if not r["success"]]
    if failed:
        raise ValueError(
            f"Data quality check failed with {len(failed)} violation(s). Aborting pipeline run."
        )
    return {"success": True, "results": [r.asDict() for r in rows]}
