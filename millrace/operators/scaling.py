"""Standard and min-max scaling with a fitted, invertible model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, numeric_columns, present
from millrace.operators.fitted import Fitted, pack

METHODS = ("standard", "minmax")


def fit_scaler(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "standard",
    by: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> Fitted:
    """Centre and spread per column in one pass: mean and population deviation, or minimum and
    range. A constant column has spread 1, so it scales to 0."""
    if method not in METHODS:
        raise ValueError(f"Unknown scaling method: {method}")
    names = list(columns or numeric_columns(df, (*exclude, *by)))
    measures = []
    for i, n in enumerate(names):
        x = present(df, n).cast("double")
        measures += [F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
        if method == "standard":
            measures += [F.avg(x).alias(f"_mean{i}"), F.stddev_pop(x).alias(f"_dev{i}")]
    measured = df.groupBy(*[col(b) for b in by]).agg(*measures)

    def params(i: int) -> dict[str, Column]:
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        constant = low == high
        if method == "standard":
            return {
                "centre": F.when(constant, low).otherwise(F.col(f"_mean{i}")),
                "spread": F.when(constant, 1.0).otherwise(F.col(f"_dev{i}")),
            }
        return {"centre": low, "spread": F.when(constant, 1.0).otherwise(high - low)}

    table = pack(measured, by, [params(i) for i in range(len(names))])
    if by:
        return Fitted(method, ("centre", "spread"), tuple(names), tuple(by), table=table)
    row = table.first()
    values = {n: row[f"_p{i}"].asDict() for i, n in enumerate(names)}
    return Fitted(method, ("centre", "spread"), tuple(names), values=values)


def scale(df: DataFrame, scaler: Fitted) -> DataFrame:
    return scaler.transform(
        df,
        lambda n, p: (present(df, n).cast("double") - p("centre").cast("double")) / p("spread").cast("double"),
    )


def unscale(df: DataFrame, scaler: Fitted) -> DataFrame:
    return scaler.transform(
        df,
        lambda n, p: present(df, n).cast("double") * p("spread").cast("double") + p("centre").cast("double"),
    )


def scale_features(df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard", **options) -> tuple[DataFrame, Fitted]:
    scaler = fit_scaler(df, columns, method, **options)
    return scale(df, scaler), scaler
