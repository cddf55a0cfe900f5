"""Outlier capping at interquartile fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import clip, col, numeric_columns, present
from millrace.operators.fitted import Fitted, pack
from millrace.plans.quantiles import approx_quantiles, exact_quantiles


def fit_fences(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    multiplier: float = 1.5,
    by: Sequence[str] = (),
    exclude: Sequence[str] = (),
    accuracy: int | None = None,
) -> Fitted:
    """Fences q1 - k*iqr and q3 + k*iqr per column; `accuracy` selects the quantile sketch."""
    names = list(columns or numeric_columns(df, (*exclude, *by)))
    shares = [0.25, 0.75]
    if accuracy is None:
        quartiles = exact_quantiles(df, names, shares, by)
    else:
        quartiles = approx_quantiles(df, names, shares, by, accuracy)

    def fences(name: str) -> dict[str, Column]:
        q1, q3 = F.get(col(name), 0), F.get(col(name), 1)
        return {"lower": q1 - multiplier * (q3 - q1), "upper": q3 + multiplier * (q3 - q1)}

    table = pack(quartiles, by, [fences(n) for n in names])
    if by:
        return Fitted("fences", ("lower", "upper"), tuple(names), tuple(by), table=table)
    row = table.first()
    values = {n: {"lower": row[f"_p{i}"]["lower"], "upper": row[f"_p{i}"]["upper"]} for i, n in enumerate(names)}
    return Fitted("fences", ("lower", "upper"), tuple(names), values=values)


def outside(value: Column, lower: Column, upper: Column) -> Column:
    return (value < lower) | (value > upper)


def cap(df: DataFrame, fences: Fitted) -> DataFrame:
    """Clip every fitted column to its fences, as double; NULL and NaN become NULL."""
    return fences.transform(
        df,
        lambda name, p: clip(
            present(df, name).cast("double"), p("lower").cast("double"), p("upper").cast("double")
        ),
    )


def outlier_counts(df: DataFrame, fences: Fitted) -> DataFrame:
    """by..., column, n_values, n_capped."""
    flagged = fences.transform(
        df,
        lambda name, p: outside(
            present(df, name).cast("double"), p("lower").cast("double"), p("upper").cast("double")
        ),
    )
    keys = [col(b) for b in fences.by]
    counted = flagged.groupBy(*keys).agg(
        *[
            F.struct(F.count(col(n)).alias("n_values"), F.count_if(col(n)).alias("n_capped")).alias(f"_c{i}")
            for i, n in enumerate(fences.columns)
        ]
    )
    cells = [
        F.struct(
            F.lit(n).alias("column"),
            F.col(f"_c{i}.n_values").alias("n_values"),
            F.col(f"_c{i}.n_capped").alias("n_capped"),
        )
        for i, n in enumerate(fences.columns)
    ]
    return counted.select(*keys, F.inline(F.array(*cells)))


def cap_outliers(df: DataFrame, columns: Sequence[str] | None = None, multiplier: float = 1.5, **options) -> tuple[DataFrame, Fitted]:
    fences = fit_fences(df, columns, multiplier, **options)
    return cap(df, fences), fences
