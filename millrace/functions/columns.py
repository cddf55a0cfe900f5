"""Column selection and scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Top-level column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def feature_columns(df: DataFrame, target: str, features: Sequence[str] | None = None) -> list[str]:
    """Every column but the target; a model can only take numeric ones."""
    names = list(features) if features is not None else [c for c in df.columns if c != target]
    numeric = set(numeric_columns(df))
    wrong = [n for n in names if n not in numeric]
    if wrong:
        raise ValueError(f"Feature columns must be numeric: {wrong}")
    return names


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is NULL or, for floating point columns, NaN."""
    c = col(name)
    return (c.isNull() | F.isnan(c)) if is_float(df, name) else c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The value with NaN turned into NULL."""
    c = col(name)
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) if is_float(df, name) else c


def clip(value: Column, lower: Column, upper: Column) -> Column:
    """Clip between two fences; a NULL value or a NULL fence leaves it as it is."""
    return (
        F.when(value.isNull(), value)
        .when(value < lower, lower)
        .when(value > upper, upper)
        .otherwise(value)
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with microseconds and offset (the session zone should be UTC)."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def decode(code: Column, names: Mapping[int, str]) -> Column:
    """Text for an integer code, or the code itself when it has no name."""
    lookup = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    return F.coalesce(lookup[code.cast("int")], code.cast("string"))


def with_columns(df: DataFrame, replaced: Mapping[str, Column]) -> DataFrame:
    """Replace or append columns in one projection, keeping the column order."""
    kept = [replaced[n].alias(n) if n in replaced else col(n) for n in df.columns]
    added = [e.alias(n) for n, e in replaced.items() if n not in df.columns]
    return df.select(*kept, *added)
