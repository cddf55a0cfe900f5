"""Missing-value imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, missing, numeric_columns, present, string_columns
from millrace.operators.fitted import Fitted, pack
from millrace.plans.quantiles import approx_quantiles, exact_quantiles
from millrace.sources.files import read_document, write_document

UNKNOWN = "UNKNOWN"
NUMERIC = ("median", "mean")
CATEGORICAL = ("mode", "constant")


@dataclass(frozen=True)
class Imputer:
    numeric: Fitted
    categorical: Fitted
    n_missing: dict[str, int]

    def save(self, spark: SparkSession, path: str) -> None:
        self.numeric.save(spark, f"{path}/numeric")
        self.categorical.save(spark, f"{path}/categorical")
        write_document(spark, f"{path}/missing", self.n_missing)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Imputer":
        parts = (Fitted.load(spark, f"{path}/{p}") for p in ("numeric", "categorical"))
        return Imputer(*parts, read_document(spark, f"{path}/missing"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_missing) for all columns in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(df, c)).alias(f"_m{i}") for i, c in enumerate(names)],
    )
    cells = [
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"), F.col(f"_m{i}").alias("n_missing"))
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*cells)))


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """by..., column, value: the most frequent value, the lowest one on a tie.

    Counting is a keyed aggregation over (column, value), so no task holds all values.
    """
    keys = [col(b) for b in by]
    cells = df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
        ).alias("cell"),
    ).select(*keys, "cell.column", "cell.value")
    counts = (
        cells.where(F.col("value").isNotNull())
        .groupBy(*keys, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy(*keys, "column").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
    return best.select(*keys, "column", F.col("best.value").alias("value"))


def _centre(df, columns, strategy, by, accuracy):
    if strategy == "mean":
        return df.groupBy(*[col(b) for b in by]).agg(*[F.avg(present(df, c)).alias(c) for c in columns])
    quantiles = (
        exact_quantiles(df, columns, [0.5], by)
        if accuracy is None
        else approx_quantiles(df, columns, [0.5], by, accuracy)
    )
    return quantiles.select(*[col(b) for b in by], *[F.get(col(c), 0).alias(c) for c in columns])


def fit_imputer(
    df: DataFrame,
    numeric_strategy: str = "median",
    categorical_strategy: str = "mode",
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    by: Sequence[str] = (),
    exclude: Sequence[str] = (),
    accuracy: int | None = None,
    for_new_rows: bool = False,
) -> Imputer:
    """Find fill values for the columns that miss some; `accuracy` selects the median sketch.

    With `for_new_rows` every column gets one, so that holes which only later rows have are filled too;
    whole-number columns with a fractional fill then turn to double even where they are complete.
    """
    if numeric_strategy not in NUMERIC:
        raise ValueError(f"Unknown numeric strategy: {numeric_strategy}")
    if categorical_strategy not in CATEGORICAL:
        raise ValueError(f"Unknown categorical strategy: {categorical_strategy}")
    skip = (*exclude, *by)
    numbers = list(numeric or numeric_columns(df, skip))
    texts = list(categorical or string_columns(df, skip))
    counted = null_counts(df, [*numbers, *texts]).collect() if numbers or texts else []
    n_missing = {r["column"]: r["n_missing"] for r in counted if r["n_missing"]}
    if not for_new_rows:
        numbers = [c for c in numbers if c in n_missing]
        texts = [c for c in texts if c in n_missing]
    keys = tuple(by)

    number_model = Fitted("impute", ("fill",), tuple(numbers), keys)
    if numbers:
        centre = _centre(df, numbers, numeric_strategy, by, accuracy)
        if by:
            table = pack(centre, by, [{"fill": col(c)} for c in numbers])
            number_model = Fitted("impute", ("fill",), tuple(numbers), keys, table=table)
        else:
            row = centre.first()
            number_model = Fitted("impute", ("fill",), tuple(numbers), values={c: {"fill": row[c]} for c in numbers})

    text_model = Fitted("impute", ("fill",), tuple(texts), values={c: {"fill": UNKNOWN} for c in texts})
    if texts and categorical_strategy == "mode":
        found = modes(df, texts, by)
        if by:
            wide = found.groupBy(*[col(b) for b in by]).pivot("column", texts).agg(F.first("value"))
            table = pack(wide, by, [{"fill": F.coalesce(col(c), F.lit(UNKNOWN))} for c in texts])
            text_model = Fitted("impute", ("fill",), tuple(texts), keys, table=table)
        else:
            best = {r["column"]: r["value"] for r in found.collect()}
            text_model = Fitted("impute", ("fill",), tuple(texts), values={c: {"fill": best.get(c, UNKNOWN)} for c in texts})
    return Imputer(number_model, text_model, n_missing)


def impute(df: DataFrame, model: Imputer) -> DataFrame:
    """Fill missing values. A whole-number column turns to double only if its fill value needs it;
    a column without any value stays empty."""

    def number(name, param):
        kind = df.schema[name].dataType
        if model.numeric.table is None:
            fill = model.numeric.values[name]["fill"]
            whole = isinstance(kind, T.IntegralType) and (fill is None or float(fill).is_integer())
            kind = kind if whole or isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else T.DoubleType()
        else:
            kind = T.DoubleType()
        return F.coalesce(present(df, name).cast(kind), param("fill").cast(kind))

    filled = model.numeric.transform(df, number)
    # A group that the fit did not see still gets the constant.
    return model.categorical.transform(
        filled, lambda name, param: F.coalesce(col(name), param("fill"), F.lit(UNKNOWN))
    )


def impute_missing(df: DataFrame, **options) -> DataFrame:
    return impute(df, fit_imputer(df, **options))


def require_complete(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a critical column still misses values; absent columns are ignored."""
    names = [c for c in columns if c in df.columns]
    if not names:
        return
    failing = {r["column"]: r["n_missing"] for r in null_counts(df, names).collect() if r["n_missing"]}
    if failing:
        raise ValueError(f"Null values remain in critical columns after preprocessing: {failing}")
