"""Health preprocessing: impute, cap, scale, encode, then a gate on critical columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import clip, numeric_columns, present, string_columns
from millrace.operators import encoding, impute, outliers, scaling
from millrace.operators.encoding import LabelEncoder
from millrace.operators.fitted import Fitted
from millrace.operators.impute import Imputer
from millrace.plans.fused import FusedFit, fit_together
from millrace.sources.files import read_document, write_document

AUDIT_SCHEMA = "step string, column string, n_changed bigint, parameter string"


@dataclass(frozen=True)
class HealthModel:
    """The fitted steps, to keep and to use on later rows."""

    imputer: Imputer
    outlier_fences: Fitted
    scaler: Fitted
    encoder: LabelEncoder | None

    def apply(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        """The fitted steps on new data."""
        out = scaling.scale(outliers.cap(impute.impute(df, self.imputer), self.outlier_fences), self.scaler)
        return out if self.encoder is None else encoding.encode(out, self.encoder, unseen=unseen)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write to a new folder on any Hadoop file system. The document that `load` reads first is written last."""
        self.imputer.save(spark, f"{path}/imputer")
        self.outlier_fences.save(spark, f"{path}/fences")
        self.scaler.save(spark, f"{path}/scaler")
        if self.encoder is not None:
            self.encoder.save(spark, f"{path}/encoder")
        write_document(spark, f"{path}/steps", {"encoder": self.encoder is not None})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "HealthModel":
        steps = read_document(spark, f"{path}/steps")
        encoder = LabelEncoder.load(spark, f"{path}/encoder") if steps["encoder"] else None
        return HealthModel(Imputer.load(spark, f"{path}/imputer"), Fitted.load(spark, f"{path}/fences"), Fitted.load(spark, f"{path}/scaler"), encoder)


@dataclass(frozen=True)
class Preprocessed(HealthModel):
    dataframe: DataFrame
    capped: DataFrame

    def audit(self) -> DataFrame:
        """What each step changed: (step, column, n_changed, parameter).

        Capping and scaling are counted in one pass; encoding replaces every value by its code, so it changes every row.
        """
        spark = self.dataframe.sparkSession
        fills = {**self.imputer.numeric.values, **self.imputer.categorical.values}
        rows = [("impute", c, n, str(fills[c]["fill"])) for c, n in self.imputer.n_missing.items() if c in fills]
        fences = self.outlier_fences.values
        changed = self._changed()
        rows += [("cap", c, changed["cap", c], f"[{p['lower']}, {p['upper']}]") for c, p in fences.items()]
        rows += [(self.scaler.kind, c, changed["scale", c], f"centre {p['centre']}, spread {p['spread']}") for c, p in self.scaler.values.items()]
        if self.encoder is not None:
            rows += [("encode", c, changed["rows", ""], f"{n} classes") for c, n in self.encoder.sizes.items()]
        return spark.createDataFrame(rows, AUDIT_SCHEMA)

    def _changed(self) -> dict[tuple[str, str], int]:
        """Values outside their fences, capped values that scaling alters, and all rows."""
        fences, scales = self.outlier_fences.values, self.scaler.values

        def value(c: str) -> Column:
            return present(self.capped, c).cast("double")

        def ends(c: str) -> list[Column]:
            return [F.lit(fences[c][p]).cast("double") for p in ("lower", "upper")]

        def scaled(c: str) -> Column:
            before = clip(value(c), *ends(c)) if c in fences else value(c)
            return (before - F.lit(scales[c]["centre"]).cast("double")) / F.lit(scales[c]["spread"]).cast("double") != before

        tests = {("cap", c): outliers.outside(value(c), *ends(c)) for c in fences} | {("scale", c): scaled(c) for c in scales}
        counts = [F.count_if(test).alias(f"_n{i}") for i, test in enumerate(tests.values())]
        return dict(zip([("rows", ""), *tests], self.capped.agg(F.count(F.lit(1)).alias("_n"), *counts).first()))


def preprocess(
    df: DataFrame,
    not_null: Sequence[str] | None = None,
    outlier_columns: Sequence[str] | None = None,
    scale_columns: Sequence[str] | None = None,
    encode_columns: Sequence[str] | None = None,
    method: str = "standard",
    exclude: Sequence[str] = (),
    accuracy: int | None = None,
    for_new_rows: bool = True,
) -> Preprocessed:
    """Every fit is a small aggregation, every transform a projection, so the four steps run as
    one scan when the result is used. Exact fits share their reads of the source (`plans.fused`). Columns that are not named are found by type; `exclude`
    keeps ids and targets out of all of them. Every column gets a fill value, so that the result also fills holes which only
    the rows of a later `apply` have; without `for_new_rows` only columns that miss values here get one. A whole-number column
    that is complete, and neither capped nor scaled, then turns to double where its median is fractional."""
    numbers, strings = numeric_columns(df, exclude), string_columns(df, exclude)
    fenced, texts = list(outlier_columns or numbers), list(encode_columns or strings)
    plain = set(fenced) <= set(numeric_columns(df)) and set(texts) <= set(string_columns(df))
    together = None
    if accuracy is None and plain:
        gated = [c for c in not_null or () if c in df.columns]
        together = fit_together(df, numbers, strings, fenced, texts, gated, for_new_rows=for_new_rows)
        imputer, fences = together.imputer, together.fences
        filled = impute.impute(df, imputer)
    else:
        imputer = impute.fit_imputer(df, exclude=exclude, accuracy=accuracy, for_new_rows=for_new_rows)
        filled = impute.impute(df, imputer)
        fences = outliers.fit_fences(filled, outlier_columns or numeric_columns(filled, exclude), accuracy=accuracy)
    capped = outliers.cap(filled, fences)
    scaler = scaling.fit_scaler(capped, scale_columns or numeric_columns(capped, exclude), method)
    scaled = scaling.scale(capped, scaler)
    if together is not None:
        encoder = together.encoder
    else:
        texts = list(encode_columns or string_columns(scaled, exclude))
        encoder = encoding.fit_encoder(scaled, texts) if texts else None
    out = encoding.encode(scaled, encoder) if encoder else scaled
    if not_null:
        _gate(out, not_null, together, scaler, texts)
    return Preprocessed(imputer, fences, scaler, encoder, out, filled)


def _gate(out: DataFrame, not_null: Sequence[str], together: FusedFit | None, scaler: Fitted, encoded: Sequence[str]) -> None:
    """Raise when a critical column still misses values, told from the counts of the fit. Only scaling by what is not
    finite can lose further values; then they are counted in the result."""
    finite = all(v is None or math.isfinite(v) for p in scaler.values.values() for v in p.values())
    if together is None or not finite:
        impute.require_complete(out, not_null)
        return
    fills = {**together.imputer.numeric.values, **together.imputer.categorical.values}
    whole = set(encoded) | {c for c, p in fills.items() if p["fill"] is not None}
    failing = {c: together.n_missing[c] for c in not_null if c in out.columns and c not in whole and together.n_missing[c]}
    if failing:
        raise ValueError(f"Null values remain in critical columns after preprocessing: {failing}")
