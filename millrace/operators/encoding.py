"""Label encoding through a dictionary table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col, string_columns
from millrace.plans.scratch import materialize
from millrace.plans.slices import dense_position
from millrace.sources.files import read_document, write_document

NULL_CLASS = "nan"
RANK_LIMIT = 1_000_000
LAST_INT = (1 << 31) - 1
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class LabelEncoder:
    """`entries` is (column, value, code); `sizes` and `text_bytes` tell how many classes each
    column has and how long their texts are together."""

    columns: tuple[str, ...]
    entries: DataFrame
    sizes: Mapping[str, int]
    text_bytes: Mapping[str, int]
    null_class: str = NULL_CLASS

    def classes(self, column: str) -> DataFrame:
        """(value, code) of one column, marked for broadcast only while it is small."""
        found = self.entries.where(F.col("column") == column).select("value", "code")
        small = (
            self.sizes.get(column, 0) <= BROADCAST_ROWS and self.text_bytes.get(column, 0) <= BROADCAST_BYTES
        )
        return F.broadcast(found) if small else found

    def save(self, spark: SparkSession, path: str) -> None:
        """Keep the dictionary in a new folder; `entries` itself may lie in a scratch folder that expires."""
        self.entries.write.parquet(f"{path}/entries")
        document = {"columns": self.columns, "sizes": dict(self.sizes), "text_bytes": dict(self.text_bytes)}
        write_document(spark, f"{path}/model", {**document, "null_class": self.null_class})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LabelEncoder":
        found = read_document(spark, f"{path}/model")
        entries = spark.read.parquet(f"{path}/entries")
        return LabelEncoder(tuple(found["columns"]), entries, found["sizes"], found["text_bytes"], found["null_class"])


def _text(name: str, null_class: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(null_class))


def fit_encoder(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_class: str = NULL_CLASS,
    rank_limit: int = RANK_LIMIT,
    exclude: Sequence[str] = (),
) -> LabelEncoder:
    """Codes 0..n-1 in ascending order of the value; NULL is the class `null_class`."""
    names = list(columns or string_columns(df, exclude))
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("column"), _text(n, null_class).alias("value")) for n in names])
        ).alias("cell")
    ).select("cell.column", "cell.value")
    return encoder_of(materialize(cells.distinct(), "classes"), names, null_class, rank_limit)


def encoder_of(values: DataFrame, names: Sequence[str], null_class: str = NULL_CLASS, rank_limit: int = RANK_LIMIT) -> LabelEncoder:
    """Codes for stored distinct (column, value) rows; bigint where a column has more classes than an int can name."""
    measured = values.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("bytes")
    ).collect()
    sizes = {r["column"]: r["n"] for r in measured}
    if max(sizes.values(), default=0) <= rank_limit:
        order = Window.partitionBy("column").orderBy("value")
        entries = values.withColumn("code", F.row_number().over(order) - 1)
    else:
        entries = dense_position(values, ["value"], "code", by=["column"])
    kind = "int" if max(sizes.values(), default=0) <= LAST_INT else "bigint"
    entries = entries.select("column", "value", F.col("code").cast(kind).alias("code"))
    return LabelEncoder(tuple(names), entries, sizes, {r["column"]: r["bytes"] for r in measured}, null_class)


def encode(df: DataFrame, encoder: LabelEncoder, columns: Sequence[str] | None = None, unseen: str = "error") -> DataFrame:
    """Replace values by their codes; a value the fit has not seen fails, or becomes -1."""
    if unseen not in ("error", "ignore"):
        raise ValueError(f"Unknown handling of unseen values: {unseen}")
    out = df
    for name in columns or encoder.columns:
        known = encoder.classes(name).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        text = _text(name, encoder.null_class)
        if unseen == "error":
            missing = F.raise_error(F.concat(F.lit(f"Unseen value in column {name}: "), text)).cast("int")
        else:
            missing = F.lit(-1)
        code = F.when(F.col("_code").isNull(), missing).otherwise(F.col("_code"))
        joined = out.join(known, text == F.col("_value"), "left")
        out = joined.select(*[code.alias(c) if c == name else col(c) for c in out.columns])
    return out


def decode_labels(df: DataFrame, encoder: LabelEncoder, columns: Sequence[str] | None = None) -> DataFrame:
    """Codes back to values; an unknown code becomes NULL."""
    out = df
    for name in columns or encoder.columns:
        known = encoder.classes(name).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = out.join(known, col(name) == F.col("_code"), "left")
        out = joined.select(*[F.col("_value").alias(c) if c == name else col(c) for c in out.columns])
    return out


def encode_labels(df: DataFrame, columns: Sequence[str] | None = None, **options) -> tuple[DataFrame, LabelEncoder]:
    encoder = fit_encoder(df, columns, **options)
    return encode(df, encoder), encoder
