"""Classification metrics computed from counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(col(label).alias("label"), col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _class_name(df: DataFrame, column: str) -> Column:
    """A class as text, the same for 1 and 1.0."""
    value = col(column)
    whole = value.cast("long")
    if isinstance(df.schema[column].dataType, T.FractionalType):
        return F.when(value == whole, whole.cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def classification_report(
    df: DataFrame, label: str, prediction: str, names: Mapping[int, str] | None = None
) -> DataFrame:
    """(class, precision, recall, f1_score, support): one row per class, then accuracy (in
    f1_score), macro avg and weighted avg. A ratio with nothing below the line is 0."""
    named = df.select(*[_class_name(df, c).alias(n) for c, n in ((label, "label"), (prediction, "prediction"))])
    cells = confusion_counts(named, "label", "prediction")
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("prediction").cast("string").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    precision, recall = _ratio(F.col("hit"), F.col("predicted")), _ratio(F.col("hit"), F.col("support"))
    f1 = _ratio(F.lit(2.0) * F.col("hit"), F.col("predicted") + F.col("support"))
    per_class = sums.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1_score"), "support", "hit"
    )
    if names:
        known = F.create_map(*[F.lit(x) for k, v in sorted(names.items()) for x in (str(k), v)])
        per_class = per_class.withColumn("class", F.coalesce(known[F.col("class")], F.col("class")))
    total = F.sum("support")

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("support")) / total

    none = F.lit(None).cast("double")
    summary = per_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), none.alias("precision"), none.alias("recall"),
                     (F.sum("hit") / total).alias("f1_score"), total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                     F.avg("f1_score").alias("f1_score"), total.alias("support")),
            F.struct(F.lit("weighted avg").alias("class"), weighted("precision").alias("precision"), weighted("recall").alias("recall"),
                     weighted("f1_score").alias("f1_score"), total.alias("support")),
        ).alias("rows")
    ).select(F.inline("rows"))
    return per_class.drop("hit").unionByName(summary)


def _auc(scored: DataFrame) -> DataFrame:
    """(class, n_pos, n_neg, auc) from rows (class, score, pos).

    Rows shrink to one per distinct score, are cut into range slices, ranked inside each slice,
    and the slices are put together from their totals; no task sees all scores.
    """
    steps = scored.where("score IS NOT NULL").groupBy("class", "score").agg(
        F.count_if(F.col("pos")).alias("p"), F.count_if(~F.col("pos")).alias("n")
    )
    cut = steps.repartitionByRange("class", "score").withColumn("_slice", F.spark_partition_id())
    below = Window.partitionBy("class", "_slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cut.withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
    slices = ranked.groupBy("class", "_slice").agg(
        F.sum("p").alias("p"),
        F.sum("n").alias("n"),
        F.sum(F.col("p").cast("double") * (F.col("below") + F.col("n") / 2.0)).alias("wins"),
    )
    before = Window.partitionBy("class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    joined = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return joined.groupBy("class").agg(
        F.sum("p").alias("n_pos"),
        F.sum("n").alias("n_neg"),
        (
            F.sum(F.col("wins") + F.col("p").cast("double") * F.col("before"))
            / F.nullif(F.sum("p").cast("double") * F.sum("n"), F.lit(0.0))
        ).alias("auc"),
    )


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """(n_pos, n_neg, auc): exact rank form, half a win per tie; NULL if a side is empty.

    Rows without a score are left out; n_pos and n_neg count the others."""
    scored = df.select(
        F.lit(0).alias("class"),
        col(score).cast("double").alias("score"),
        F.coalesce(col(label) == F.lit(positive), F.lit(False)).alias("pos"),
    )
    return _auc(scored).select("n_pos", "n_neg", "auc")


def roc_auc_by_class(df: DataFrame, label: str, scores: Mapping[int, str]) -> DataFrame:
    """One-versus-rest area per class from one score column per class."""
    cells = [
        F.struct(
            F.lit(c).alias("class"),
            col(s).cast("double").alias("score"),
            F.coalesce(col(label) == F.lit(c), F.lit(False)).alias("pos"),
        )
        for c, s in scores.items()
    ]
    return _auc(df.select(F.inline(F.array(*cells))))


def roc_auc_macro(df: DataFrame, label: str, scores: Mapping[int, str]) -> DataFrame:
    """Mean of the one-versus-rest areas; NULL when some class has no area."""
    per_class = roc_auc_by_class(df, label, scores)
    whole = F.count("auc") == len(scores)
    return per_class.agg(F.when(whole, F.avg("auc")).alias("roc_auc_ovr"))
