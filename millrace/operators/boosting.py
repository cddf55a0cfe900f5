"""Gradient-boosted risk classification: a binary booster for two classes, one softmax model for more."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, decode, feature_columns
from millrace.operators.attributions import Leaf, read_leaves
from millrace.operators.metrics import classification_report, roc_auc, roc_auc_macro
from millrace.operators.softmax import SoftmaxModel, fit_softmax, with_margins
from millrace.operators.split import stratified_split
from millrace.plans.scratch import materialize

# Names of the risk levels.
RISK_LABELS = {0: "Low", 1: "Medium", 2: "High"}
CLASS_LIMIT = 100


@dataclass(frozen=True)
class RiskModel:
    """Two classes have one model, of the second class, in `boosters`; more have `softmax`."""

    boosters: dict[int, object]
    classes: tuple[int, ...]
    features: tuple[str, ...]
    softmax: SoftmaxModel | None = None

    def leaves(self, spark) -> dict[int, list[Leaf]]:
        if self.softmax:
            return {c: self.softmax.leaves(k) for k, c in enumerate(self.classes)}
        return {c: read_leaves(spark, m) for c, m in self.boosters.items()}


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def fit_risk_model(
    train: DataFrame,
    target: str,
    features: Sequence[str],
    trees: int = 200,
    depth: int = 4,
    rate: float = 0.05,
    subsample: float = 0.8,
    seed: int = 42,
    class_limit: int = CLASS_LIMIT,
) -> RiskModel:
    """A binary booster for two classes, one softmax model for more. Rows without a target are left out.

    More than `class_limit` classes are refused: each round grows a tree for every class.
    """
    train = train.where(col(target).isNotNull())
    found = train.select(col(target).cast("int").alias("c")).distinct().limit(class_limit + 1).collect()
    classes = tuple(sorted(r["c"] for r in found if r["c"] is not None))
    if not 2 <= len(classes) <= class_limit:
        raise ValueError(f"The target needs between 2 and {class_limit} classes, found {len(found)}")
    if len(classes) > 2:
        number = F.array_position(F.array(*[F.lit(c) for c in classes]), col(target).cast("int")) - 1
        fitted = fit_softmax(train, number, len(classes), list(features), trees, depth, rate, subsample, seed)
        return RiskModel({}, classes, tuple(features), fitted)
    rows = _assembled(train, features).select("_features", col(target).cast("int").alias("_class"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    booster = GBTClassifier(
        featuresCol="_features",
        labelCol="_label",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        seed=seed,
    )

    try:
        fitted = booster.fit(rows.withColumn("_label", (F.col("_class") == classes[1]).cast("double")))
    finally:
        rows.unpersist()
    return RiskModel({classes[1]: fitted}, classes, tuple(features))


def predict(df: DataFrame, model: RiskModel) -> DataFrame:
    """Add `probability_<class>` (summing to 1), `margin_<class>`, `prediction` and `risk`."""
    if model.softmax:
        out = with_margins(df, model.softmax, list(model.features), "_margins")
        margins = {c: F.get("_margins", F.lit(k)) for k, c in enumerate(model.classes)}
        chances = {c: F.exp(m - F.array_max("_margins")) for c, m in margins.items()}
    else:
        first, second = model.classes
        named = model.boosters[second].copy()
        named.setRawPredictionCol("_raw").setProbabilityCol("_prob").setPredictionCol("_pred")
        out = named.transform(_assembled(df, model.features))
        raw, chance = vector_to_array("_raw")[1], vector_to_array("_prob")[1]
        margins, chances = {first: -raw, second: raw}, {first: F.lit(1.0) - chance, second: chance}
    added = [margins[c].alias(f"margin_{c}") for c in model.classes]
    added += [chances[c].alias(f"_chance_{c}") for c in model.classes]
    scored = out.select(*[col(c) for c in df.columns], *added)
    total = sum((F.col(f"_chance_{c}") for c in model.classes[1:]), F.col(f"_chance_{model.classes[0]}"))
    # The greatest probability wins, the lower class on a tie.
    best = F.array_max(
        F.array(*[F.struct(F.col(f"_chance_{c}").alias("p"), F.lit(-c).alias("c")) for c in model.classes])
    )
    return scored.select(
        *[col(c) for c in df.columns],
        *[F.col(f"margin_{c}") for c in model.classes],
        *[(F.col(f"_chance_{c}") / total).alias(f"probability_{c}") for c in model.classes],
        (-best["c"]).alias("prediction"),
    ).withColumn("risk", decode(F.col("prediction"), RISK_LABELS))


def evaluate(predicted: DataFrame, target: str, model: RiskModel) -> dict[str, DataFrame]:
    """The classification report and the area under the curve, each a DataFrame."""
    report = classification_report(predicted, target, "prediction", RISK_LABELS)
    if len(model.classes) == 2:
        second = model.classes[1]
        area = roc_auc(predicted, target, f"probability_{second}", second).select(F.col("auc").alias("roc_auc"))
        return {"classification_report": report, "roc_auc": area}
    scores = {c: f"probability_{c}" for c in model.classes}
    return {"classification_report": report, "roc_auc_ovr": roc_auc_macro(predicted, target, scores)}


def train_risk_model(
    df: DataFrame,
    target: str = "risk_level",
    features: Sequence[str] | None = None,
    key: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    **options,
) -> tuple[RiskModel, DataFrame, dict[str, DataFrame]]:
    """Split, fit, and score the test rows; returns model, scored test rows and metrics.

    `key` names the columns that identify a row for the split; by default all of them. Split and
    scores are stored once; report, areas and attributions read them.
    """
    names = feature_columns(df, target, features)
    split = materialize(stratified_split(df, target, list(key or df.columns), test_size, seed), "split")
    model = fit_risk_model(split.where(F.col("split") == "train"), target, names, seed=seed, **options)
    scored = materialize(predict(split.where(F.col("split") == "test").drop("split"), model), "scored")
    return model, scored, evaluate(scored, target, model)
