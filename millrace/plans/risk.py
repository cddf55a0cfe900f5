"""Risk classification from features to metrics and attributions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.operators import attributions, boosting
from millrace.operators.feature_store import FeatureStore
from millrace.plans.health import preprocess
from millrace.sinks.tables import load_warehouse

HIGH = 2


@dataclass(frozen=True)
class RiskRun:
    model: boosting.RiskModel
    scored: DataFrame
    metrics: dict[str, DataFrame]
    attributed: DataFrame
    importance: DataFrame
    sample_explanation: DataFrame


def explain_rows(attributed: DataFrame, features: Sequence[str], class_index: int = HIGH, k: int = 10) -> DataFrame:
    """The k strongest contributions to one class, for every row."""
    return attributions.top_contributions(attributed.where(F.col("class") == class_index), features, k)


def run_risk(
    df: DataFrame,
    key: Sequence[str],
    target: str = "risk_level",
    features: Sequence[str] | None = None,
    max_display: int = 20,
    **options,
) -> RiskRun:
    """Train, evaluate and explain. The sample is the test row with the lowest key."""
    names = features if features is not None else [c for c in df.columns if c != target and c not in key]
    model, scored, metrics = boosting.train_risk_model(df, target, names, key, **options)
    attributed = attributions.attribute(scored, model.leaves(df.sparkSession), model.features, key)
    importance = attributions.global_importance(attributed, model.features, max_display)
    explained = HIGH if HIGH in model.classes else model.classes[-1]
    first = scored.orderBy(*[col(k) for k in key]).limit(1)
    sample = attributions.attribute(first, model.leaves(df.sparkSession), model.features, key)
    return RiskRun(model, scored, metrics, attributed, importance, explain_rows(sample, model.features, explained))


def features_to_warehouse(
    raw: DataFrame,
    store: FeatureStore,
    name: str,
    version: int,
    key: Sequence[str],
    target: str,
    warehouse_url: str | None = None,
    table: str | None = None,
    warehouse_options: dict | None = None,
    **options,
) -> RiskRun:
    """Preprocess, save a feature version, train on it, and load the scores to a warehouse."""
    prepared = preprocess(raw, exclude=[*key, target])
    store.save(name, prepared.dataframe, version)
    run = run_risk(store.load(name, version), key, target, **options)
    if warehouse_url:
        load_warehouse(run.scored, warehouse_url, table or name, **(warehouse_options or {}))
    return run
