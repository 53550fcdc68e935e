"""Scoring with several models, and keeping them: D15, S9, S10."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.models.base import FittedModel
from tidewatch.models.forest import IsolationForest
from tidewatch.models.oneclass import FourierOneClass
from tidewatch.models.reconstruction import Reconstruction, SequenceReconstruction
from tidewatch.models.supervised import Classifier, SequenceClassifier
from tidewatch.operators.ensemble import with_confidence
from tidewatch.operators.scale import Scaler

REGISTRY_SCHEMA = (
    "name string, algorithm string, size int, threshold double, has_scaler boolean, "
    "features array<string>, settings string"
)
KINDS = {
    "isolation_forest": IsolationForest,
    "rff_one_class": FourierOneClass,
    "reconstruction": Reconstruction,
    "sequence_reconstruction": SequenceReconstruction,
    "random_forest": Classifier,
    "gradient_boosting": Classifier,
    "sequence_classifier": SequenceClassifier,
}


def predict(
    models: dict[str, FittedModel],
    df: DataFrame,
    names: Iterable[str] | None = None,
    keys: tuple[str, ...] | None = None,
    thresholds: dict[str, float] | None = None,
) -> DataFrame:
    """Outputs of all or the named models side by side; an unknown name is an error.

    `keys` name a series of `df` where that is not what the models were fitted on; `thresholds` stand in for those of the
    models, which are left as they are.
    """
    if not models:
        raise ValueError("No trained models")
    chosen = list(names) if names is not None else list(models)
    unknown = [n for n in chosen if n not in models]
    if unknown:
        raise ValueError(f"Models not found: {unknown}; available: {list(models)}")
    for n in chosen:
        df = models[n].transform(df, keys, (thresholds or {}).get(n))
    return df


def thresholds_of(models: dict[str, FittedModel]) -> dict[str, float]:
    """Current thresholds of the models that score; probabilities have none to recalibrate."""
    return {n: m.threshold for n, m in models.items() if not isinstance(m, Classifier)}


def predict_with_confidence(
    models: dict[str, FittedModel], df: DataFrame, names: Iterable[str] | None = None
) -> DataFrame:
    return with_confidence(predict(models, df, names), thresholds_of(models))


def registry(spark: SparkSession, models: dict[str, FittedModel]) -> DataFrame:
    """One row per model."""
    rows = []
    for m in models.values():
        d = m.describe()
        rows.append(
            (d["name"], d["algorithm"], d["size"], d["threshold"], d["has_scaler"], m.features, json.dumps(m.settings))
        )
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def save_models(spark: SparkSession, models: dict[str, FittedModel], path: str) -> None:
    """Registry, scalers and payloads below one folder."""
    registry(spark, models).write.mode("overwrite").parquet(f"{path}/registry")
    for m in models.values():
        m.write_payload(f"{path}/{m.name}", spark)
        if m.scaler:
            m.scaler.table(spark).write.mode("overwrite").parquet(f"{path}/{m.name}/scaler")


def load_models(spark: SparkSession, path: str) -> dict[str, FittedModel]:
    models: dict[str, FittedModel] = {}
    for row in spark.read.parquet(f"{path}/registry").collect():
        kind = KINDS[row["algorithm"]]
        extra = {"algorithm": row["algorithm"]} if issubclass(kind, Classifier) else {}
        model = kind(
            row["name"], list(row["features"]), None, row["threshold"], json.loads(row["settings"]), **extra
        )
        if row["has_scaler"]:
            model.scaler = Scaler.from_table(spark.read.parquet(f"{path}/{model.name}/scaler"))
        model.read_payload(f"{path}/{model.name}", spark)
        models[model.name] = model
    return models
