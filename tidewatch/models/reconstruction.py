"""Reconstruction detectors: D8, D9, D10.

A linear autoencoder is principal components: standardise, project to a bottleneck, project back, and score a
row by its mean squared error. Components are orthonormal, so the error is the part of the row's length
that the projection loses and no reconstructed row is ever built.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.models.base import FittedModel, checked_features, standardised
from tidewatch.plans.lagged import covariance, laid_out, per_window
from tidewatch.plans.ordered import exact_quantile
from tidewatch.plans.series import Series

BOTTLENECK = 32


def _squares(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x)


def training_threshold(errors: DataFrame, score: str, rule: str) -> float:
    """Cut from training errors: 'deviations' is mean + 2 population deviations, 'p95' the 95th percentile."""
    if rule == "deviations":
        row = errors.agg(F.avg(score), F.stddev_pop(score)).first()
        return row[0] + 2.0 * row[1]
    if rule == "p95":
        return exact_quantile(errors.select(score), score, 0.95).first()[0]
    raise ValueError(f"Unknown threshold rule {rule!r}; choose from ['deviations', 'p95']")


class Reconstruction(FittedModel):
    algorithm = "reconstruction"
    size_name = "components"
    pca: PCAModel

    def _errors(self, df: DataFrame, vector: Column, width: int) -> DataFrame:
        df = self.pca.transform(df.withColumn("_x", vector))
        lost = _squares(vector_to_array("_x")) - _squares(vector_to_array("_z"))
        error = F.greatest(lost, F.lit(0.0)) / F.lit(float(width))
        return df.withColumn(f"score_{self.name}", error).drop("_x", "_z")

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        return self._errors(df, self.vector(df), len(self.features))

    def write_payload(self, path: str, spark) -> None:
        self.pca.write().overwrite().save(f"{path}/pca")

    def read_payload(self, path: str, spark) -> None:
        self.pca = PCAModel.load(f"{path}/pca")


def _components(df: DataFrame, width: int) -> tuple[PCAModel, int]:
    k = max(1, min(BOTTLENECK, width // 2))
    return PCA(k=k, inputCol="_x", outputCol="_z").fit(df), k


def fit_reconstruction(
    df: DataFrame,
    features: Iterable[str],
    rule: str = "deviations",
    name: str = "autoencoder",
) -> Reconstruction:
    """Fit on rows taken as normal; bottleneck min(32, d / 2)."""
    cols = checked_features(df, features)
    model = Reconstruction(name, cols, standardised(df, cols))
    model.pca, k = _components(df.select(model.vector(df).alias("_x")), len(cols))
    model.settings = {"components": k, "rule": rule}
    score = f"score_{name}"
    model.threshold = training_threshold(model.scored(df.select(*cols)), score, rule)
    return model


class SequenceModel(FittedModel):
    """What models of whole sequences share: sequences are read as `plans.lagged` windows of scaled features, and their
    principal components, found from lag products, stand for them. A result belongs to the row that ends its sequence."""

    components: np.ndarray

    def laid(self, series: Series, keep: list[str]) -> DataFrame:
        return laid_out(series, self.inputs(series.df), self.settings["length"], keep)

    def fit_components(self, series: Series, most: int) -> int:
        """The leading components, at most `most`; the covariance, of length x features squared numbers, is the driver's."""
        length = self.settings["length"]
        width = length * len(self.features)
        n, spread = covariance(self.laid(series, []), width, length)
        if not n:
            raise ValueError(f"No series has the {length} rows of a sequence")
        values, vectors = np.linalg.eigh(spread)
        self.components = vectors[:, np.argsort(values)[::-1][: max(1, min(most, width))]]
        return self.components.shape[1]

    def on_windows(self, series: Series, keep: list[str], fn: Callable[[np.ndarray], pa.Array], name: str, kind: str) -> DataFrame:
        return per_window(self.laid(series, keep), self.settings["length"], keep, fn, name, kind)

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        """Rows need the order columns this model was trained with; `keys` say what a series is where that differs, as in
        overlapping windows, where a reading belongs to a sequence of each of its windows."""
        s = self.settings
        series = Series(df, keys or tuple(s["keys"]), s["ts"], s["tie"], tuple(self.features))
        return df.join(self.scored_series(series), series.identity, "left")

    def write_payload(self, path: str, spark) -> None:
        rows = [(i, [float(v) for v in row]) for i, row in enumerate(self.components)]
        spark.createDataFrame(rows, "entry int, weights array<double>").write.mode("overwrite").parquet(f"{path}/components")

    def read_payload(self, path: str, spark) -> None:
        rows = spark.read.parquet(f"{path}/components").orderBy("entry").collect()
        self.components = np.array([r["weights"] for r in rows])


class SequenceReconstruction(SequenceModel):
    """Scores whole sequences by what their components lose."""

    algorithm = "sequence_reconstruction"
    size_name = "components"

    def scored_series(self, series: Series) -> DataFrame:
        components, width = self.components, self.settings["width"]

        def errors(vectors: np.ndarray) -> pa.Array:
            kept = vectors @ components
            lost = (vectors * vectors).sum(axis=1) - (kept * kept).sum(axis=1)
            return pa.array(np.maximum(lost, 0.0) / width)

        return self.on_windows(series, series.identity, errors, f"score_{self.name}", "double")


def sequence_settings(series: Series, length: int) -> dict:
    return {"length": length, "keys": list(series.keys), "ts": series.ts, "tie": series.tie}


def fit_sequence_reconstruction(
    series: Series,
    features: Iterable[str] | None = None,
    length: int = 60,
    rule: str = "deviations",
    name: str = "lstm_autoencoder",
) -> SequenceReconstruction:
    cols = series.columns(features)
    model = SequenceReconstruction(name, cols, standardised(series.df, cols))
    width = length * len(cols)
    model.settings = {**sequence_settings(series, length), "width": width, "rule": rule}
    model.settings["components"] = model.fit_components(series, max(1, min(BOTTLENECK, width // 2)))
    model.threshold = training_threshold(model.scored_series(series), f"score_{name}", rule)
    return model
