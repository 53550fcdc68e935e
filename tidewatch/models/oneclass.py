"""One-class boundary in random Fourier features: D7.

Stands in for an RBF one-class machine. Features z(x) = sqrt(2/D) cos(Wx + b) approximate the RBF kernel; the
dual of the one-class problem is then a point w in the convex hull of the z's with weights of at most
1 / (nu n). It is found by conditional gradient steps: the best vertex for the current w is the mean of
the nu n rows with the lowest w.z, so a step is one quantile and one conditional mean, both plain aggregates.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.models.base import FittedModel, checked_features, standardised
from tidewatch.plans.ordered import exact_quantile


def _projection(d: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2 * gamma), (d, size)), rng.uniform(0, 2 * np.pi, size)


class FourierOneClass(FittedModel):
    algorithm = "rff_one_class"
    size_name = "size"
    weights: np.ndarray

    def _maps(self) -> tuple[np.ndarray, np.ndarray, float]:
        s = self.settings
        w, b = _projection(len(self.features), s["size"], s["gamma"], s["seed"])
        return w, b, float(np.sqrt(2.0 / s["size"]))

    def lifted(self, df: DataFrame) -> Column:
        w, b, lead = self._maps()

        @F.pandas_udf("array<double>")
        def lift(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for arrays in batches:
                if len(arrays) == 0:
                    yield pd.Series([], dtype=object)
                    continue
                yield pd.Series(list(lead * np.cos(np.stack(arrays.to_numpy()) @ w + b)))

        return lift(self.array(df))

    def margin(self, df: DataFrame) -> Column:
        w, b, lead = self._maps()
        weights = self.weights

        @F.pandas_udf("double")
        def dot(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for arrays in batches:
                if len(arrays) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                yield pd.Series(lead * np.cos(np.stack(arrays.to_numpy()) @ w + b) @ weights)

        return dot(self.array(df))

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        """Score = minus the margin, so that higher means more anomalous."""
        return df.withColumn(f"score_{self.name}", -self.margin(df))

    def write_payload(self, path: str, spark) -> None:
        rows = [(i, float(v)) for i, v in enumerate(self.weights)]
        spark.createDataFrame(rows, "at int, weight double").write.mode("overwrite").parquet(f"{path}/weights")

    def read_payload(self, path: str, spark) -> None:
        rows = sorted(spark.read.parquet(f"{path}/weights").collect(), key=lambda r: r["at"])
        self.weights = np.array([r["weight"] for r in rows])


def _mean_vector(df: DataFrame, lifted: Column, size: int) -> np.ndarray:
    """Mean of the lifted rows: one sum per coordinate, `size` rows to the driver."""
    rows = (
        df.select(F.posexplode(lifted).alias("at", "z")).groupBy("at").agg(F.avg("z").alias("m")).collect()
    )
    out = np.zeros(size)
    for row in rows:
        out[row["at"]] = row["m"]
    return out


def fit_one_class(
    df: DataFrame,
    features: Iterable[str],
    nu: float = 0.05,
    gamma: float | str = "scale",
    size: int = 128,
    steps: int = 5,
    seed: int = 42,
    name: str = "one_class_svm",
) -> FourierOneClass:
    """gamma='scale' is 1 / d on standardised features; about a share nu of the rows is flagged."""
    cols = checked_features(df, features)
    width = 1.0 / len(cols) if gamma in ("scale", "auto") else float(gamma)
    model = FourierOneClass(name, cols, standardised(df, cols))
    model.settings = {"size": size, "gamma": width, "nu": nu, "seed": seed, "steps": steps}
    rows = df.select(*cols)
    model.weights = _mean_vector(rows, model.lifted(rows), size)
    for t in range(steps):
        margin = rows.withColumn("_margin", model.margin(rows))
        cut = margin.agg(F.percentile_approx("_margin", nu, 10_000)).first()[0]
        low = margin.filter(F.col("_margin") <= cut)
        vertex = _mean_vector(low, model.lifted(low), size)
        pace = 2.0 / (t + 3.0)
        model.weights = (1 - pace) * model.weights + pace * vertex
    score = f"score_{name}"
    model.threshold = exact_quantile(model.scored(rows).select(score), score, 1.0 - nu).first()[0]
    return model
