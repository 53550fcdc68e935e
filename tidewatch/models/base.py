"""What all fitted models share: features, scaler, columns they add, metadata."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scores import as_flag
from tidewatch.operators.scale import Scaler, fit_scaler


@dataclass
class FittedModel:
    """Adds pred_<name> and score_<name> or prob_<name> to a frame."""

    name: str
    features: list[str]
    scaler: Scaler | None = None
    threshold: float | None = None
    settings: dict = field(default_factory=dict)

    algorithm = "model"
    size_name = "size"

    def inputs(self, df: DataFrame) -> list[Column]:
        """Feature cells in training order: absent columns and missing values are 0, then scaled."""
        have, cells = set(df.columns), []
        for c in self.features:
            x = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0)
            if self.scaler and c in self.scaler.parameters:
                centre, spread = self.scaler.parameters[c]
                x = (x - F.lit(centre)) / F.lit(spread)
            cells.append(x)
        return cells

    def array(self, df: DataFrame) -> Column:
        return F.array(*self.inputs(df))

    def vector(self, df: DataFrame) -> Column:
        return array_to_vector(self.array(df))

    def scored(self, df: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
        """Adds this model's raw outputs. `keys`: what a series of `df` is, where it is not what the model was fitted on."""
        raise NotImplementedError

    def transform(self, df: DataFrame, keys: tuple[str, ...] | None = None, threshold: float | None = None) -> DataFrame:
        """Adds outputs and flags; a given threshold stands in for the model's own, which stays as it is."""
        return self.flagged(self.scored(df, keys), threshold)

    def flagged(self, out: DataFrame, threshold: float | None = None) -> DataFrame:
        """Flags for rows that have this model's scores."""
        flag = as_flag(F.col(f"score_{self.name}") > F.lit(self.threshold if threshold is None else threshold))
        flag = F.when(F.col(f"score_{self.name}").isNotNull(), flag)
        return out.withColumn(f"pred_{self.name}", flag)

    def write_payload(self, path: str, spark) -> None:
        """Store what metadata and scaler do not hold."""

    def read_payload(self, path: str, spark) -> None:
        """Counterpart of write_payload."""

    def describe(self) -> dict:
        return {
            "name": self.name,
            "algorithm": self.algorithm,
            "size": self.settings.get(self.size_name),
            "threshold": self.threshold,
            "has_scaler": self.scaler is not None,
        }


def standardised(df: DataFrame, features: list[str]) -> Scaler:
    """Scaler over the features with missing values as 0, as models see them."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    return fit_scaler(filled, features, "standard")


def checked_features(df: DataFrame, features) -> list[str]:
    chosen = list(features)
    unknown = [c for c in chosen if c not in df.columns]
    if unknown or not chosen:
        raise ValueError(f"Columns not found: {unknown}" if unknown else "No feature columns given")
    return chosen
