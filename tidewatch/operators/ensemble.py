"""Combining models and their thresholds: E1-E4, D16-D18, C10.

Wide frames hold pred_<m>, prob_<m>, score_<m> and conf_<m> columns per model m. A NULL prediction means the
model said nothing about the row; its weight is then left out.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scores import (
    as_flag,
    confidence,
    is_reconstruction,
    prediction_models,
    rescaled,
    vote_weight,
    zero_if_undefined,
)
from tidewatch.operators.project import tail
from tidewatch.plans.series import Series

METHODS = ("majority_vote", "weighted_vote", "max_probability", "confidence_weighted")
THRESHOLD_SCHEMA = "model string, threshold double"


def _models(df: DataFrame, models: Iterable[str] | None) -> list[str]:
    found = list(models) if models is not None else prediction_models(df.columns)
    if not found:
        raise ValueError("No pred_<model> columns to combine")
    return found


def _total(cells: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cells)


def _said(m: str) -> Column:
    return F.col(f"pred_{m}")


def _any_vote(models: list[str]) -> Column:
    votes = _total([F.coalesce(_said(m), F.lit(0)) for m in models])
    return as_flag(votes > 0)


def weighted_vote(models: list[str], weights: dict[str, float] | None = None) -> Column:
    """1 when the models saying so hold more than half of the weight of those that said anything."""
    weights = weights or {m: vote_weight(m) for m in models}
    for_it = _total([F.coalesce(_said(m), F.lit(0)) * F.lit(weights[m]) for m in models])
    present = _total([F.when(_said(m).isNotNull(), F.lit(weights[m])).otherwise(F.lit(0.0)) for m in models])
    return as_flag(for_it > present / 2)


def majority_vote(models: list[str]) -> Column:
    return weighted_vote(models, {m: 1.0 for m in models})


def score_ranges(df: DataFrame, models: list[str]) -> dict[str, tuple[float, float]]:
    """Lowest and highest score of each model over the frame: one aggregate, one row."""
    scored = [m for m in models if f"score_{m}" in df.columns]
    if not scored:
        return {}
    cells = []
    for i, m in enumerate(scored):
        cells += [F.min(f"score_{m}").alias(f"lo{i}"), F.max(f"score_{m}").alias(f"hi{i}")]
    row = df.agg(*cells).first()
    return {m: (row[f"lo{i}"], row[f"hi{i}"]) for i, m in enumerate(scored)}


def max_probability(df: DataFrame, models: list[str]) -> Column:
    """Highest probability or normalised score above one half; without any of them, any vote decides."""
    cells = [F.col(f"prob_{m}") for m in models if f"prob_{m}" in df.columns]
    for m, (lo, hi) in score_ranges(df, models).items():
        if lo is not None:
            cells.append(rescaled(F.col(f"score_{m}"), F.lit(lo), F.lit(hi)))
    if not cells:
        return _any_vote(models)
    best = F.greatest(*cells) if len(cells) > 1 else cells[0]
    return as_flag(best > 0.5)


def confidence_average(models: list[str]) -> Column:
    """Mean vote weighted by confidence, 0 when no model is confident at all."""
    spoke = {m: F.coalesce(F.col(f"conf_{m}"), F.lit(0.0)) for m in models}
    spoke = {m: F.when(_said(m).isNotNull(), c).otherwise(F.lit(0.0)) for m, c in spoke.items()}
    votes = _total([F.coalesce(_said(m), F.lit(0)) * c for m, c in spoke.items()])
    return zero_if_undefined(F.try_divide(votes, _total(list(spoke.values()))))


def combine(
    df: DataFrame,
    method: str = "majority_vote",
    models: Iterable[str] | None = None,
    name: str = "ensemble",
    cut: float = 0.6,
) -> DataFrame:
    """Adds the ensemble's 0/1 decision; an unknown method is an error."""
    found = _models(df, models)
    if method == "majority_vote":
        cell = majority_vote(found)
    elif method == "weighted_vote":
        cell = weighted_vote(found)
    elif method == "max_probability":
        cell = max_probability(df, found)
    elif method == "confidence_weighted":
        sure = [m for m in found if f"conf_{m}" in df.columns]
        cell = as_flag(confidence_average(sure) > cut) if sure else majority_vote(found)
    else:
        raise ValueError(f"Unknown method {method!r}; choose from {list(METHODS)}")
    return df.withColumn(name, cell)


def threshold_table(spark: SparkSession, thresholds: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(thresholds.items()), THRESHOLD_SCHEMA)


def read_thresholds(table: DataFrame) -> dict[str, float]:
    """The table has one row per model."""
    return {r["model"]: r["threshold"] for r in table.select("model", "threshold").collect()}


def with_confidence(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """conf_<m> from score_<m> for every model that has a threshold."""
    cells = {
        f"conf_{m}": confidence(F.col(f"score_{m}"), F.lit(float(t)))
        for m, t in thresholds.items()
        if f"score_{m}" in df.columns
    }
    return df.withColumns(cells)


def mean_confidence(df: DataFrame, name: str = "confidence") -> DataFrame:
    """Mean of the per-model confidences that are there."""
    cells = [F.col(c) for c in df.columns if c.startswith("conf_")]
    if not cells:
        return df.withColumn(name, F.lit(None).cast("double"))
    total = _total([F.coalesce(c, F.lit(0.0)) for c in cells])
    there = _total([c.isNotNull().cast("int") for c in cells])
    return df.withColumn(name, F.try_divide(total, there))


def dynamic_thresholds(
    series: Series, models: Iterable[str], n: int = 100, percentile: float = 95.0
) -> DataFrame:
    """Per series, the percentile of the newest n scores of each reconstruction model.

    Long result (keys, model, threshold). At most n rows of a series reach the percentile.
    """
    found = [m for m in models if is_reconstruction(m)]
    newest = tail(series, n)
    cells = [F.percentile(f"score_{m}", percentile / 100.0).alias(f"t_{i}") for i, m in enumerate(found)]
    if not cells:
        return newest.select(
            *series.keys, F.lit("").alias("model"), F.lit(0.0).alias("threshold")
        ).filter(F.lit(False))
    table = newest.groupBy(*series.keys).agg(*cells)
    rows = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(f"t_{i}").alias("threshold")) for i, m in enumerate(found)]
    )
    return table.select(*series.keys, F.explode(rows).alias("r")).select(*series.keys, "r.*")


def raised_thresholds(thresholds: DataFrame, rate: Column, limit: float = 0.3, factor: float = 1.1) -> DataFrame:
    """Every threshold times `factor` when the anomaly rate is above `limit`."""
    raised = F.when(rate > limit, F.col("threshold") * factor).otherwise(F.col("threshold"))
    return thresholds.withColumn("threshold", raised)
