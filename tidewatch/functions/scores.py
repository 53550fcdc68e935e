"""Expressions on scores, votes and confusion counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_undefined(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when the denominator is 0."""
    return zero_if_undefined(F.try_divide(num.cast("double"), den.cast("double")))


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1_of(p: Column, r: Column) -> Column:
    return ratio(F.lit(2.0) * p * r, p + r)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 straight from counts."""
    return ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn)


def any_of(*flags: Column | str) -> Column:
    """True when at least one flag is true; a missing flag counts as false."""
    cols = [F.coalesce(F.col(f) if isinstance(f, str) else f, F.lit(False)) for f in flags]
    return reduce(lambda a, b: a | b, cols)


def as_flag(condition: Column) -> Column:
    """0/1 INT of a condition, 0 when it is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def confidence(score: Column, threshold: Column) -> Column:
    """Distance above the threshold, relative to it, through a sigmoid of slope 5."""
    margin = (score - threshold) / (threshold + F.lit(1e-10))
    # Outside +-100 the sigmoid is 0 or 1 to double precision; the clamp keeps exp() finite.
    steep = F.greatest(F.least(margin * 5, F.lit(100.0)), F.lit(-100.0))
    return F.least(F.greatest(F.lit(1.0) / (F.lit(1.0) + F.exp(-steep)), F.lit(0.0)), F.lit(1.0))


def rescaled(score: Column, low: Column, high: Column) -> Column:
    """Min-max normalised score; 0.5 when all scores are equal."""
    flat = F.when(score.isNotNull(), F.lit(0.5))
    return F.when(high > low, F.try_divide(score - low, high - low)).otherwise(flat)


def vote_weight(model: str) -> float:
    """Weight of a model in the weighted vote, by its name."""
    if "lstm" in model or "sequence" in model:
        return 2.0
    if model in ("random_forest", "xgboost", "gradient_boosting"):
        return 1.5
    return 1.0


def is_reconstruction(model: str) -> bool:
    """Models whose score is a reconstruction error and whose threshold can be recalibrated."""
    return "autoencoder" in model or "reconstruction" in model


def prediction_models(columns: list[str], prefix: str = "pred_") -> list[str]:
    """Model names behind the `pred_` columns of a frame."""
    return [c[len(prefix):] for c in columns if c.startswith(prefix)]
