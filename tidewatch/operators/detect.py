"""Statistical detectors: D1-D5, A1, A2, A7, A8.

A detector is a function (series, column, **parameters) -> DataFrame that adds one BOOLEAN column to the
series' rows, so that several can be evaluated side by side.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scores import any_of
from tidewatch.operators.rolling import rolling_median
from tidewatch.plans.doubling import Moments, add_summaries, summary
from tidewatch.plans.layout import Frames
from tidewatch.plans.series import Series

FLAG = "anomaly"


def sensor_summary(df: DataFrame, columns: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """Mean, min, max and sample deviation per column."""
    cells = []
    for c in columns:
        cells += [
            F.avg(c).alias(f"{c}_mean"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.stddev_samp(c).alias(f"{c}_std"),
        ]
    return df.groupBy(*by).agg(*cells)


def threshold_bounds(
    series: Series, columns: Iterable[str] | None = None, k: float = 3.0, population: bool = False
) -> DataFrame:
    """Per series, mean -/+ k deviations of every column as {c}_lower and {c}_upper."""
    spread_of = F.stddev_pop if population else F.stddev_samp
    cells = []
    for c in series.columns(columns):
        mean, spread = F.avg(c), spread_of(c)
        cells += [(mean - k * spread).alias(f"{c}_lower"), (mean + k * spread).alias(f"{c}_upper")]
    return series.df.groupBy(*series.keys).agg(*cells)


def _outside(column: str):
    x, low, high = F.col(column), F.col(f"{column}_lower"), F.col(f"{column}_upper")
    return F.coalesce((x > high) | (x < low), F.lit(False))


def threshold_detector(
    series: Series, column: str, k: float = 3.0, population: bool = False, flag: str = FLAG
) -> DataFrame:
    """Outside mean -/+ k deviations of its own series."""
    bounds = threshold_bounds(series, [column], k, population)
    rows = series.attach(series.df, bounds)
    return rows.withColumn(flag, _outside(column)).drop(f"{column}_lower", f"{column}_upper")


def multi_sensor_label(
    series: Series,
    columns: Iterable[str] | None = None,
    k: float = 3.0,
    population: bool = False,
    flag: str = FLAG,
) -> DataFrame:
    """True when any sensor is outside its bounds: one aggregate and one join for all sensors."""
    cols = series.columns(columns)
    rows = series.attach(series.df, threshold_bounds(series, cols, k, population))
    return rows.withColumn(flag, any_of(*[_outside(c) for c in cols])).select(*series.df.columns, flag)


def fallback_detector(
    df: DataFrame, columns: Iterable[str], batch: Iterable[str], k: float = 3.0, flag: str = FLAG
) -> DataFrame:
    """The rule used when no model can score: any sensor outside the bounds of its own batch.

    Deviations are those of the population. `batch` names the columns that identify a batch.
    """
    cols, by = list(columns), list(batch)
    cells = []
    for c in cols:
        mean, spread = F.avg(c), F.stddev_pop(c)
        cells += [(mean - k * spread).alias(f"{c}_lower"), (mean + k * spread).alias(f"{c}_upper")]
    bounds = df.groupBy(*by).agg(*cells)
    rows = df.join(bounds, by, "left")
    return rows.withColumn(flag, any_of(*[_outside(c) for c in cols])).select(*df.columns, flag)


def moving_average_detector(
    series: Series, column: str, window: int = 20, k: float = 2.5, flag: str = FLAG
) -> DataFrame:
    """Further than k rolling deviations from the rolling mean; the row itself is in its window."""
    state = Moments(column, 2)

    def plan(df: DataFrame, frames: Frames) -> DataFrame:
        kept = [f"`{c}`" for c in df.columns]
        df = add_summaries(df, frames, [state], [window])
        mean, spread = summary(state, window, "m"), summary(state, window, "s2")
        rule = f"abs(`{column}` - {mean}) > {float(k)!r}D * sqrt({spread} / {window - 1}D)"
        return df.selectExpr(*kept, f"coalesce({rule}, false) AS `{flag}`")

    return series.transform_rows(plan, before=window - 1)


def robust_z_detector(
    series: Series,
    column: str,
    window: int = 20,
    t: float = 3.0,
    flag: str = FLAG,
    score: str | None = None,
) -> DataFrame:
    """Rolling-median z-score beyond t; every row's deviation is taken from its own rolling median."""

    def plan(df: DataFrame, frames: Frames) -> DataFrame:
        kept = [f"`{c}`" for c in df.columns]
        df, median = rolling_median(df, frames, column, window)
        df = df.selectExpr(*kept, f"`{column}` - ({median}) AS _off")
        df = df.selectExpr("*", "abs(_off) AS _dev")
        df, mad = rolling_median(df, frames, "_dev", window)
        z = f"coalesce(0.6745D * _off / (({mad}) + 1e-9D), 0D)"
        out = [f"abs({z}) > {float(t)!r}D AS `{flag}`"]
        if score:
            out.append(f"{z} AS `{score}`")
        return df.selectExpr(*kept, *out)

    return series.transform_rows(plan, before=2 * (window - 1))


def anomaly_rate(df: DataFrame, flag: str = FLAG, by: Iterable[str] = ()) -> DataFrame:
    """Share of flagged rows."""
    return df.groupBy(*by).agg(F.avg(F.col(flag).cast("int")).alias("anomaly_rate"))


def label_balance(df: DataFrame, label: str = "label", by: Iterable[str] = ()) -> DataFrame:
    """Anomalous and normal rows, and the weight that balances them (NULL without anomalies)."""
    one = F.count_if(F.col(label).cast("int") == 1)
    zero = F.count_if(F.col(label).cast("int") == 0)
    return df.groupBy(*by).agg(
        one.alias("anomalies"),
        zero.alias("normal"),
        F.try_divide(zero.cast("double"), one.cast("double")).alias("positive_weight"),
    )
