"""Projections, filters and joins on keyed frames: P2-P5, P10, P11, J1, J2, W19, U1."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.plans.series import Series


def select_features(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Projection; the error lists every unknown name."""
    wanted = list(columns)
    unknown = [c for c in wanted if c not in df.columns]
    if unknown:
        raise ValueError(f"Columns not found: {unknown}")
    return df.select(*wanted)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def features_only(series: Series, features: DataFrame, include_original: bool = True) -> DataFrame:
    """Features with the measured columns beside them, or without."""
    if include_original:
        absent = [c for c in series.values if c not in features.columns]
        if absent:
            return append_columns(features, series.df.select(*series.identity, *absent), series.identity)
        return features
    return features.drop(*series.values)


def align_columns(df: DataFrame, expected: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """The columns a model was trained on, in its order: missing ones as 0, extra ones dropped."""
    have = set(df.columns)
    cells = [F.col(c) if c in have else F.lit(0.0).alias(c) for c in expected]
    return df.select(*keep, *cells)


def flagged(df: DataFrame, flag: str = "anomaly") -> DataFrame:
    """Rows whose flag is set."""
    return df.filter(F.col(flag).cast("boolean"))


def latest_reading(series: Series) -> DataFrame:
    """Newest row of every series: one aggregate, combined before the shuffle."""
    rest = [c for c in series.df.columns if c not in series.keys]
    newest = F.max_by(F.struct(*rest), F.struct(*series.order)).alias("_newest")
    return series.df.groupBy(*series.keys).agg(newest).select(*series.keys, "_newest.*")


def sensor_slice(series: Series, sensor: str) -> DataFrame:
    """(keys, time, sensor); an unknown sensor is an error."""
    if sensor not in series.values:
        raise ValueError(f"Sensor {sensor!r} not found; available: {list(series.values)}")
    return series.df.select(*series.identity, sensor)


def append_columns(left: DataFrame, right: DataFrame, on: Iterable[str]) -> DataFrame:
    """Features of one row identity side by side. Only for frames that do not share a plan."""
    return left.join(right, list(on), "inner")


def with_labels(features: DataFrame, labels: DataFrame, on: Iterable[str]) -> DataFrame:
    """Features with their labels, matched by identity; rows without a label are left out."""
    return features.join(labels, list(on), "inner")


def tail(series: Series, n: int) -> DataFrame:
    """Newest n rows of every series.

    Positions come from the block layout, so a long series is not gathered in one task, whatever n is. Without a known
    size (a few rows per series, as in a stream's memory) a rank is enough.
    """
    if series.profile().longest <= series.block_rows:
        newest = Window.partitionBy(*series.keys).orderBy(*[F.col(c).desc() for c in series.order])
        return series.df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")
    rows = series.transform_rows(lambda df, frames: df.withColumn("_at", frames.position()))
    size = series.df.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_size"))
    out = series.attach(rows, size).filter(F.col("_at") > F.col("_size") - n)
    return out.drop("_at", "_size")


def append_recent(series: Series, batch: DataFrame, n: int = 500) -> DataFrame:
    """Stored rows and a new batch, cut to the newest n of every series."""
    return tail(series.with_df(series.df.unionByName(batch, allowMissingColumns=True)), n)


def sequences(
    series: Series, columns: Iterable[str] | None = None, length: int = 60, label: str | None = None
) -> DataFrame:
    """Every window of `length` consecutive rows as ARRAY<ARRAY<DOUBLE>>, named by its last row.

    With `label`, the label of the last row rides along.
    """
    cols = series.columns(columns)

    def plan(df: DataFrame, frames) -> DataFrame:
        vector = F.array(*[F.col(c) for c in cols])
        df = df.withColumn("sequence", F.collect_list(vector).over(frames.last(length)))
        extra = [label] if label else []
        helper = [c for c in df.columns if c.startswith("_")]
        return df.filter(F.size("sequence") == length).select(
            *series.identity, "sequence", *extra, *helper
        )

    return series.transform_rows(plan, before=length - 1)
