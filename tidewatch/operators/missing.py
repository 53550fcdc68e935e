"""Filling and dropping missing values: W14-W16, P6-P8, A3, F7."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.neighbours import POSITION, with_neighbours
from tidewatch.plans.series import Series, numeric_columns

METHODS = ("interpolate", "ffill", "bfill", "zero", "drop")


def _interpolated(c: str, limit: int | None, ends: bool) -> str:
    """Closed form of linear interpolation by position with a reach of `limit` rows, as SQL text.

    Rows further into a gap than `limit` repeat the last interpolated value. With `ends`, a leading gap takes
    the first value; without, it stays missing.
    """
    p, n = f"`_prev_{c}`", f"`_next_{c}`"
    step = f"({POSITION} - {p}.p)"
    reach = step if limit is None else f"least({step}, {int(limit)})"
    lead = f"{n}.v" if ends else "NULL"
    return (
        f"CASE WHEN `{c}` IS NOT NULL THEN `{c}` "
        f"WHEN {p} IS NOT NULL AND {n} IS NOT NULL THEN {p}.v + ({n}.v - {p}.v) * {reach} / ({n}.p - {p}.p) "
        f"WHEN {p} IS NOT NULL THEN {p}.v ELSE {lead} END"
    )


def _carried(c: str, limit: int | None, forward: bool) -> str:
    near, far = (f"`_prev_{c}`", f"`_next_{c}`") if forward else (f"`_next_{c}`", f"`_prev_{c}`")
    if limit is None:
        return f"coalesce({near}.v, {far}.v)"
    return f"coalesce(CASE WHEN abs({POSITION} - {near}.p) <= {int(limit)} THEN {near}.v END, {far}.v)"


def _filled(series: Series, columns: Iterable[str] | None, fill) -> DataFrame:
    cols = set(series.columns(columns))
    names = series.df.columns
    if not cols:
        return series.df
    df = with_neighbours(series, [c for c in names if c in cols])
    return df.selectExpr(*[f"{fill(c)} AS `{c}`" if c in cols else f"`{c}`" for c in names])


def interpolate(
    series: Series, columns: Iterable[str] | None = None, limit: int | None = 5, ends: bool = True
) -> DataFrame:
    """Linear interpolation by row position, then (with `ends`) nearest values at both ends."""
    return _filled(series, columns, lambda c: _interpolated(c, limit, ends))


def ffill(series: Series, columns: Iterable[str] | None = None, limit: int | None = 5) -> DataFrame:
    """Last known value for at most `limit` rows; what is left takes the next known value."""
    return _filled(series, columns, lambda c: _carried(c, limit, forward=True))


def bfill(series: Series, columns: Iterable[str] | None = None, limit: int | None = 5) -> DataFrame:
    """Next known value for at most `limit` rows; what is left takes the last known value."""
    return _filled(series, columns, lambda c: _carried(c, limit, forward=False))


def fill_zero(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing numbers become 0."""
    return df.fillna(0, subset=list(columns) if columns is not None else numeric_columns(df))


def drop_incomplete_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(columns) if columns is not None else None)


def missing_count(df: DataFrame, columns: Iterable[str] | None = None, by: Iterable[str] = ()) -> DataFrame:
    """Missing cells per column and in total, one pass."""
    by = list(by)
    cols = list(columns) if columns is not None else numeric_columns(df, exclude=by)
    counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_missing") for c in cols]
    out = df.groupBy(*by).agg(*counts)
    total = sum((F.col(f"{c}_missing") for c in cols), F.lit(0).cast("bigint"))
    return out.withColumn("missing", total)


def drop_incomplete_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop the columns that hold a missing value. One aggregate decides; it returns a single row."""
    cols = list(columns) if columns is not None else df.columns
    row = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()
    return df.drop(*[c for c in cols if row[c]])


def handle_missing(
    series: Series,
    method: str = "interpolate",
    limit: int | None = 5,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Dispatch by method name; an unknown name is an error."""
    cols = series.columns(columns)
    if method == "interpolate":
        return interpolate(series, cols, limit)
    if method == "ffill":
        return ffill(series, cols, limit)
    if method == "bfill":
        return bfill(series, cols, limit)
    if method == "zero":
        return fill_zero(series.df, cols)
    if method == "drop":
        return drop_incomplete_rows(series.df, cols)
    raise ValueError(f"Unknown method {method!r}; choose from {list(METHODS)}")
