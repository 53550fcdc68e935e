"""Lag, difference and rate of change: W9-W11."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.neighbours import with_neighbours
from tidewatch.plans.doubling import extended
from tidewatch.plans.layout import Frames
from tidewatch.plans.series import Series

LAGS = (1, 5, 10, 30)
KINDS = ("lag", "pct_change", "diff")


def lag_name(column: str, kind: str, lag: int) -> str:
    return f"{column}_{kind}_{lag}"


def lag_plan(
    df: DataFrame,
    frames: Frames,
    columns: list[str],
    lags: list[int],
    kinds: list[str],
    filled: dict[str, str] | None = None,
) -> DataFrame:
    """`filled` names, per column, the gap-free companion that the rate of change is taken on."""
    filled = filled or {}
    over = frames.sql()
    kept = df.columns
    cells = {}
    for c in columns:
        for k in lags:
            cells[f"_lag_{c}_{k}"] = f"lag(`{c}`, {k}) OVER {over}"
            if "pct_change" in kinds and c in filled:
                cells[f"_base_{c}_{k}"] = f"lag(`{filled[c]}`, {k}) OVER {over}"
    df = extended(df, cells)
    out = []
    for c in columns:
        for k in lags:
            past = f"`_lag_{c}_{k}`"
            if "lag" in kinds:
                out.append(f"{past} AS `{lag_name(c, 'lag', k)}`")
            if "pct_change" in kinds:
                now, base = f"`{filled.get(c, c)}`", f"`_base_{c}_{k}`" if c in filled else past
                out.append(f"try_divide({now}, {base}) - 1 AS `{lag_name(c, 'pct_change', k)}`")
            if "diff" in kinds:
                out.append(f"`{c}` - {past} AS `{lag_name(c, 'diff', k)}`")
    return df.selectExpr(*[f"`{x}`" for x in kept if x not in filled.values()], *out)


def lags(
    series: Series,
    columns: Iterable[str] | None = None,
    lags: Iterable[int] = LAGS,
    kinds: Iterable[str] = KINDS,
) -> DataFrame:
    """Value k rows back, difference to it, and rate of change after forward-filling gaps.

    A rate of change from 0 is NULL: there is no infinity in the result.
    """
    cols, steps, chosen = series.columns(columns), list(lags), list(kinds)
    filled: dict[str, str] = {}
    if "pct_change" in chosen:
        series, filled = with_forward_filled(series, cols)
    return series.transform_rows(
        lambda df, frames: lag_plan(df, frames, cols, steps, chosen, filled), before=max(steps)
    )


def with_forward_filled(series: Series, columns: list[str]) -> tuple[Series, dict[str, str]]:
    """Add `_ffill_<column>` beside each column: the newest value so far."""
    names = {c: f"_ffill_{c}" for c in columns}
    original = list(series.df.columns)
    df = with_neighbours(series, columns, following=False)
    df = df.select(
        *original,
        *[F.coalesce(F.col(c), F.col(f"_prev_{c}.v")).alias(names[c]) for c in columns],
    )
    return series.with_df(df), names
