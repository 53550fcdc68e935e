"""Whole feature sets in one composed plan: F8, F9, F10.

All row-window features of a set share one arrangement of the rows, hence one exchange and one sort.
Per-series features are small tables joined back.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.clock import CALENDAR_COLUMNS, calendar_columns
from tidewatch.operators import lags as lagging
from tidewatch.operators import rolling
from tidewatch.operators.missing import fill_zero, handle_missing
from tidewatch.operators.scale import scale as scale_columns
from tidewatch.operators.seasonal import decompose
from tidewatch.operators.spectral import spectral_features
from tidewatch.operators.wavelet import wavelet_features
from tidewatch.plans.layout import Frames
from tidewatch.plans.series import Series
from tidewatch.session import pinned

STREAM_WINDOWS, STREAM_LAGS = (5, 10, 20), (1, 5, 10)
FALLBACK_STATS, FALLBACK_KINDS = ("mean", "std", "min", "max"), ("lag", "diff")


def row_features(
    series: Series,
    columns: Iterable[str] | None = None,
    windows: Iterable[int] = rolling.WINDOWS,
    stats: Iterable[str] = rolling.STATS,
    lags: Iterable[int] = lagging.LAGS,
    kinds: Iterable[str] = lagging.KINDS,
    pair_window: int | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Rolling, lag, pair and calendar features from one pass over the ordered rows."""
    cols, windows, lags = series.columns(columns), list(windows), list(lags)
    stats, kinds = list(stats), list(kinds)
    pairs = list(combinations(cols, 2)) if pair_window else []
    filled: dict[str, str] = {}
    if "pct_change" in kinds:
        series, filled = lagging.with_forward_filled(series, cols)

    def plan(df: DataFrame, frames: Frames) -> DataFrame:
        df = rolling.roll_plan(df, frames, cols, windows, stats)
        df = lagging.lag_plan(df, frames, cols, lags, kinds, filled)
        if pairs:
            df = rolling.pair_plan(df, frames, pairs, pair_window)
        return df.withColumns(calendar_columns(series.ts)) if calendar else df

    return series.transform_rows(plan, before=max([*(w - 1 for w in windows), *lags, (pair_window or 1) - 1]))


def full_features(
    series: Series,
    columns: Iterable[str] | None = None,
    scale: bool = True,
    fill: bool = True,
    period: int = 1440,
    spectral_block: int | None = None,
) -> DataFrame:
    """Every feature with its defaults: 340 columns for four sensors on series of a day and more.

    Decomposition is NULL where a series is shorter than two periods. With `spectral_block`, spectra are those of the block
    of so many consecutive rows that a row lies in; without it, of its whole series.
    """
    cols = series.columns(columns)
    seasonal = [f"{c}_{part}" for c in cols for part in ("trend", "seasonal", "residual")]
    base = series.with_df(decompose(series, cols, period))
    if spectral_block:
        block = lambda df, frames: df.withColumn("_block_of", F.expr(f"(_at - 1) div {int(spectral_block)}"))
        placed = lambda df, frames: block(df.withColumn("_at", frames.position()), frames).drop("_at")
        base = base.with_df(base.transform_rows(placed))
    out = row_features(base, cols, pair_window=60, calendar=True)

    spectra = spectral_features(series, cols, spectral_block).drop("rows").withColumnRenamed("block", "_block_of")
    if spectral_block:
        out = out.join(spectra, [*series.keys, "_block_of"], "left")
    else:
        out = series.attach(out, spectra.drop("_block_of"))
    waves = wavelet_features(series, cols)
    out = series.attach(out, waves).drop("_block_of")
    spectra = spectra.drop("_block_of")
    numbers = [c for c in out.columns if c not in series.identity]
    if fill:
        # Calendar and per-series columns have no gaps to fill within a series.
        whole = {*CALENDAR_COLUMNS, *spectra.columns, *waves.columns}
        gappy = [c for c in numbers if c not in whole]
        out = handle_missing(series.with_df(out, numbers), "interpolate", columns=gappy)
    if scale:
        # Fitting and applying both read the features: they are computed once.
        out = scale_columns(pinned(out), numbers)
    ordered = [c for c in numbers if c not in seasonal] + seasonal
    return out.select(*series.identity, *ordered)


def stream_features(series: Series, columns: Iterable[str] | None = None) -> DataFrame:
    """The set computed on stream windows: 172 columns for four sensors, missing values as 0."""
    out = row_features(
        series, columns, windows=STREAM_WINDOWS, lags=STREAM_LAGS, calendar=True
    )
    return fill_zero(out, [c for c in out.columns if c not in series.identity])


def fallback_features(series: Series, columns: Iterable[str] | None = None) -> DataFrame:
    """The reduced set: basic rolling statistics, lags and differences, missing values as 0."""
    out = row_features(
        series, columns, STREAM_WINDOWS, FALLBACK_STATS, STREAM_LAGS, FALLBACK_KINDS
    )
    return fill_zero(out, [c for c in out.columns if c not in series.identity])
