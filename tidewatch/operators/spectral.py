"""Frequency-domain features: F1, A9, K1.

A series is cut into consecutive blocks of `block` rows (or taken whole); each block is gathered as one array
of bounded length and transformed with an FFT inside an Arrow batch. Gathering is a grouped aggregate on
(series, block), so a long series spreads over as many tasks as it has blocks. A whole series too long for one array is
transformed in steps over many groups (see `longspectrum`).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.longspectrum import PIECE, long_spectra
from tidewatch.operators.neighbours import POSITION
from tidewatch.plans.layout import arrange
from tidewatch.plans.series import Series
from tidewatch.session import pinned

FEATURES = (
    "dominant_freq",
    "dominant_power",
    "spectral_entropy",
    "spectral_centroid",
    "low_freq_energy",
    "mid_freq_energy",
    "high_freq_energy",
)
# Longest array one group holds: 4 Mi doubles, 32 MB. Longer series are transformed in steps.
WHOLE_LIMIT = 1 << 22
TOP = 5

_RESULT = T.StructType(
    [T.StructField(f, T.DoubleType()) for f in FEATURES]
    + [
        T.StructField("top_freqs", T.ArrayType(T.DoubleType())),
        T.StructField("top_magnitudes", T.ArrayType(T.DoubleType())),
    ]
)


def spectrum_features(x: np.ndarray, include_dc: bool, top: int) -> tuple:
    """Features of one block's one-sided spectrum."""
    freq = np.fft.rfftfreq(x.size)
    magnitude = np.abs(np.fft.rfft(x))
    power = magnitude**2
    first = 0 if include_dc or freq.size == 1 else 1
    # Strongest first; equal strengths go to the higher frequency.
    ranked = np.argsort(magnitude[first:], kind="stable")[::-1][:top] + first
    total = power.sum()
    share = power / total if total > 0 else np.full_like(power, np.nan)
    entropy = -(share * np.log2(share + 1e-10)).sum()
    centroid = (freq * share).sum() / share.sum()
    low, high = freq.max() * 0.25, freq.max() * 0.75
    cells = (
        freq[ranked[0]],
        power[ranked[0]],
        entropy,
        centroid,
        power[freq <= low].sum(),
        power[(freq > low) & (freq <= high)].sum(),
        power[freq > high].sum(),
    )
    numbers = [None if np.isnan(v) else float(v) for v in cells]
    return (*numbers, freq[ranked].tolist(), magnitude[ranked].tolist())


def _transform(include_dc: bool, top: int):
    @F.pandas_udf(_RESULT)
    def transform(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for arrays in batches:
            rows = [spectrum_features(np.asarray(a, dtype=float), include_dc, top) for a in arrays]
            yield pd.DataFrame(rows, columns=[f.name for f in _RESULT.fields])

    return transform


def _cells(columns: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(columns)]


def _spectra(
    series: Series, columns: list[str], block: int | None, include_dc: bool, top: int, whole_rows: int, piece: int
) -> DataFrame:
    """keys, block, rows and a struct `_s<i>` (FEATURES, top_freqs, top_magnitudes) for every column."""
    keys = list(series.keys)
    rows, position = series.df, F.struct(*series.order)
    long = None
    if block is not None:
        rows, position = _positioned(series), F.col(POSITION)
        number = F.floor(F.col(POSITION) / F.lit(block)).cast("bigint")
    else:
        number = F.lit(0).cast("bigint")
        if series.profile().longest > whole_rows:
            rows = pinned(_positioned(series).select(*keys, POSITION, *columns))
            position = F.col(POSITION)
            sizes = pinned(rows.groupBy(*keys).agg((F.count(F.lit(1)) > whole_rows).alias("_long")))
            rows = series.attach(rows, sizes)
            own = rows.where("_long").select(*keys, F.col(POSITION).alias("_t"), *_cells(columns))
            values = [f"v{i}" for i in range(len(columns))]
            long = _finished(long_spectra(own, keys, values, include_dc, top, piece), keys, values)
            rows = rows.where("NOT _long")
    packed = F.sort_array(F.collect_list(F.struct(position.alias("p"), *_cells(columns)))).alias("_rows")
    packed = rows.groupBy(*keys, number.alias("block")).agg(packed)
    transform = _transform(include_dc, top)
    out = packed.withColumns({f"_s{i}": transform(F.col(f"_rows.v{i}")) for i in range(len(columns))})
    out = out.select(*keys, "block", F.size("_rows").alias("rows"), *[f"_s{i}" for i in range(len(columns))])
    return out if long is None else out.unionByName(long)


def _positioned(series: Series) -> DataFrame:
    rows, frames = arrange(series)
    return frames.strip(rows.withColumn(POSITION, frames.position() - 1))


def _finished(spectra: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The result of the transform in steps in the form of that of whole arrays."""
    def struct(v: str) -> Column:
        number = {f: F.nanvl(F.col(f"{v}.{f}"), F.lit(None)) for f in ("entropy", "centre", "low", "mid", "high")}
        best = F.col(f"{v}.top")[0]
        cells = [best["freq"], best["magnitude"] ** 2, *number.values(), F.col(f"{v}.top.freq"), F.col(f"{v}.top.magnitude")]
        return F.struct(*[c.alias(f.name) for c, f in zip(cells, _RESULT.fields, strict=True)])

    cells = [struct(v).alias(f"_s{i}") for i, v in enumerate(values)]
    return spectra.select(*keys, F.lit(0).cast("bigint").alias("block"), F.col("rows").cast("int").alias("rows"), *cells)


def spectral_features(
    series: Series,
    columns: Iterable[str] | None = None,
    block: int | None = None,
    include_dc: bool = True,
    whole_rows: int = WHOLE_LIMIT,
    piece: int = PIECE,
) -> DataFrame:
    """One row per (series, block) with {c}_{feature} columns; missing values count as 0.

    Frequencies are in cycles per row. With `include_dc` the constant part can be the dominant frequency. Without `block` a
    series of more than `whole_rows` rows is transformed in steps, in groups of about `piece` numbers.
    """
    cols = series.columns(columns)
    out = _spectra(series, cols, block, include_dc, TOP, whole_rows, piece)
    return out.select(
        *series.keys,
        "block",
        "rows",
        *[F.col(f"_s{i}.{f}").alias(f"{c}_{f}") for i, c in enumerate(cols) for f in FEATURES],
    )


def top_frequencies(
    series: Series,
    column: str,
    block: int | None = None,
    k: int = TOP,
    include_dc: bool = True,
    whole_rows: int = WHOLE_LIMIT,
    piece: int = PIECE,
) -> DataFrame:
    """The k strongest frequencies of every block, or of every series as a whole, strongest first."""
    pairs = F.arrays_zip("_s0.top_freqs", "_s0.top_magnitudes")
    return (
        _spectra(series, series.columns([column]), block, include_dc, k, whole_rows, piece)
        .select(*series.keys, "block", F.posexplode(pairs).alias("rank", "_pair"))
        .select(
            *series.keys,
            "block",
            (F.col("rank") + 1).alias("rank"),
            F.col("_pair.top_freqs").alias("freq"),
            F.col("_pair.top_magnitudes").alias("magnitude"),
        )
    )
