"""Exact quantiles of long sliding windows.

A sorted list per row costs as much as the window is long. Here each group of the layout (a series, or a block of one with
its halo) ranks its values once and keeps the ranks in a wavelet matrix: one bit of every rank per level, ones behind
zeros. The k-th smallest of any stretch of rows is found by one step per level, from two counts each, so a window costs the
logarithm of the group's distinct values, whatever its length. All windows of a group are looked up together, on arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.layout import Frames

#: Windows of more rows than this are looked up in a wavelet matrix; shorter ones are sorted lists.
LONG_WINDOW = 200
#: Windows looked up at once.
LOOKUP = 1 << 18


class WaveletMatrix:
    """Ranks of a sequence, by bits."""

    def __init__(self, ranks: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []
        for bit in range(max(int(ranks.max(initial=0)).bit_length(), 1) - 1, -1, -1):
            one = (ranks >> bit & 1).astype(bool)
            self.levels.append((bit, np.append(0, np.cumsum(~one)).astype(np.int32 if len(ranks) < 1 << 31 else np.int64)))
            ranks = np.concatenate([ranks[~one], ranks[one]])

    def kth(self, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
        """The k-th smallest (from 0) of the ranks at low, ..., high - 1."""
        low, high, left, rank = low.copy(), high.copy(), np.full(len(low), k), np.zeros(len(low), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[low], zeros[high]
            up = left >= b - a
            left = np.where(up, left - (b - a), left)
            low, high = np.where(up, zeros[-1] + low - a, a), np.where(up, zeros[-1] + high - b, b)
            rank |= up.astype(np.int64) << bit
        return rank


def sliding(x: np.ndarray, windows: list[int], shares: list[float]) -> dict[tuple[int, float], np.ndarray]:
    """Linearly interpolated quantiles of the last w values at every row, masked where a window is short or has a NaN."""
    missing = np.isnan(x)
    gaps = np.append(0, np.cumsum(missing))
    distinct, own = np.unique(x[~missing], return_inverse=True)
    ranks = np.zeros(len(x), np.int64)
    ranks[~missing] = own
    matrix = WaveletMatrix(ranks)
    out = {}
    for w in windows:
        end = np.arange(w, len(x) + 1)
        end = end[gaps[end] == gaps[end - w]]
        for q in shares:
            at = q * (w - 1)
            below, part = int(at), at - int(at)
            values = np.zeros(len(x))
            for i in range(0, len(end), LOOKUP):
                high = end[i : i + LOOKUP]
                v = distinct[matrix.kth(high - w, high, below)]
                if part:
                    v = v + (distinct[matrix.kth(high - w, high, below + 1)] - v) * part
                values[high - 1] = v
            mask = np.ones(len(x), bool)
            mask[end - 1] = False
            out[w, q] = np.ma.array(values, mask=mask)
    return out


def quantile_name(column: str, window: int, share: float) -> str:
    return f"_quantile_{column}_{window}_{share}"


def with_quantiles(df: DataFrame, frames: Frames, columns: list[str], windows: list[int], shares: list[float]) -> DataFrame:
    """Adds `quantile_name` columns: the quantiles of the newest w values, NULL where one is missing or there are fewer."""
    place = "_window_row"
    numbered = df.withColumn(place, F.row_number().over(frames.rows()))
    names = {(c, w, q): quantile_name(c, w, q) for c in columns for w in windows for q in shares}
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names.values()]])
    kept = df.columns

    def look_up(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table[place].to_numpy(), kind="stable")))
        cells = {c: table[c] for c in kept}
        for c in columns:
            found = sliding(table[c].to_numpy(zero_copy_only=False).astype(float), windows, shares)
            for (w, q), v in found.items():
                cells[names[c, w, q]] = pa.array(v.data, pa.float64(), mask=v.mask)
        return pa.table(cells)

    return numbered.groupBy(*frames.group).applyInArrow(look_up, schema)
